"""Time the headline queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Every query writes all its columns to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from payloom.session import build_session  # noqa: E402
from workloads import QUERIES_AND_ORACLES  # noqa: E402
from workloads.documents import item_line_rows  # noqa: E402
from workloads.people import json_rows  # noqa: E402
from workloads.render import payslip_docs  # noqa: E402

HEADLINE = (
    "regex_extract_fields", "x_nome", "x_items", "asof_section_header", "typed_cast_columns",
    "explode_outer_default", "folha_consolidada", "folha_detalhada", "sink_csv_locale",
    "regex_extract_repeating", "lookup_map", "parse_brl_money", "parse_date_multi", "clean_text",
    "json_flatten", "explode_benefits", "distinct_on_name_desc", "surrogate_key_assign",
    "upsert_scd1_coalesce", "upsert_partial_columns", "join_fact_surrogate_key", "replace_by_period",
    "conditional_update", "ref_integrity_check", "dim_calendar_build",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = QUERIES_AND_ORACLES()[0]

    def timed(work) -> float:
        start = time.perf_counter()
        work()
        return round(time.perf_counter() - start, 3)

    seconds = {"render_inputs": timed(lambda: (payslip_docs(spark, sf), json_rows(spark, sf), item_line_rows(spark, sf)))}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = timed(
            lambda q=queries[name]: q(spark, sf).write.format("noop").mode("overwrite").save()
        )
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
             "sf": os.path.basename(sf.rstrip("/"))}
        )
    )


if __name__ == "__main__":
    main()
