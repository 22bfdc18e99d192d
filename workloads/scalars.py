"""Scalar functions over the given tables, wrapped in the dirt they are meant to remove."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom.functions import dates, numbers, text
from payloom.plans import calendar, payslips
from payloom.sources import rubrics
from workloads.documents import RUBRIC_SQL
from workloads.registry import query, table
from workloads.render import NBSP, brl, cents, text_of, when_mod

ORDERS = "WITH o AS (SELECT *, o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS pc, " \
         "CAST(o_orderdate AS DATE) AS d FROM orders) "
STRIP_SQL = "trim({}, " + " || ".join(f"chr({ord(ch)})" for ch in text.WHITESPACE) + ")"


# -- text ----------------------------------------------------------------------------


@query(
    "clean_text",
    "WITH t AS (SELECT doc_id, replace(" + STRIP_SQL.format("text") + ", chr(160), '') AS t FROM documents) "
    "SELECT doc_id, CASE WHEN doc_id % 9 = 0 OR t IN ('N/A', '', 'nan', 'None', 'NULL') THEN NULL "
    "ELSE t END AS texto FROM t",
)
def clean_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    dirty = when_mod(
        k, 9,
        {0: text_of(" ", F.element_at(F.array(*map(F.lit, text.TEXT_SENTINELS)), (k % 5 + 1).cast("int")), NBSP)},
        text_of(NBSP, "\t", F.col("text"), "\n\x1c "),
    )
    return docs.select("doc_id", text.clean_text(dirty).alias("texto"))


def _cpf_dirt(k):
    return when_mod(
        k, 7, {0: F.lit("--"), 1: F.lit("None"), 2: text_of("CPF ", k, "-", k % 100, NBSP)},
        text_of(k, ".", k % 10, "/", k % 7),
    )


CPF_SQL = "CASE WHEN c_custkey % 7 IN (0, 1) THEN {} WHEN c_custkey % 7 = 2 THEN c_custkey || '' || " \
          "(c_custkey % 100) ELSE c_custkey || '' || (c_custkey % 10) || (c_custkey % 7) END"


@query("clean_cpf", f"SELECT c_custkey, {CPF_SQL.format('NULL')} AS cpf FROM customer")
def clean_cpf(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k, text.clean_cpf(_cpf_dirt(k)).alias("cpf"))


_EMPTY = "''"


@query("clean_digits", f"SELECT c_custkey, {CPF_SQL.format(_EMPTY)} AS cpf FROM customer")
def clean_digits(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k, text.clean_digits(_cpf_dirt(k)).alias("cpf"))


@query(
    "sentinel_to_null",
    "SELECT event_id, CASE WHEN event_id % 4 < 2 THEN NULL ELSE event_type END AS tipo FROM events",
)
def sentinel_to_null(spark, sf):
    k = F.col("event_id")
    dirty = when_mod(k, 4, {0: F.lit("nan"), 1: F.lit("None")}, F.col("event_type"))
    return table(spark, sf, "events").select(k, text.sentinel_to_null(dirty).alias("tipo"))


@query(
    "rubric_fallback_name",
    "SELECT p_partkey, 'NAO_MAPEADO_' || upper(replace(p_name, ' ', '_')) || "
    "CASE WHEN p_partkey % 3 = 0 THEN '_1,' ELSE '' END AS nome FROM part",
)
def rubric_fallback_name(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    k = F.col("p_partkey")
    tail = when_mod(
        k, 3, {0: F.lit(" 1,00"), 1: text_of("  ", F.col("p_size"), "/30 ")}, text_of(NBSP, F.col("p_size"))
    )
    spaced = F.replace(F.col("p_name"), F.lit(" "), F.lit(" \t"))
    return parts.select(k, payslips.fallback_name(F.concat(spaced, tail)).alias("nome"))


# -- code map ------------------------------------------------------------------------

CODES_SQL = f"WITH {RUBRIC_SQL}, uso AS (SELECT CAST(l_partkey % 1100 AS VARCHAR) AS codigo, count(*) AS n " \
            "FROM lineitem GROUP BY ALL), tudo AS (SELECT codigo, tipo, nome, coalesce(n, 0) AS n FROM rub LEFT JOIN uso USING (codigo)) "


def code_use(spark, sf):
    """Line items per code: ``l_partkey % 1100`` covers mapped and unmapped codes."""
    code = (F.col("l_partkey") % 1100).cast("string").alias("codigo")
    return table(spark, sf, "lineitem").select(code).groupBy("codigo").agg(F.count(F.lit(1)).alias("n"))


def with_use(codes, spark, sf):
    """All mapped codes, with the number of line items that use each (0 for none)."""
    used = codes.join(code_use(spark, sf), "codigo", "left")
    return used.withColumn("n", F.coalesce("n", F.lit(0)))


@query("scan_rubric_map", CODES_SQL + "SELECT codigo, tipo, nome, n FROM tudo")
def scan_rubric_map(spark, sf):
    return with_use(rubrics.scan_rubric_map(spark), spark, sf).select("codigo", "tipo", "nome", "n")


@query(
    "rubric_name_split",
    CODES_SQL + "SELECT tipo, count(*) AS n_codigos, CAST(sum(length(nome) * n) AS BIGINT) AS letras "
    "FROM tudo GROUP BY tipo",
)
def rubric_name_split(spark, sf):
    label = F.col("rotulo")
    used = with_use(rubrics.scan_rubric_map(spark), spark, sf).select(
        rubrics.label_type(label).alias("tipo"), rubrics.label_name(label).alias("nome"), "n"
    )
    return used.groupBy("tipo").agg(
        F.count(F.lit(1)).alias("n_codigos"), F.sum(F.length("nome") * F.col("n")).alias("letras")
    )


@query(
    "sort_numeric_code",
    CODES_SQL + "SELECT codigo, tipo, n, row_number() OVER (ORDER BY tipo DESC, CAST(codigo AS INT)) AS ordem "
    "FROM tudo",
)
def sort_numeric_code(spark, sf):
    used = with_use(rubrics.scan_rubric_map(spark), spark, sf).select("codigo", "tipo", "n")
    ordered = rubrics.sort_numeric_code(used)
    # at most 188 rows reach this point, in order, in one partition
    return ordered.coalesce(1).withColumn("ordem", F.monotonically_increasing_id() + 1)


@query("set_merge_map", CODES_SQL + "SELECT codigo, tipo, n FROM tudo")
def set_merge_map(spark, sf):
    all_codes = rubrics.scan_rubric_map(spark)
    merged = rubrics.set_merge_map(
        all_codes.where("tipo = 'Provento'"), all_codes.where("tipo = 'Desconto'")
    )
    return with_use(merged, spark, sf).select("codigo", "tipo", "n")


@query(
    "lookup_map",
    f"WITH {RUBRIC_SQL} SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS codigo, tipo, "
    "coalesce(nome, 'NAO_MAPEADO_ITEM') AS nome FROM lineitem LEFT JOIN rub "
    "ON codigo = CAST(l_partkey AS VARCHAR)",
)
def lookup_map(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text_of(" ", F.col("l_partkey"), " ").alias("codigo_lido"),
        F.lit("Item 30/30").alias("descricao"),
    )
    named = payslips.lookup_rubric(rows, rubrics.scan_rubric_map(spark), "codigo_lido", "descricao")
    return named.select(
        "l_orderkey", "l_linenumber", text.strip(F.col("codigo_lido")).alias("codigo"),
        F.col("tipo_mapeado").alias("tipo"), F.col("nome_rubrica").alias("nome"),
    )


# -- numbers -------------------------------------------------------------------------


@query(
    "parse_brl_money",
    ORDERS + "SELECT k, CASE k % 8 WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN CAST(pc AS DOUBLE) "
    "WHEN 7 THEN CAST(-pc AS DOUBLE) / 100 ELSE CAST(pc AS DOUBLE) / 100 END AS valor FROM o",
)
def parse_brl_money(spark, sf):
    k, pc = F.col("o_orderkey"), cents(F.col("o_totalprice"))
    plain_comma = F.replace(F.format_string("%.2f", pc / 100), F.lit("."), F.lit(","))
    dirty = when_mod(
        k, 8,
        {
            0: text_of("R$ ", brl(pc)),
            1: brl(pc),
            2: text_of(NBSP, "R$", NBSP, brl(pc), "\t"),
            3: plain_comma,
            4: text_of("abc", k),
            5: F.lit("  "),
            6: F.format_string("%.2f", pc / 100),
        },
        text_of("R$ -", brl(pc)),
    )
    return table(spark, sf, "orders").select(k.alias("k"), numbers.parse_brl_money(dirty).alias("valor"))


@query(
    "to_decimal_safe",
    ORDERS + "SELECT k, CASE k % 5 WHEN 0 THEN CAST(k * 100 + 1 AS DOUBLE) / 100 WHEN 1 THEN NULL "
    "WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE CAST(pc AS DOUBLE) / 100 END AS valor FROM o",
)
def to_decimal_safe(spark, sf):
    k = F.col("o_orderkey")
    raw = when_mod(
        k, 5,
        {
            0: text_of(k, ".005"),
            1: F.lit(" "),
            2: text_of("v", k),
            3: text_of("123456789", k + 10),
        },
        F.format_string("%.2f", cents(F.col("o_totalprice")) / 100),
    )
    return table(spark, sf, "orders").select(k.alias("k"), numbers.to_decimal_safe(raw).alias("valor"))


@query(
    "safe_numeric_cast",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 < 2 THEN NULL WHEN l_partkey % 4 = 2 "
    "THEN -l_extendedprice ELSE l_extendedprice END AS valor FROM lineitem",
)
def safe_numeric_cast(spark, sf):
    k = F.col("l_partkey")
    price = F.format_string("%.2f", "l_extendedprice")
    raw = when_mod(
        k, 4, {0: F.lit("sem valor"), 1: F.lit("--"), 2: text_of("BRL -", price)}, text_of("~", price, " total")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.safe_numeric_cast(raw).alias("valor")
    )


@query(
    "nullable_int",
    "SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN CAST(user_id AS VARCHAR) END AS id FROM events",
)
def nullable_int(spark, sf):
    k = F.col("event_id")
    raw = when_mod(k, 3, {0: text_of(F.col("user_id"), ".0"), 1: F.col("user_id").cast("string")}, F.lit("nan x"))
    return table(spark, sf, "events").select(k, numbers.nullable_int(raw).cast("string").alias("id"))


@query(
    "to_boolean",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS ativo FROM events",
)
def to_boolean(spark, sf):
    k = F.col("event_id")
    raw = when_mod(k, 4, {0: F.lit("true"), 1: F.lit("false"), 2: F.col("event_type")}, F.lit(None))
    return table(spark, sf, "events").select(k, numbers.to_boolean(raw).alias("ativo"))


# -- dates ---------------------------------------------------------------------------


@query(
    "parse_date_multi",
    ORDERS + "SELECT k, CAST(CASE WHEN k % 10 IN (2, 3) THEN CAST(date_trunc('month', d) AS DATE) "
    "WHEN k % 10 >= 7 THEN NULL ELSE d END AS VARCHAR) AS data FROM o",
)
def parse_date_multi(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")

    def shown(fmt):
        return F.date_format(d, fmt)

    raw = when_mod(
        k, 10,
        {
            0: text_of(NBSP, shown("dd/MM/yyyy"), "\n"),
            1: shown("yyyy-MM-dd"),
            2: shown("MM/yyyy"),
            3: shown("M-yyyy"),
            4: shown("d-M-yyyy"),
            5: shown("yyyy/MM/dd"),
            6: shown("d/M/yyyy"),
            7: text_of(shown("yyyy-MM-dd"), "T10:00:00"),
            8: text_of("31/02/", shown("yyyy")),
        },
        F.lit("nan"),
    )
    return table(spark, sf, "orders").select(k.alias("k"), dates.parse_date_multi(raw).alias("data"))


@query(
    "case_semester",
    "SELECT CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semestre, count(*) AS n FROM orders GROUP BY 1",
)
def case_semester(spark, sf):
    d = F.col("o_orderdate").cast("date")
    halves = table(spark, sf, "orders").select(dates.case_semester(d).alias("semestre"))
    return halves.groupBy("semestre").agg(F.count(F.lit(1)).alias("n"))


DAYS = "SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), " \
       "INTERVAL 1 DAY)) AS DATE) AS d FROM orders"
USE = "LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = d"


def order_days(spark, sf):
    """Every day between the first and the last order."""
    d = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf, "orders").agg(F.min(d).alias("primeiro"), F.max(d).alias("ultimo"))
    return calendar.date_series(bounds, "primeiro", "ultimo")


def with_order_count(days, spark, sf):
    per_day = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("data")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = days.join(per_day, "data", "left")
    return joined.select(*days.columns, F.coalesce("n", F.lit(0)).alias("n_pedidos"))


@query(
    "date_series",
    f"SELECT CAST(d AS VARCHAR) AS data, coalesce(n, 0) AS n_pedidos FROM ({DAYS}) {USE}",
)
def date_series(spark, sf):
    return with_order_count(order_days(spark, sf), spark, sf)


PARTS = "year(d) AS ano, month(d) AS mes, day(d) AS dia, quarter(d) AS trimestre, " \
        "CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre, dayofweek(d) AS dia_da_semana, " \
        "dayofyear(d) AS dia_do_ano, weekofyear(d) AS semana_do_ano"


def _pick(names, position):
    return "([" + ", ".join(f"'{n}'" for n in names) + f"])[{position}]"


NAMES = f"{_pick(dates.DAY_NAMES, 'dayofweek(d) + 1')} AS nome_dia_da_semana, " \
        f"{_pick(dates.MONTH_NAMES, 'month(d)')} AS nome_mes, " \
        f"{_pick(dates.MONTH_SHORT, 'month(d)')} AS nome_mes_abrev, strftime(d, '%Y-%m') AS ano_mes"
PART_COLUMNS = ("ano", "mes", "dia", "trimestre", "semestre", "dia_da_semana", "dia_do_ano", "semana_do_ano")
NAME_COLUMNS = ("nome_dia_da_semana", "nome_mes", "nome_mes_abrev", "ano_mes")
_OF_ORDER = "SELECT o_orderkey, {} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"


def _order_calendar(spark, sf, wanted):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", *dates.calendar_columns(d)).select("o_orderkey", *wanted)


@query("date_parts", _OF_ORDER.format(PARTS))
def date_parts(spark, sf):
    return _order_calendar(spark, sf, PART_COLUMNS)


@query("date_names", _OF_ORDER.format(NAMES))
def date_names(spark, sf):
    return _order_calendar(spark, sf, NAME_COLUMNS)


@query(
    "dim_calendar_build",
    f"SELECT CAST(d AS VARCHAR) AS data, {PARTS}, {NAMES}, coalesce(n, 0) AS n_pedidos FROM ({DAYS}) {USE}",
)
def dim_calendar_build(spark, sf):
    return with_order_count(calendar.calendar_of(order_days(spark, sf)), spark, sf)
