"""Inputs rendered from tables: every row, in the task that reads it."""

from datetime import datetime

from payloom.plans import payslips, rejected
from workloads import render

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def orders(spark, folder, keys):
    rows = [(k, 7, "F", 1234.5, datetime(1996, 1, 2), "5-LOW") for k in keys]
    spark.createDataFrame(rows, ORDERS).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_rendered_documents_are_not_stored_or_shuffled(spark, tmp_path):
    sf = orders(spark, tmp_path, [1, 2, 2, 5, 8])
    docs = render.payslip_docs(spark, sf)
    assert all("orders.parquet" in f for f in docs.inputFiles())
    # only table columns are dealt to the tasks
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression"):]
    assert "text" not in dealt.lower() and "concat" not in dealt
    assert [r.file for r in docs.orderBy("file").collect()] == ["1", "2", "2", "5", "8"]


def test_repeated_orders_keep_their_blocks(spark, tmp_path):
    sf = orders(spark, tmp_path, [1, 2, 2, 5, 8])
    blocks = payslips.employee_blocks(render.payslip_docs(spark, sf))
    assert {r.file: r["count"] for r in blocks.groupBy("file").count().collect()} == {"1": 3, "2": 4, "5": 3, "8": 3}


def test_rejected_people_are_read_once(spark):
    records = spark.createDataFrame(
        [("a", 1, None, "ANA"), ("b", 1, "1", None), ("c", 1, "2", "BIA"), ("d", 1, "N/A", None)],
        "file string, pos int, cpf string, nome_funcionario string",
    )
    out = rejected.payroll_people(records)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.regra, r.chave, r.valor) for r in out.collect()} == {
        ("pessoa sem cpf", "a#1", "ANA"), ("pessoa sem nome", "b#1", "1"), ("pessoa sem cpf", "d#1", None),
    }


def test_a_filter_on_texts_does_not_repeat_the_rendering(spark, tmp_path):
    docs = render.payslip_docs(spark, orders(spark, tmp_path, [1, 3, 4, 5]))
    out = payslips.rejected_documents(docs)
    # the month, which many parts of a text hold, is formatted in one place of the plan
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MM/yyyy") == docs._jdf.queryExecution().optimizedPlan().toString().count("MM/yyyy")
    assert sorted(r.file for r in out.collect()) == ["3", "4"]
