"""What extraction costs for each row: searches that are not repeated, interpreted or run in vain."""

from datetime import date, datetime

import duckdb
from pyspark.sql import functions as F

from payloom.functions import dates, text
from payloom.functions import patterns as P
from payloom.plans import payslips
from test_payslips import SAMPLE
from workloads import QUERIES_AND_ORACLES


def test_item_table_is_cut_outside_the_lambdas(spark):
    docs = spark.createDataFrame([("a", SAMPLE)], "file string, text string")
    records = payslips.raw_records(docs)
    plan = records.select("itens")._jdf.queryExecution().optimizedPlan().toString()
    items = plan[: plan.index("AS itens")]
    # inside a lambda's argument, every search for a marker would be interpreted and run several times
    assert "instr" not in items and "ND: 0" not in items
    assert [i.codigo for i in records.first().itens] == ["8781", "998", "777777"]


def test_common_dates_need_no_formatter(spark):
    values = {
        "10/2023": date(2023, 10, 1), "13/2023": None, "00/2023": None, "10/0000": None, "1/2023": date(2023, 1, 1),
        "31/12/1999": date(1999, 12, 31), "31/02/2023": None, "29/02/2024": date(2024, 2, 29), "01/01/0000": None,
        " 10/2023 ": date(2023, 10, 1), "5/3/2023": date(2023, 3, 5), "10/2023\n": date(2023, 10, 1), "1٠/2023": None,
        "2023-03-05": date(2023, 3, 5), "": None, None: None,
    }
    df = spark.createDataFrame([(v,) for v in values], "v string")
    parsed = dates.parse_date_multi(F.col("v")).alias("d")
    assert {r.v: r.d for r in df.select("v", parsed).collect()} == values
    assert "try_cast" in df.select(parsed)._jdf.queryExecution().optimizedPlan().toString()


def test_clean_texts_are_left_alone_and_others_cleaned(spark):
    values = {
        "ANA": "ANA", "ANA B": "ANA B", "Á": "Á", "Á ": "Á", " ANA": "ANA", "ANA ": "ANA", "A\xa0B": "AB",
        "\xa0": None, "　N/A": None, "N/A": None, "nan": None, "": None, " ": None, "\x7f": "\x7f", "A\x1f": "A",
        "A\x85": "A", None: None,
    }
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cleaned = text.clean_text(F.col("v")).alias("c")
    assert {r.v: r.c for r in df.select("v", cleaned).collect()} == values
    assert "contains" in df.select(cleaned)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_names_and_states_come_from_the_header_of_their_block(spark):
    docs = spark.createDataFrame(
        [("a", "Matrícula: 7 X\nNome do Funcionário BIA PIS/PASEP: 1\nCPF: 1 Adm: 01/02/2020 resto da linha\n"
               "empr : 9 ANA Afastado\nCPF: 2 Adm: 01/02/2020 resto da linha resto da linha\n"
               "EMPR.: 8 CAIO EXEMPLO: Situação: Férias CPF: 3 Adm: 01/02/2020 resto da linha\n")],
        "file string, text string",
    )
    rows = payslips.extract_fields(payslips.employee_blocks(docs)).orderBy("pos")
    assert [(r.nome_funcionario, r.situacao, r.cpf) for r in rows.collect()] == [
        ("BIA", None, "1"), ("ANA Afastado", None, "2"), ("CAIO", "Férias", "3"),
    ]


def test_typed_columns_hold_items_and_lost_amounts(spark, tmp_path):
    rows = [(9, 7, "F", 1234.5, datetime(1996, 1, 2), "5-LOW"), (10, 7, "O", 2e9, datetime(1996, 1, 2), "1-URGENT")]
    orders = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, orders).write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES_AND_ORACLES()[0]["typed_cast_columns"](spark, str(tmp_path))
    found = {(r.file, r.pos): (r.itens, r.perdas, r.total_proventos) for r in got.collect()}
    assert found["9", 1][:2] == (
        "73;DESC UM 220,00;Provento;1234.50|8009;DESC DOIS 11,00;Desconto;123.45|777777;ITEM NOVO 1,00;Provento;10.00", "",
    )
    # an item and its block lose an amount that the decimal cannot hold, and the block says which
    assert found["10", 2] == (
        "9380;PRO LABORE DIAS 30,00;Provento;", "total_proventos;2000000000.00|valor_liquido;2000000000.00", None,
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    want = con.execute(QUERIES_AND_ORACLES()[1]["typed_cast_columns"])
    at = [d[0] for d in want.description]
    want = {(r[at.index("file")], r[at.index("pos")]): (r[at.index("itens")], r[at.index("perdas")]) for r in want.fetchall()}
    assert want == {k: v[:2] for k, v in found.items()}


def test_footer_amounts_in_any_order_and_number(spark):
    footers = {
        "Proventos: 1,00 Descontos: 2,00 Líquido: 3,00 Base INSS: 4,00 Base FGTS: 5,00 Valor FGTS: 6,00 Base IRRF: 7,00":
            ["1,00", "2,00", "3,00", "4,00", "5,00", "6,00", "7,00"],
        "TOTAL DE PROVENTOS 1,00\nLÍQUIDO DE FÉRIAS 3,00 base irrf ferias 7,00": ["1,00", "", "3,00", "", "", "", "7,00"],
        # the first label counts wherever it is, and of its amounts the first
        "Total de Proventos 9,00 Descontos: 2,00 Proventos: 1,00 Proventos: 8,00": ["1,00", "2,00", "", "", "", "", ""],
        "Base IRRF: 7,00 Líquido de Férias 3,00 Base INSS: 4,00 Descontos: ..": ["", "..", "3,00", "4,00", "", "", "7,00"],
        "Líquido: 1,00 Líquido: 2,00": ["", "", "1,00", "", "", "", ""],
        "sem valores": [""] * 7,
        "": [""] * 7,
    }
    df = spark.createDataFrame([(f,) for f in footers], "block string")
    found = payslips.footer_amounts(F.col("block")).alias("a")
    assert {r.block: r.a for r in df.select("block", found).collect()} == footers
    # one search of the amounts for all fields, instead of one or two searches for each
    each = df.select(found.alias("a")).select(*(payslips.total(F.col("a"), n) for n in P.TOTALS))
    assert "instr" not in each._jdf.queryExecution().optimizedPlan().toString()


def test_departments_are_counted_in_the_parts(spark):
    texts = {
        "Departamento: A\nEmpr: 1 X\nDepartamento: B\nEmpr: 2 Y\nEmpr: 3 Z\n": [None, "A", "B", "B"],
        "Empr: 1 X\nDepartamento: B \nDepartamento: C\nEmpr: 2 Y": [None, "C"],
        # a line that holds the next header, one that runs into it, and one that ends the text
        "Departamento: RH Empr: 1 X\nEmpr: 2 Y": [None, "RH Empr: 1 X", "RH Empr: 1 X"],
        "Departamento:\n Empr: 1 X\nEmpr: 2 Y": [None, "Empr: 1 X", "Empr: 1 X"],
        "Empr: 1 X\nDepartamento: B": [None],
        "Empr: 1 X\nDepartamento: Matrícula:\n7 Y\nEmpr: 2 Z": [None, "Matrícula:", "Matrícula:"],
        "sem nada": [None],
        "": [None],
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cut = df.select("text", payslips.split_blocks(F.col("text")).alias("p"))
    found = cut.select("text", payslips.departments(F.col("text"), F.col("p")).alias("d"))
    assert {r.text: r.d for r in found.collect()} == texts


def test_extraction_runs_in_methods_that_the_jvm_compiles(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    payslips.all_blocks(spark.createDataFrame([("a", SAMPLE)], "file string, text string"))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
