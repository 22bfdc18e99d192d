from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payloom.functions import dates, numbers, text
from payloom.plans import calendar, payslips
from payloom.sources import rubrics


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_money(spark):
    cases = {
        "R$ 1.200,50": 1200.5, "1.000": 1000.0, "1500.50": 150050.0, "-5,5": -5.5, "": None, "  ": None,
        "abc": None, "R$": None, "\xa0R$\xa07,00\n": 7.0, "1_000": 1000.0, "1e3": 1000.0, "1,5d": None,
        "1,2,3": None, "+3": 3.0, ",5": 0.5, "_1": None, None: None,
    }
    assert apply(spark, numbers.parse_brl_money, list(cases)) == list(cases.values())


def test_money_variant(spark):
    docs = ['"R$ 1.000,00"', '"1500.50"', "1500.5", "null", "true", "7", '""', "[1]"]
    got = apply(spark, lambda c: numbers.parse_money_variant(F.parse_json(c)), docs)
    assert got == [1000.0, 150050.0, 1500.5, None, 1.0, 7.0, None, None]


def test_decimal(spark):
    cases = {"1.005": "1.01", "-1.005": "-1.01", " ": None, "x": None, "123456789.5": None, "12": "12.00"}
    got = apply(spark, numbers.to_decimal_safe, list(cases))
    assert got == [None if v is None else Decimal(v) for v in cases.values()]
    assert apply(spark, numbers.to_decimal_safe, [0.0, 2.675], "double") == [Decimal("0.00"), Decimal("2.68")]
    assert apply(spark, numbers.safe_numeric_cast, ["a1.5b", "", "--", "1-2"]) == [Decimal("1.50"), None, None, None]


@pytest.mark.parametrize("raw, want", [
    ("01/02/2023", date(2023, 2, 1)), ("1/2/2023", date(2023, 2, 1)), ("2023-01-05", date(2023, 1, 5)),
    ("03/2023", date(2023, 3, 1)), ("03-2023", date(2023, 3, 1)), ("5-1-2023", date(2023, 1, 5)),
    ("2023/01/09", date(2023, 1, 9)), ("31/02/2023", None), ("01/01/23", None), ("2023-01-05T10:00:00", None),
    ("nan", None), ("", None), (None, None), ("\xa001/02/2023\n", date(2023, 2, 1)), ("29/02/2024", date(2024, 2, 29)),
    ("13/2023", None), ("01/01/0000", None), ("2023-01- 5", date(2023, 1, 5)), ("1/1/2023x", None),
])
def test_date(spark, raw, want):
    assert apply(spark, dates.parse_date_multi, [raw]) == [want]


def strptime_cascade(value):
    for fmt in ("%d/%m/%Y", "%Y-%m-%d", "%m/%Y", "%m-%Y", "%d-%m-%Y", "%Y/%m/%d"):
        try:
            return datetime.strptime(value.strip(), fmt).date()
        except ValueError:
            continue
    return None


def test_dates_match_strptime(spark):
    values = [
        f"{a}{s}{b}{s}{c}" for s in "/-" for a in ("0", "1", "09", "31", "2023", "0001", "32")
        for b in ("0", "2", "02", "12", "13", "2024") for c in ("1", "29", "30", "2024", "1999", "99", "0000")
    ] + [f"{a}{s}{c}" for s in "/-. " for a in ("0", "1", "12", "13", "001") for c in ("2024", "0000", "24", "20245")]
    assert apply(spark, dates.parse_date_multi, values) == [strptime_cascade(v) for v in values]


def test_text(spark):
    cases = {
        "\xa0a b\n": "a b", "a\xa0b": "ab", "N/A": None, "NULL": None, "nan": None, "None": None, "n/a": "n/a",
        "": None, "\x1c x　": "x", "\xa0": None, None: None, " nan ": None,
    }
    assert apply(spark, text.clean_text, list(cases)) == list(cases.values())
    cpf = {"111.222.333-44": "11122233344", "None": None, "--": None, None: None, "1a2": "12"}
    assert apply(spark, text.clean_cpf, list(cpf)) == list(cpf.values())
    assert apply(spark, text.clean_digits, ["--", None]) == ["", None]
    assert apply(spark, text.sentinel_to_null, ["nan", "None", "NULL"]) == [None, None, "NULL"]


def test_strip_equals_python(spark):
    every = [f"{chr(c)}x{chr(c)}" for c in range(0x3001) if not 0xD800 <= c < 0xE000]
    got = apply(spark, text.strip, every)
    assert got == [s.strip() for s in every]


def test_name_suffix(spark):
    rows = [
        ("ANA Trabalhando", "trabalhando", "ANA"), ("ANA", None, "ANA"), ("ANA PIS:", None, "ANA"),
        ("ANA PIS: Férias", "Férias", "ANA"), ("ANA", "", ""), ("ANA", "X", "ANA"),
    ]
    df = spark.createDataFrame(rows, "n string, s string, w string")
    got = df.select(text.name_suffix_strip(F.col("n"), F.col("s")).alias("o"), "w").collect()
    assert [r.o for r in got] == [r.w for r in got]


def test_rubrics(spark):
    rows = {r.codigo: r for r in rubrics.scan_rubric_map(spark).collect()}
    assert len(rows) == 188
    assert sum(r.tipo == "Provento" for r in rows.values()) == 122
    assert (rows["638"].nome, rows["965"].nome, rows["1043"].nome) == (
        "VT_Meses_Anteriores", "Desc_Odonto_Mais_Doc", "Vale_Transporte",
    )
    ordered = [r.codigo for r in rubrics.sort_numeric_code(rubrics.scan_rubric_map(spark)).collect()]
    assert ordered[0] == "12" and ordered[122] == "48" and ordered[-1] == "9752"
    names = {
        "ITEM NOVO 1,00": "NAO_MAPEADO_ITEM_NOVO_1,", "Bônus \xa0 extra 30/30 ": "NAO_MAPEADO_BÔNUS_EXTRA",
        "": "NAO_MAPEADO_", "12 / 3": "NAO_MAPEADO_",
    }
    assert apply(spark, payslips.fallback_name, list(names)) == list(names.values())


def test_calendar(spark):
    rows = calendar.dim_calendar(spark).orderBy("data").collect()
    assert len(rows) == 2922 and len(rows[0]) == 13
    start = date(2023, 1, 1)
    for i, r in enumerate(rows):
        d = start + timedelta(days=i)
        assert (r.data, r.ano, r.mes, r.dia, r.trimestre) == (d, d.year, d.month, d.day, (d.month + 2) // 3)
        assert (r.dia_da_semana, r.dia_do_ano) == (d.isoweekday() % 7, d.timetuple().tm_yday)
        assert (r.semana_do_ano, r.semestre) == (d.isocalendar()[1], 1 if d.month <= 6 else 2)
    first = rows[0]
    assert (first.nome_dia_da_semana, first.nome_mes, first.nome_mes_abrev, first.ano_mes) == (
        "Domingo", "Janeiro", "Jan", "2023-01",
    )
