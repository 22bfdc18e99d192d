"""Files in, star schema out: stages, re-runs, conflicts and the export."""

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.operators.checks import BatchConflict
from payloom.plans import employees, run, star
from payloom.sources.files import scan_employee_json, scan_payslip_text
from payloom.sources.tables import Warehouse
from test_parity import CONTRACTOR, VACATION
from test_payslips import SAMPLE

def ts():
    return F.lit("2024-01-31 12:00:00").cast("timestamp")


PEOPLE = [
    {
        "id": 1, "name": "ANA API", "salary": "R$ 1.000,00", "active": True, "updated_at": "2024-01-05T10:00:00",
        "education": "superior", "birthDate": "01/02/1990", "documents": {"idNumber": "111.222.333-44"},
        "address": {"city": {"name": "BELEM", "state": {"initials": "PA"}}},
        "benefits": [{"benefitName": "VA", "value": "R$ 10,50", "valueDiscount": 1.5}, {"benefitName": "VT"}],
    },
    {"id": 2, "name": "DORA", "salary": 1500.5, "active": True, "documents": {"idNumber": "999"}, "benefits": []},
    {"id": 3, "name": "SEM CPF", "salary": "1500.50", "documents": None, "address": None},
    {"name": "SEM ID", "documents": {"idNumber": "888"}, "benefits": None},
]


@pytest.fixture
def inputs(tmp_path):
    docs, pages = tmp_path / "docs", tmp_path / "pages"
    docs.mkdir(), pages.mkdir()
    (docs / "a.txt").write_text(SAMPLE + CONTRACTOR, encoding="utf-8")
    (docs / "b.TXT").write_text(VACATION, encoding="utf-8")
    (docs / "c.txt").write_text("\n", encoding="utf-8")
    (docs / "z.txt").write_text("", encoding="utf-8")
    (docs / "d.pdf").write_text(SAMPLE, encoding="utf-8")
    (docs / "inner").mkdir()
    (docs / "inner" / "e.txt").write_text(SAMPLE, encoding="utf-8")
    (pages / "1.json").write_text(json.dumps(PEOPLE[:2], indent=1), encoding="utf-8")
    (pages / "2.json").write_text(json.dumps(PEOPLE[2:]), encoding="utf-8")
    return str(docs), str(pages)


def snapshot(wh):
    tables = {t: wh.read(t, {}).collect() for t in (run.CALENDAR, run.BASE, run.RICH, run.BENEFITS)}
    tables[run.CONSOL] = wh.read_periods(run.CONSOL, S.FATO_CONSOLIDADA).collect()
    tables[run.DETAIL] = wh.read_periods(run.DETAIL, S.FATO_DETALHADA).collect()
    return {name: sorted(map(tuple, rows), key=repr) for name, rows in tables.items()}


def test_scan(spark, inputs, tmp_path):
    docs = scan_payslip_text(spark, inputs[0])
    assert sorted(r.file for r in docs.collect()) == ["a.txt", "b.TXT", "c.txt", "z.txt"]
    assert scan_payslip_text(spark, str(tmp_path / "missing")).isEmpty()
    assert scan_payslip_text(spark, inputs[0], ".none").isEmpty()


def test_stages_and_rerun(spark, inputs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts(), str(tmp_path / "csv"))
    first = snapshot(wh)
    base = {r.cpf: r for r in wh.read(run.BASE, {}).collect()}
    assert base["11122233344"].nome_colaborador == "ANA API"
    assert base["11122233344"].situacao_csv == "Trabalhando"
    assert base["33344455566"].data_demissao_csv == date(2023, 10, 5)
    assert set(base) == {"N/A", "11122233344", "22233344455", "33344455566", "999", "888"}
    rich = {r.colaborador_id_solides: r for r in wh.read(run.RICH, {}).collect()}
    assert set(rich) == {-1, 1, 2}
    assert (rich[1].salario_api, rich[2].salario_api) == (Decimal("1000.00"), Decimal("1500.50"))
    assert (rich[1].cidade, rich[1].estado, rich[2].cidade) == ("BELEM", "PA", None)
    assert rich[1].data_ultima_atualizacao_api is None
    assert rich[1].data_ultima_atualizacao == datetime(2024, 1, 31, 12)
    benefits = wh.read(run.BENEFITS, {}).collect()
    assert {(b.nome_beneficio, b.valor_beneficio, b.valor_desconto) for b in benefits} == {
        ("VA", Decimal("10.50"), Decimal("1.50")), ("VT", None, None),
    }
    assert len(first[run.CALENDAR]) == 2922 and len(first[run.CONSOL]) == 3
    assert run.check_integrity(wh).isEmpty()
    folder = tmp_path / "csv" / "FOPAG_Consolidada_Tratada"
    header, exported = None, []
    for part in (f for f in os.listdir(folder) if f.endswith(".csv")):
        text = (folder / part).read_bytes()
        assert text.startswith(b"\xef\xbb\xbfcompetencia;tipo_calculo;")
        first_line, *lines = text.decode("utf-8-sig").splitlines()
        assert header in (None, first_line)
        header, exported = first_line, exported + lines
    names = header.split(";")
    rows = sorted(((r["nome_funcionario"], r["cpf"], r["total_proventos"]) for r in (dict(zip(names, x.split(";"))) for x in exported)))
    assert rows == [
        ("ANA EXEMPLO", "11122233344", "5010,00"), ("BIA EXEMPLO", "22233344455", "1000,00"), ("CAIO EXEMPLO", "33344455566", "2000,00"),
    ]
    rejects = {(r.regra, r.chave) for t in (run.REJECTS_PAYROLL, run.REJECTS_API) for r in wh.read(t, {}).collect()}
    assert {("documento sem bloco", "c.txt"), ("documento sem bloco", "z.txt"), ("pessoa sem cpf", "3"), ("pessoa sem id", "888")} <= rejects
    facts = {run.CONSOL: run.STORED_CONSOL, run.DETAIL: run.STORED_DETAIL}
    ids = {t: [r[0] for r in wh.read_periods(t, schema).orderBy(*list(schema)[1:]).collect()] for t, schema in facts.items()}
    assert all(len(set(x)) == len(x) for x in ids.values())

    run.run_all(wh, docs, people, ts())
    assert snapshot(wh) == first
    assert ids == {t: [r[0] for r in wh.read_periods(t, schema).orderBy(*list(schema)[1:]).collect()] for t, schema in facts.items()}


def test_details_take_the_place_of_list_records(spark, inputs, tmp_path):
    details = tmp_path / "details"
    details.mkdir()
    whole = {**PEOPLE[0], "name": "ANA INTEIRA", "benefits": [{"benefitName": "VR", "value": "R$ 5,00"}]}
    (details / "1.json").write_text(json.dumps(whole, indent=2), encoding="utf-8")
    (details / "9.json").write_text(json.dumps({"id": 9, "name": "NINGUEM"}), encoding="utf-8")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts(), details=scan_employee_json(spark, str(details)))
    rich = {r.colaborador_id_solides: r.nome_completo for r in wh.read(run.RICH, {}).collect()}
    assert rich == {-1: None, 1: "ANA INTEIRA", 2: "DORA"}
    assert [r.nome_beneficio for r in wh.read(run.BENEFITS, {}).collect()] == ["VR"]
    run.load_employees(wh, people, ts(), scan_employee_json(spark, str(tmp_path / "none")))
    assert wh.read(run.RICH, {}).where("colaborador_id_solides = 1").first().nome_completo == "ANA API"


def test_lost_amounts_are_recorded(spark, tmp_path):
    text = SAMPLE.replace("Salário: 5.000,00", "Salário: 100.000.000,00").replace("11,00 550,00 D", "11,00 300.000.000,00 D")
    docs = spark.createDataFrame([("x.txt", text)], "file string, text string")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run.load_payroll(wh, docs)
    fact = wh.read_periods(run.CONSOL, run.STORED_CONSOL).first()
    assert fact.salario_contratual is None and fact.total_proventos == Decimal("5010.00")
    lost = sorted((r.regra, r.chave, float(r.valor)) for r in wh.read(run.REJECTS_PAYROLL, {}).collect())
    assert lost == [("salario_contratual fora da faixa", "x.txt#1", 1e8), ("valor_rubrica fora da faixa", "x.txt#1#1", 3e8)]
    person = {**PEOPLE[0], "benefits": [{"benefitName": "VA", "value": 1e11}, {"benefitName": "VB", "value": 1, "valueDiscount": 2e10}]}
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p.json").write_text(json.dumps([person]), encoding="utf-8")
    run.load_employees(wh, scan_employee_json(spark, str(pages)), ts())
    lost = {(r.regra, r.chave) for r in wh.read(run.REJECTS_API, {}).collect()}
    assert lost == {("valor_beneficio fora da faixa", "1#0"), ("valor_desconto fora da faixa", "1#1")}


def test_a_broken_rule_publishes_nothing(spark, inputs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts())
    before = wh.state()
    long_text = docs.where("file = 'a.txt'").withColumn("text", F.replace("text", F.lit("FINANCEIRO"), F.repeat(F.lit("F"), 256)))
    with pytest.raises(BatchConflict, match="fato_folha_consolidada.centro_de_custo ate 255: 1.*conflitos_folha"):
        run.load_payroll(wh, long_text)
    assert wh.state() == before
    with pytest.raises(BatchConflict, match="rica.cidade ate 100: 1.*conflitos_api"):
        run.load_employees(wh, people.withColumn("address", F.col("address").withField("city.name", F.repeat(F.lit("C"), 101))).where("id = 1"), ts())
    assert wh.state() == before


def test_a_stop_between_writes_and_switch_keeps_all_tables(spark, inputs, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts())
    before = snapshot(wh)

    def dies(*staged):
        raise KeyboardInterrupt

    monkeypatch.setattr(wh, "publish", dies)
    for stage in (
        lambda: run.load_employees(wh, people.withColumn("name", F.lit("OUTRO")), ts()),
        lambda: run.load_payroll(wh, docs.withColumn("text", F.replace("text", F.lit("EXEMPLO"), F.lit("OUTRO")))),
    ):
        with pytest.raises(KeyboardInterrupt):
            stage()
        assert snapshot(Warehouse(spark, wh.root)) == before


def test_partial_upsert_and_transfer(spark, inputs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts())
    changed = people.where("id = 1").withColumns({"education": F.lit("mestrado"), "name": F.lit("ANA 2")})
    run.load_employees(wh, changed, ts())
    row = wh.read(run.RICH, {}).where("colaborador_id_solides = 1").first()
    assert (row.nome_completo, row.escolaridade) == ("ANA 2", "superior")
    # next payroll without BIA, who has no dismissal date but a status by then
    later = docs.where("file = 'a.txt'")
    wh.replace(run.BASE, wh.read(run.BASE, {}).withColumn(
        "situacao_csv", F.when(F.col("cpf").isin("22233344455", "999"), "Férias").otherwise(F.col("situacao_csv"))))
    run.load_payroll(wh, later)
    run.mark_transferred(wh, ts())
    status = {r.cpf: r.situacao_csv for r in wh.read(run.BASE, {}).collect()}
    assert status["22233344455"] == "Transferido" and status["999"] == "Transferido"
    assert wh.read(run.RICH, {}).where("colaborador_id_solides = 2").first().ativo is False
    assert len(snapshot(wh)[run.CONSOL]) == 3  # the March facts stay


def test_conflicts_stop_the_load(spark, inputs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    people = scan_employee_json(spark, inputs[1])
    run.load_employees(wh, people, ts())
    before = snapshot_dims(wh)
    for bad in (people.unionByName(people), people.where("id = 1").withColumn("id", F.lit(9).cast("bigint"))):
        with pytest.raises(BatchConflict):
            run.load_employees(wh, bad, ts())
        assert snapshot_dims(wh) == before


def test_large_ids_and_amounts(spark, inputs, tmp_path):
    """An id beyond 32 bits is one person however often it is loaded; a lost amount leaves a record."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    people = scan_employee_json(spark, inputs[1]).where("id = 1").withColumns(
        {"id": F.lit(3_000_000_000).cast("bigint"), "salary": F.lit(1e12).cast("variant")}
    )
    for _ in range(2):
        run.load_employees(wh, people, ts())
    rich = wh.read(run.RICH, {}).where("colaborador_sk > 0").collect()
    assert [(r.colaborador_id_solides, r.salario_api) for r in rich] == [(3_000_000_000, None)]
    lost = wh.read(run.REJECTS_API, {}).collect()
    assert [(r.regra, r.chave) for r in lost] == [("salario_api fora da faixa", "3000000000")]


def snapshot_dims(wh):
    return [sorted(map(tuple, wh.read(t, {}).collect()), key=repr) for t in (run.BASE, run.RICH, run.BENEFITS)]


def test_empty_inputs_change_nothing(spark, inputs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    docs, people = scan_payslip_text(spark, inputs[0]), scan_employee_json(spark, inputs[1])
    run.run_all(wh, docs, people, ts())
    before = snapshot(wh)
    run.load_payroll(wh, docs.limit(0))
    run.load_employees(wh, people.limit(0), ts())
    assert snapshot(wh) == before


def test_detail_over_list(spark):
    listed = spark.createDataFrame([(1, "l1"), (2, "l2"), (0, "zero"), (None, "none")], "id bigint, name string")
    details = spark.createDataFrame([(1, None)], "id bigint, name string")
    merged = employees.merge_detail_over_list(listed, details)
    assert sorted(map(tuple, merged.collect())) == [(1, None), (2, "l2")]


def test_fixed_schema(spark, inputs):
    staged = employees.flatten_employees(scan_employee_json(spark, inputs[1]))
    assert dict(staged.dtypes) == S.STG_COLABORADORES and len(staged.columns) == 64
    assert star.rich_batch(staged, star.base_with_unknown(spark.createDataFrame([], S.to_ddl(S.DIM_BASE))), ts()).isEmpty()
