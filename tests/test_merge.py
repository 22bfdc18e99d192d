from datetime import date

import pytest
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.operators import checks, keys, merge
from payloom.operators.dedup import first_per_key
from payloom.plans import star
from payloom.sources.tables import Warehouse

BASE = S.to_ddl(S.DIM_BASE)
BATCH = "nome_colaborador string, cpf string, " + ", ".join(f"{c} {S.DIM_BASE[c]}" for c in S.BASE_ATTRIBUTES)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(
        [
            (0, "Desconhecido", "N/A", None, None, None, None, None),
            (1, "ANA", "11", date(2020, 1, 1), None, "Trabalhando", "TI", "DEV"),
            (5, "BIA", "22", None, None, None, "RH", None),
        ],
        BASE,
    )


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(
        [
            ("ANA NOVA", "11", None, date(2023, 1, 1), None, None, "LIDER"),
            ("CAIO", "33", date(2022, 1, 1), None, "Afastado", None, None),
            ("DORA", "44", None, None, None, None, None),
        ],
        BATCH,
    )


def test_upsert_keeps_old_values_and_keys(base, batch):
    once = star.upsert_base(base, batch)
    got = {r.cpf: r for r in once.collect()}
    assert got["11"].nome_colaborador == "ANA NOVA" and got["11"].cargo_csv == "LIDER"
    assert got["11"].data_admissao_csv == date(2020, 1, 1) and got["11"].situacao_csv == "Trabalhando"
    assert got["22"] == next(r for r in base.collect() if r.cpf == "22")
    assert {got["33"].colaborador_sk, got["44"].colaborador_sk} == {6, 7}
    assert rows(star.upsert_base(once, batch)) == rows(once)


def test_api_upsert_touches_only_the_name(base, batch):
    got = {r.cpf: r for r in star.upsert_base_name(base, batch.select("nome_colaborador", "cpf")).collect()}
    assert got["11"].nome_colaborador == "ANA NOVA" and got["11"].cargo_csv == "DEV"
    assert got["33"].situacao_csv is None


def test_keys_are_dense_and_repeatable(spark):
    new = spark.range(5000).select(F.format_string("%011d", "id").alias("cpf"))
    current = spark.createDataFrame([(7, "x")], "sk int, cpf string")
    first = keys.assign_keys(new, current, "cpf", "sk")
    again = keys.assign_keys(new.repartition(13), current, "cpf", "sk")
    assert rows(first.select("cpf", "sk")) == rows(again.select("cpf", "sk"))
    assert sorted(r.sk for r in first.collect()) == list(range(8, 5008))
    empty = keys.assign_keys(new, current.limit(0), "cpf", "sk")
    assert empty.agg(F.min("sk"), F.max("sk")).first() == (1, 5000)


def test_first_per_key_with_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("cpf"),
        F.when(F.col("id") != 6, F.format_string("N%05d", "id")).alias("nome"),
        F.col("id").alias("x"),
    )
    got = first_per_key(df, "cpf", ("nome",))
    assert got.count() == 20001
    assert tuple(got.where("cpf = 'hot'").first()) == ("hot", None, 6)  # NULL comes first


def test_lookup_and_unknown(spark, base):
    facts = spark.createDataFrame([("11", 1), (None, 2), ("99", 3), (None, 4)], "cpf_csv string, v int")
    got = keys.lookup_surrogate_key(facts, base, "cpf_csv", "cpf", "colaborador_sk")
    assert rows(got) == [(0, "99", 3), (0, None, 2), (0, None, 4), (1, "11", 1)]
    assert rows(star.base_with_unknown(star.base_with_unknown(base))) == rows(base)
    assert star.base_with_unknown(base.limit(0)).collect()[0].cpf == "N/A"


FACT = "v int, competencia date"
OLD = [(1, date(2023, 1, 1)), (2, date(2023, 2, 1)), (3, None)]
NEW = [(20, date(2023, 2, 1)), (21, date(2023, 2, 1)), (30, None), (40, date(2023, 3, 1))]
WANT = sorted([OLD[0], *NEW], key=repr)


def test_replace_by_period(spark, tmp_path):
    old, new = spark.createDataFrame(OLD, FACT), spark.createDataFrame(NEW, FACT)
    once = merge.replace_by_period(old, new)
    assert rows(once) == WANT and rows(merge.replace_by_period(once, new)) == WANT
    wh = Warehouse(spark, str(tmp_path))
    assert not wh.has_periods("f") and wh.read_periods("f", S.ddl(FACT)).isEmpty()
    for batch in (old, new, new):
        wh.replace_periods("f", batch)
    assert rows(wh.read_periods("f", S.ddl(FACT))) == WANT
    assert wh.stage_periods("f", new.limit(0))[1].isEmpty()
    assert merge.has_period(new) and not merge.has_period(new.where("competencia is null"))


def test_insert_ignore_and_policies(spark):
    cur = spark.createDataFrame([(1, "a", "x")], "k int, a string, b string")
    new = spark.createDataFrame([(1, None, None), (2, "c", "z")], "k int, a string, b string")
    assert rows(merge.insert_ignore(cur, new, "k")) == [(1, "a", "x"), (2, "c", "z")]
    merged = merge.upsert(cur, new, "k", {"a": "overwrite", "b": "coalesce"})
    assert rows(merged) == [(1, None, "x"), (2, "c", "z")]
    kept = merge.upsert(cur, new.select("k", "b"), "k", {})
    assert rows(kept) == [(1, "a", "x"), (2, None, "z")]
    assert merge.upsert(cur, new, "k", {})._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_versions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    one, two = spark.range(1), spark.range(2)
    assert not wh.exists("t") and wh.read("t", {"id": "bigint"}).isEmpty()
    wh.replace("t", one)
    staged, _ = wh.stage("t", two)
    assert wh.read("t", {}).count() == 1
    wh.publish(staged)
    assert wh.read("t", {}).count() == 2
    wh.replace("t", wh.read("t", {}).unionByName(one))  # reads the old version while writing
    assert wh.read("t", {}).count() == 3


def test_a_stop_before_the_switch_changes_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    old, new = spark.createDataFrame(OLD, FACT), spark.createDataFrame(NEW, FACT)
    wh.publish(wh.stage("dim", spark.range(1))[0], wh.stage_periods("f", old)[0])
    before = wh.state()
    dim, fact = wh.stage("dim", spark.range(2))[0], wh.stage_periods("f", new)[0]
    # the record itself is written, but the driver dies before it gets its name
    hidden = tmp_path / "_commits" / ".half"
    hidden.write_text('{"dim": {"ver')
    again = Warehouse(spark, str(tmp_path))
    assert again.state() == before and again.read("dim", {}).count() == 1
    assert rows(again.read_periods("f", S.ddl(FACT))) == sorted(OLD, key=repr)
    again.publish(dim, fact)
    assert again.read("dim", {}).count() == 2 and rows(again.read_periods("f", S.ddl(FACT))) == WANT
    untouched = again.state()["f"]["periods"]["competencia=2023-01-01"]
    assert untouched == before["f"]["periods"]["competencia=2023-01-01"]
    (tmp_path / "_commits" / f"{len(again.commits()) + 1:08d}.json").mkdir()  # another writer was first
    with pytest.raises(Exception):
        again.publish(dim)


def test_superseded_folders_go(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    jan, both = spark.createDataFrame(OLD[:1], FACT), spark.createDataFrame(OLD, FACT)
    wh.replace_periods("f", both)
    for n in range(1, 5):
        wh.replace("t", spark.range(n))
        wh.replace_periods("f", jan)
    running, _ = wh.stage("t", spark.range(9))
    assert wh.drop_superseded(keep=10) == []
    dropped = wh.drop_superseded(keep=1)
    assert sorted(dropped) == [f"f/load={n:08d}" for n in (2, 3, 4)] + [f"t/version={n:08d}" for n in (1, 2, 3)]
    assert len(wh.commits()) == 1 and wh.read("t", {}).count() == 4
    assert rows(wh.read_periods("f", S.ddl(FACT))) == sorted(OLD, key=repr)
    wh.publish(running)
    assert wh.read("t", {}).count() == 9


def test_row_numbers_stay(spark):
    def load(name, n):
        return spark.range(n).select(
            F.lit(name).alias("file"), (F.col("id") % 50).cast("int").alias("pos"), (F.col("id") / 50).cast("int").alias("item"),
            F.when(F.col("id") % 3 > 0, F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 3).cast("int"))).alias("competencia"),
        )

    first = keys.number_rows(load("a", 6000), "n", ["file", "pos", "item"], "competencia")
    again = keys.number_rows(load("a", 6000).repartition(7), "n", ["file", "pos", "item"], "competencia")
    assert rows(first) == rows(again) and first.select("n").distinct().count() == 6000
    per = first.groupBy("competencia").agg(F.min("n").alias("a"), F.max("n").alias("b")).collect()
    assert all(r.b - r.a == 1999 for r in per) and min(r.a for r in per) == 1
    # a larger batch of another day leaves the numbers of this day alone
    day = "competencia = '2023-01-02'"
    more = load("a", 6000).where(day).unionByName(load("b", 9000).where(f"NOT {day} OR competencia IS NULL"))
    numbered = keys.number_rows(more, "n", ["file", "pos", "item"], "competencia").where(day)
    assert rows(numbered) == rows(first.where(day))


def test_status_pass(spark):
    people = [
        (1, "A", "1", None, None, None, None, None), (2, "B", "2", None, None, "Desligado", None, None),
        (3, "C", "3", None, None, "Trabalhando", None, None),
        (4, "D", "4", None, date(2023, 1, 1), "Trabalhando", None, None),
        (5, "E", "5", None, None, "Trabalhando", None, None), (6, "F", "6", None, None, "Afastado", None, None),
    ]
    base = spark.createDataFrame(people, BASE)
    api = spark.createDataFrame([("5",), (None,), ("5",)], "cpf string")
    payroll = spark.createDataFrame([("6",), ("6",), (None,)], "cpf string")
    got = {r.cpf: r.situacao_csv for r in star.mark_transferred(base, api, payroll).collect()}
    assert got == {"1": None, "2": "Desligado", "3": "Transferido", "4": "Trabalhando", "5": "Trabalhando", "6": "Afastado"}
    absent = star.absent_from_both(base, api, payroll)
    assert sorted(r.cpf for r in absent.collect()) == ["1", "2", "3", "4"]


def test_checks(spark, base):
    facts = spark.createDataFrame([(1, "1" * 12), (9, "2"), (9, "2"), (None, "3")], "colaborador_sk int, cpf_csv string")
    report = star.integrity(base, None, {"fato": facts})
    assert rows(report) == [("fato.colaborador_sk existe", "9", 2), ("fato.cpf_csv ate 11", "1" * 12, 1)]
    nameless = base.withColumns({"nome_colaborador": F.lit(None).cast("string"), "cargo_csv": F.repeat(F.lit("x"), 256)})
    found = {(r.regra, r.n) for r in star.integrity(nameless, None, {}).collect()}
    assert found == {("base.nome nao nulo", 3), ("base.cargo_csv ate 255", 3)}
    again = facts.withColumn("beneficio_id", F.lit(1))
    assert ("fato.beneficio_id unico", "1", 4) in rows(star.integrity(base, None, {"fato": again}))
    twice = base.unionByName(base)
    with pytest.raises(checks.BatchConflict, match="base.cpf unico: 3; all keys are in report"):
        checks.require_clean(checks.duplicates(twice, "cpf", "base.cpf unico"), "report")
