"""Warehouse queries: keys, merges, facts, status pass, checks and table sinks.

People are customers.  Those of nations 0..12 are already in the dimension; payroll
batches come from orders and employee batches from all customers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.operators import checks, keys, merge
from payloom.functions.text import null_name_salt
from payloom.operators.conform import add_columns, conform
from payloom.operators.dedup import first_per_key
from payloom.plans import employees, payslips, run, star
from payloom.session import settle, work_folder
from payloom.sources.rubrics import scan_rubric_map
from payloom.sources.tables import Warehouse
from workloads.documents import DETAIL_SQL, TYPED_SQL, typed_records
from workloads.people import parsed
from workloads.registry import query, table
from workloads.render import (
    EMPLOYEE_DOUBLES, EMPLOYEE_SQL, as_text, cents, cpf_digits, expected_as_text, stored, text_of,
    when_mod,
)

RUN_TS = "2024-01-31 12:00:00"
KNOWN = "c_nationkey < 13"


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


# -- rendered state ------------------------------------------------------------------


def person_rows(spark: SparkSession, sf: str, known_only: bool = True) -> DataFrame:
    """Stored person dimension; the key is the customer key + 1."""
    people = table(spark, sf, "customer")
    people = people.where(KNOWN) if known_only else people
    k = F.col("c_custkey")
    first = F.date_add(F.lit("2000-01-01").cast("date"), (k % 3000).cast("int"))
    return people.select(
        (k + 1).cast("int").alias("colaborador_sk"),
        F.col("c_name").alias("nome_colaborador"),
        cpf_digits(k * 10 + 1).alias("cpf"),
        F.when(k % 3 != 0, first).alias("data_admissao_csv"),
        F.when(k % 10 == 0, F.date_add(first, 400)).alias("data_demissao_csv"),
        when_mod(
            k, 5, {0: F.lit(None), 1: F.lit("Desligado"), 2: F.lit("Transferido")}, F.lit("Trabalhando")
        ).alias("situacao_csv"),
        F.col("c_mktsegment").alias("departamento_csv"),
        F.when(k % 4 != 0, text_of("CARGO ", k % 9)).alias("cargo_csv"),
    )


PERSON = """SELECT c_custkey + 1 AS colaborador_sk, c_name AS nome_colaborador,
  lpad(CAST(c_custkey * 10 + 1 AS VARCHAR), 11, '0') AS cpf,
  CASE WHEN c_custkey % 3 <> 0 THEN DATE '2000-01-01' + CAST(c_custkey % 3000 AS INT) END AS data_admissao_csv,
  CASE WHEN c_custkey % 10 = 0 THEN DATE '2000-01-01' + CAST(c_custkey % 3000 AS INT) + 400 END
    AS data_demissao_csv,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Desligado' WHEN 2 THEN 'Transferido'
    ELSE 'Trabalhando' END AS situacao_csv,
  c_mktsegment AS departamento_csv,
  CASE WHEN c_custkey % 4 <> 0 THEN 'CARGO ' || (c_custkey % 9) END AS cargo_csv FROM customer"""
CUR = f"cur AS ({PERSON} WHERE {KNOWN})"
EVERYONE = f"cur AS ({PERSON})"
BASE_OUT = "colaborador_sk, nome_colaborador, cpf, CAST(data_admissao_csv AS VARCHAR) AS data_admissao_csv, " \
           "CAST(data_demissao_csv AS VARCHAR) AS data_demissao_csv, situacao_csv, departamento_csv, cargo_csv"


def payroll_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed consolidated records, one per order, with NULL and invalid keys among them."""
    o = table(spark, sf, "orders")
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    money = (cents(F.col("o_totalprice")) / 100).cast("decimal(10,2)")
    return o.select(
        k.cast("string").alias("file"),
        F.when(k % 19 != 0, F.trunc(d, "MM")).alias("competencia"),
        F.lit("Folha Mensal").alias("tipo_calculo"),
        F.when(k % 3 != 0, text_of("DEP ", k % 10)).alias("departamento"),
        F.when(k % 17 != 0, text_of("FUNC ", c, " ", F.col("o_orderpriority"))).alias("nome_funcionario"),
        F.when(F.col("o_orderstatus") == "F", "Trabalhando")
        .when(F.col("o_orderstatus") == "O", "Afastado")
        .alias("situacao"),
        F.when(k % 7 == 0, F.date_add(d, 30)).alias("data_demissao"),
        text_of("CARGO ", k % 7).alias("cargo"),
        d.alias("data_admissao"),
        when_mod(c, 13, {0: F.lit(None), 1: F.lit("N/A")}, cpf_digits(c * 10 + 1)).alias("cpf"),
        *(money.alias(name) for name in S.CONSOL_MONEY),
    )


REC = """rec AS (SELECT CAST(o_orderkey AS VARCHAR) AS file, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderkey % 19 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS competencia,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'DEP ' || (o_orderkey % 10) END AS departamento,
  CASE WHEN o_orderkey % 17 <> 0 THEN 'FUNC ' || o_custkey || ' ' || o_orderpriority END AS nome,
  CASE o_orderstatus WHEN 'F' THEN 'Trabalhando' WHEN 'O' THEN 'Afastado' END AS situacao,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS data_demissao,
  'CARGO ' || (o_orderkey % 7) AS cargo, CAST(o_orderdate AS DATE) AS data_admissao,
  CASE o_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'N/A'
    ELSE lpad(CAST(o_custkey * 10 + 1 AS VARCHAR), 11, '0') END AS cpf,
  CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS valor FROM orders)"""
BAT = REC + """, bat AS (SELECT * FROM (SELECT cpf, nome AS nome_colaborador, data_admissao AS data_admissao_csv,
  data_demissao AS data_demissao_csv, situacao AS situacao_csv, departamento AS departamento_csv,
  cargo AS cargo_csv, row_number() OVER (PARTITION BY cpf ORDER BY nome DESC NULLS FIRST,
    data_admissao DESC NULLS LAST, data_demissao DESC NULLS LAST, situacao DESC NULLS LAST,
    departamento DESC NULLS LAST, cargo DESC NULLS LAST) AS rn
  FROM rec WHERE cpf IS NOT NULL AND cpf <> 'N/A' AND nome IS NOT NULL) WHERE rn = 1)"""


def numbered(batch: str, start: str = "SELECT max(colaborador_sk) FROM cur") -> str:
    return (
        f"fresh AS (SELECT ({start}) + row_number() OVER (ORDER BY substr(md5(b.cpf), 1, 3), b.cpf) "
        f"AS colaborador_sk, b.* FROM {batch} b WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.cpf = b.cpf))"
    )


# -- dimension -----------------------------------------------------------------------


@query(
    "project_base_columns",
    f"WITH {REC} SELECT cpf, nome AS nome_colaborador, CAST(data_admissao AS VARCHAR) AS data_admissao_csv, "
    "CAST(data_demissao AS VARCHAR) AS data_demissao_csv, situacao AS situacao_csv, "
    "departamento AS departamento_csv, cargo AS cargo_csv FROM rec",
)
def project_base_columns(spark, sf):
    return star.project_base(payroll_rows(spark, sf))


@query(
    "filter_valid_key",
    f"WITH {REC} SELECT cpf, count(*) AS n FROM rec WHERE cpf IS NOT NULL AND cpf <> 'N/A' AND cpf <> 'nan' "
    "GROUP BY cpf",
)
def filter_valid_key(spark, sf):
    kept = payroll_rows(spark, sf).where(star.valid_key(F.col("cpf"), "nan"))
    return kept.groupBy("cpf").agg(F.count(F.lit(1)).alias("n"))


@query(
    "distinct_on_name_desc",
    f"WITH {BAT} SELECT cpf, nome_colaborador, CAST(data_admissao_csv AS VARCHAR) AS data_admissao_csv, "
    "CAST(data_demissao_csv AS VARCHAR) AS data_demissao_csv, situacao_csv, departamento_csv, cargo_csv FROM bat",
)
def distinct_on_name_desc(spark, sf):
    return star.base_batch(payroll_rows(spark, sf))


API_ROWS = """api AS (SELECT CASE o_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' WHEN 2 THEN 'nan'
  ELSE lpad(CAST(o_custkey * 10 + 1 AS VARCHAR), 11, '0') END AS cpf, 'NOME ' || o_orderkey AS nome,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS id FROM orders)"""
API_BAT = API_ROWS + """, bat AS (SELECT cpf, nome AS nome_colaborador FROM (SELECT *, row_number() OVER
  (PARTITION BY cpf ORDER BY id DESC NULLS FIRST, nome DESC) AS rn FROM api
  WHERE cpf IS NOT NULL AND cpf NOT IN ('N/A', 'nan')) WHERE rn = 1)"""


def api_rows(spark, sf):
    """Employee list with several ids per person, one row per order."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        when_mod(c, 13, {0: F.lit(None), 1: F.lit("N/A"), 2: F.lit("nan")}, cpf_digits(c * 10 + 1)).alias("cpf"),
        text_of("NOME ", k).alias("nome_completo"),
        F.when(k % 11 != 0, k).alias("colaborador_id_solides"),
    )


@query("distinct_on_id_desc", f"WITH {API_BAT} SELECT cpf, nome_colaborador FROM bat")
def distinct_on_id_desc(spark, sf):
    return star.base_batch_from_api(api_rows(spark, sf))


@query(
    "surrogate_key_assign",
    f"WITH {CUR}, {BAT}, {numbered('bat')} SELECT colaborador_sk, cpf, nome_colaborador FROM fresh",
)
def surrogate_key_assign(spark, sf):
    current = person_rows(spark, sf)
    batch = settle(star.base_batch(payroll_rows(spark, sf)), "batch")
    highest = current.select(F.max("colaborador_sk")).scalar()
    merged = star.upsert_base(current, batch).where(F.col("colaborador_sk") > highest)
    return merged.select("colaborador_sk", "cpf", "nome_colaborador")


def row_number_sql(period: str, keys: str, order: str) -> str:
    return (
        f"(CASE WHEN {period} IS NULL THEN 0 ELSE date_diff('day', DATE '0001-01-01', {period}) + 1 END) * 1099511627776 "
        f"+ row_number() OVER (PARTITION BY {period} ORDER BY substr(md5({keys}), 1, 3), {order})"
    )


@query(
    "surrogate_key_facts",
    f"""WITH {REC}, it AS (SELECT CAST(l_orderkey AS VARCHAR) AS file, l_linenumber AS pos, l_linenumber % 3 AS item,
    CASE WHEN l_partkey % 9 <> 0 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS competencia FROM lineitem),
  ben AS (SELECT c_custkey AS k, b FROM customer, (VALUES (0), (1), (2)) v(b)
    WHERE c_custkey % 23 <> 0 AND c_custkey % 8 <> 0 AND b < c_custkey % 4)
  SELECT 'folha' AS tabela, file || '#0' AS chave, {row_number_sql("competencia", "file || '#0'", "file")} AS id FROM rec
  UNION ALL SELECT 'rubrica', file || '#' || pos || '#' || item,
    {row_number_sql("competencia", "file || '#' || pos || '#' || item", "file, pos, item")} FROM it
  UNION ALL SELECT 'beneficio', k || '#' || b,
    row_number() OVER (ORDER BY substr(md5(k || '#' || b), 1, 3), k, b) FROM ben""",
)
def surrogate_key_facts(spark, sf):
    """Row numbers of the three facts: equal for equal rows, whatever order they come in."""
    folha = settle(payroll_rows(spark, sf).withColumn("pos", F.lit(0)), "folha")
    month = F.when(F.col("l_partkey") % 9 != 0, F.trunc("l_shipdate", "MM"))
    line = F.col("l_linenumber")
    rubrica = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file"), line.alias("pos"), (line % 3).alias("item"), month.alias("competencia")
    )
    beneficio = settle(employees.explode_benefits(parsed(spark, sf)).where("colaborador_id_solides is not null"), "beneficios")

    def shown(name, df, id_column, *parts):
        return df.select(
            F.lit(name).alias("tabela"), F.concat_ws("#", *(F.col(c).cast("string") for c in parts)).alias("chave"),
            F.col(id_column).alias("id"),
        )

    return reduce(
        DataFrame.unionByName,
        (
            shown("folha", star.number_consolidated(folha), "fato_folha_id", "file", "pos"),
            shown("rubrica", star.number_detail(settle(rubrica, "rubricas")), "fato_rubrica_id", "file", "pos", "item"),
            shown("beneficio", star.number_benefits(beneficio), "beneficio_id", "colaborador_id_solides", "ordem"),
        ),
    )


UNKNOWN = "SELECT 0 AS colaborador_sk, 'Desconhecido' AS nome_colaborador, 'N/A' AS cpf, " \
          "NULL AS data_admissao_csv, NULL AS data_demissao_csv, NULL AS situacao_csv, " \
          "NULL AS departamento_csv, NULL AS cargo_csv"


@query("unknown_member", f"WITH {CUR} SELECT {BASE_OUT} FROM cur UNION ALL {UNKNOWN}")
def unknown_member(spark, sf):
    """Seeding twice adds one row."""
    return star.base_with_unknown(star.base_with_unknown(person_rows(spark, sf)))


@query(
    "insert_ignore",
    f"WITH {CUR}, novo AS ({PERSON}) SELECT {BASE_OUT} FROM cur UNION ALL "
    f"SELECT {BASE_OUT} FROM (SELECT * REPLACE (colaborador_sk + 1000000 AS colaborador_sk) FROM novo n "
    "WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.cpf = n.cpf))",
)
def insert_ignore(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    offered = everyone.withColumn("colaborador_sk", F.col("colaborador_sk") + 1000000)
    return merge.insert_ignore(person_rows(spark, sf), offered, "cpf")


MERGED = (
    "SELECT cur.colaborador_sk, coalesce(bat.nome_colaborador, cur.nome_colaborador) AS nome_colaborador, cur.cpf, "
    + ", ".join(f"coalesce(bat.{c}, cur.{c}) AS {c}" for c in S.BASE_ATTRIBUTES)
    + " FROM cur LEFT JOIN bat USING (cpf) UNION ALL SELECT colaborador_sk, nome_colaborador, cpf, "
    + ", ".join(S.BASE_ATTRIBUTES)
    + " FROM fresh"
)


@query("upsert_scd1_coalesce", f"WITH {CUR}, {BAT}, {numbered('bat')}, m AS ({MERGED}) SELECT {BASE_OUT} FROM m")
def upsert_scd1_coalesce(spark, sf):
    batch = settle(star.base_batch(payroll_rows(spark, sf)), "batch")
    return star.upsert_base(person_rows(spark, sf), batch)


@query(
    "upsert_name_only",
    f"WITH {CUR}, {API_BAT}, {numbered('bat')}, m AS (SELECT cur.* REPLACE "
    "(coalesce(bat.nome_colaborador, cur.nome_colaborador) AS nome_colaborador) FROM cur LEFT JOIN bat USING (cpf) "
    "UNION ALL SELECT colaborador_sk, nome_colaborador, cpf, NULL, NULL, NULL, NULL, NULL FROM fresh) "
    f"SELECT {BASE_OUT} FROM m",
)
def upsert_name_only(spark, sf):
    batch = settle(star.base_batch_from_api(api_rows(spark, sf)), "batch")
    return star.upsert_base_name(person_rows(spark, sf), batch)


@query(
    "schema_evolve_add_columns",
    "SELECT c_custkey + 1 AS colaborador_sk, c_name AS nome_colaborador, "
    "lpad(CAST(c_custkey * 10 + 1 AS VARCHAR), 11, '0') AS cpf, 'nova' AS data_admissao_csv, "
    "'nova' AS data_demissao_csv, 'nova' AS situacao_csv, 'nova' AS departamento_csv, 'nova' AS cargo_csv "
    "FROM customer",
)
def schema_evolve_add_columns(spark, sf):
    """An old three-column table with a legacy column; evolving twice equals evolving once."""
    old = person_rows(spark, sf, known_only=False).select(
        "colaborador_sk", "nome_colaborador", "cpf", F.lit(1.0).alias("total_benefits_api")
    )
    once = add_columns(old, S.DIM_BASE, drop=("total_benefits_api",))
    twice = add_columns(once, S.DIM_BASE, drop=("total_benefits_api",))
    return twice.select(
        *(
            F.coalesce(F.col(c).cast("string"), F.lit("nova")).alias(c) if c in S.BASE_ATTRIBUTES else F.col(c)
            for c in twice.columns
        )
    )


# -- lookups and facts ---------------------------------------------------------------


@query(
    "join_fact_surrogate_key",
    f"WITH {CUR} SELECT l_orderkey, l_linenumber, coalesce(colaborador_sk, 0) AS colaborador_sk, l_extendedprice "
    "FROM lineitem LEFT JOIN cur ON l_partkey % 3 <> 0 AND cpf = lpad(CAST(l_suppkey * 10 + 1 AS VARCHAR), 11, '0')",
)
def join_fact_surrogate_key(spark, sf):
    """A third of the fact keys is NULL."""
    facts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_partkey") % 3 != 0, cpf_digits(F.col("l_suppkey") * 10 + 1)).alias("cpf_csv"),
    )
    keyed = keys.lookup_surrogate_key(facts, person_rows(spark, sf), "cpf_csv", "cpf", "colaborador_sk")
    return keyed.drop("cpf_csv")


@query(
    "default_coalesce",
    f"WITH {CUR}, {REC} SELECT file, coalesce(rec.cargo, cargo_csv) AS cargo, "
    "coalesce(departamento, departamento_csv, 'SEM DEPARTAMENTO') AS departamento, "
    "coalesce(colaborador_sk, 0) AS colaborador_sk FROM rec LEFT JOIN cur USING (cpf)",
)
def default_coalesce(spark, sf):
    rows = payroll_rows(spark, sf).select("file", "cpf", "cargo", "departamento")
    keyed = rows.withColumn("_key", null_name_salt(F.col("cpf"), F.col("file"))).join(
        person_rows(spark, sf).withColumnRenamed("cpf", "_key"), "_key", "left"
    )
    return keyed.select(
        "file",
        F.coalesce("cargo", "cargo_csv").alias("cargo"),
        F.coalesce("departamento", "departamento_csv", F.lit("SEM DEPARTAMENTO")).alias("departamento"),
        F.coalesce("colaborador_sk", F.lit(S.UNKNOWN_SK)).alias("colaborador_sk"),
    )


def staged_employees(spark, sf):
    return employees.flatten_employees(parsed(spark, sf))


@query(
    "join_inner_dim_enrich",
    f"{EMPLOYEE_SQL}, {CUR} SELECT colaborador_sk, colaborador_id_solides, nome_completo FROM emp JOIN cur "
    "USING (cpf) WHERE colaborador_id_solides IS NOT NULL",
)
def join_inner_dim_enrich(spark, sf):
    rows = staged_employees(spark, sf).select("cpf", "colaborador_id_solides", "nome_completo").where(
        "colaborador_id_solides is not null"
    )
    return keys.enrich_inner(rows, person_rows(spark, sf), "cpf", "colaborador_sk").drop("cpf")


BENEFITS_SQL = f"""{EMPLOYEE_SQL}, {CUR} SELECT colaborador_sk, c_mktsegment AS tipo_beneficio,
  'BENEFICIO ' || b AS nome_beneficio, CAST(ben.k * 100 + b AS DOUBLE) / 100 AS valor_beneficio,
  CAST(ben.k + b AS DOUBLE) AS valor_desconto, 'mensal' AS periodicidade, 'opcao ' || (ben.k % 3) AS opcao_desconto,
  'folha' AS aplicado_como, '{RUN_TS}' AS data_atualizacao
  FROM ben JOIN emp ON emp.colaborador_id_solides = ben.k JOIN cur USING (cpf)"""


def benefit_rows(spark, sf):
    return star.benefits_fact(
        employees.explode_benefits(parsed(spark, sf)), staged_employees(spark, sf), person_rows(spark, sf), run_ts()
    )


@query("join_three_way_benefits", BENEFITS_SQL)
def join_three_way_benefits(spark, sf):
    return benefit_rows(spark, sf)


@query("truncate_insert", BENEFITS_SQL)
def truncate_insert(spark, sf):
    """A second full refresh replaces what the first one wrote."""
    wh = Warehouse(spark, work_folder(spark, "refresh"))
    rows = benefit_rows(spark, sf)
    wh.replace(run.BENEFITS, rows.withColumn("nome_beneficio", F.lit("antigo")))
    wh.replace(run.BENEFITS, rows)
    return wh.read(run.BENEFITS, S.FATO_BENEFICIOS)


FACT_OUT = "colaborador_sk, nome AS nome_funcionario_csv, departamento AS centro_de_custo, cargo AS cargo_nome_csv, " \
           "cpf AS cpf_csv, situacao AS situacao_csv, 'Folha Mensal' AS tipo_calculo_csv, " \
           + ", ".join(f"valor AS {c}" for c in S.CONSOL_MONEY) + \
           ", file AS arquivo_origem, CAST(competencia AS VARCHAR) AS competencia"
KEYED = f"{CUR}, {REC}, keyed AS (SELECT coalesce(colaborador_sk, 0) AS colaborador_sk, rec.* FROM rec " \
        "LEFT JOIN cur USING (cpf))"


@query("sink_table", f"WITH {KEYED} SELECT {FACT_OUT} FROM keyed")
def sink_table(spark, sf):
    wh = Warehouse(spark, work_folder(spark, "sink"))
    wh.replace_periods(run.CONSOL, star.consolidated_fact(payroll_rows(spark, sf), person_rows(spark, sf)))
    return wh.read_periods(run.CONSOL, S.FATO_CONSOLIDADA)


# Old rows end in 1998, the batch starts in 1998: the months of 1998 are replaced.
REPLACED = f"""WITH {KEYED}, antigo AS (SELECT * REPLACE ('ANTIGO' AS cargo) FROM keyed WHERE d < '1999-01-01'),
lote AS (SELECT * FROM keyed WHERE d >= '1998-01-01'), novo AS (SELECT * FROM antigo a WHERE NOT EXISTS
  (SELECT 1 FROM lote WHERE lote.competencia IS NOT DISTINCT FROM a.competencia) UNION ALL SELECT * FROM lote)
SELECT {FACT_OUT} FROM novo"""


def old_and_batch(spark, sf):
    records, base = payroll_rows(spark, sf), person_rows(spark, sf)
    old = records.where("data_admissao < date'1999-01-01'").withColumn("cargo", F.lit("ANTIGO"))
    batch = records.where("data_admissao >= date'1998-01-01'")
    return star.consolidated_fact(old, base), star.consolidated_fact(batch, base)


@query("replace_by_period", REPLACED)
def replace_by_period(spark, sf):
    """Stored facts: a load dies before its record is written, and is repeated."""
    old, batch = old_and_batch(spark, sf)
    wh = Warehouse(spark, work_folder(spark, "periods"))
    wh.replace_periods(run.CONSOL, old)
    wh.stage_periods(run.CONSOL, batch)
    wh.replace_periods(run.CONSOL, batch)
    return wh.read_periods(run.CONSOL, S.FATO_CONSOLIDADA)


@query("replace_by_period_pure", REPLACED)
def replace_by_period_pure(spark, sf):
    return merge.replace_by_period(*old_and_batch(spark, sf))


@query("sink_staging_replace", f"WITH {REC} SELECT file, cpf, nome FROM rec")
def sink_staging_replace(spark, sf):
    wh = Warehouse(spark, work_folder(spark, "staging"))
    rows = payroll_rows(spark, sf).select("file", "cpf", F.col("nome_funcionario").alias("nome"))
    wh.replace(run.STG_PAYROLL, rows.limit(0))
    return wh.replace(run.STG_PAYROLL, rows)


ATOMIC = f"""{EMPLOYEE_SQL}, {EVERYONE}, rows AS (
  SELECT 'base' AS tabela, cpf AS chave, nome_colaborador AS nome FROM cur
  UNION ALL SELECT 'rica', CAST(c_custkey AS VARCHAR), 'ANTIGO ' || c_custkey FROM customer
    WHERE {KNOWN} AND c_custkey % 23 <> 0 AND c_custkey % 31 <> 0
  UNION ALL SELECT 'beneficios', CAST(ben.k + 1 AS VARCHAR), 'BENEFICIO ' || b
    FROM ben JOIN emp ON emp.colaborador_id_solides = ben.k JOIN cur USING (cpf))
SELECT 'antes' AS momento, * FROM rows UNION ALL SELECT 'depois', tabela, chave, 'NOVO ' || nome FROM rows"""


@query("atomic_batch", ATOMIC)
def atomic_batch(spark, sf):
    """The tables of a stage stay as they were until one record makes all new versions current."""
    wh = Warehouse(spark, work_folder(spark, "atomic"))
    base = person_rows(spark, sf, known_only=False)
    benefits = star.benefits_fact(employees.explode_benefits(parsed(spark, sf)), staged_employees(spark, sf), base, run_ts())
    named = {
        run.BASE: ("base", "cpf", "nome_colaborador", base),
        run.RICH: ("rica", "colaborador_id_solides", "nome_completo", rich_rows(spark, sf)),
        run.BENEFITS: ("beneficios", "colaborador_sk", "nome_beneficio", benefits),
    }
    wh.publish(*(wh.stage(t, rows)[0] for t, (_, _, _, rows) in named.items()))
    renamed = {
        t: wh.read(t, {}).withColumn(name, F.concat(F.lit("NOVO "), name)) for t, (_, _, name, _) in named.items()
    }
    staged = [wh.stage(t, rows)[0] for t, rows in renamed.items()]

    def shown(moment: str) -> DataFrame:
        tables = (
            wh.read(t, {}).select(
                F.lit(moment).alias("momento"), F.lit(short).alias("tabela"), F.col(key).cast("string").alias("chave"),
                F.col(name).alias("nome"),
            )
            for t, (short, key, name, _) in named.items()
        )
        return reduce(DataFrame.unionByName, tables)

    before = shown("antes")
    wh.publish(*staged)
    return before.unionByName(shown("depois"))


# -- rich dimension ------------------------------------------------------------------

OLD_TS = "2020-01-01 00:00:00"


def rich_rows(spark, sf):
    """Stored rich dimension: known customers that have an API id and a cpf."""
    k = F.col("c_custkey")
    old = table(spark, sf, "customer").where(KNOWN).where((k % 23 != 0) & (k % 31 != 0)).select(
        (k + 1).alias("colaborador_sk"),
        k.alias("colaborador_id_solides"),
        cpf_digits(k * 10 + 1).alias("cpf"),
        text_of("ANTIGO ", k).alias("nome_completo"),
        F.lit("ANTIGA").alias("matricula"),
        F.lit(10).alias("salario_api"),
        (k % 2 == 0).alias("ativo"),
        F.lit("ANTIGA").alias("escolaridade"),
        F.lit(1).alias("valor_rescisao"),
        F.lit(OLD_TS).cast("timestamp").alias("data_ultima_atualizacao"),
    )
    return conform(old, S.DIM_RICH)


RICH_CUR = f"""rica AS (SELECT c_custkey + 1 AS colaborador_sk, c_custkey AS id, c_custkey % 2 = 0 AS ativo
  FROM customer WHERE {KNOWN} AND c_custkey % 23 <> 0 AND c_custkey % 31 <> 0)"""


# What stays of a stored row: the insert-only columns that `rich_rows` fills.
RICH_KEPT = {"escolaridade": "'ANTIGA'", "valor_rescisao": "1.0"}


def _rich_column(c: str) -> str:
    if c == "data_ultima_atualizacao":
        new = f"'{RUN_TS}'"
    elif c in S.API_MONEY:
        new = f"CAST(round(l.{c} * 100) AS BIGINT) / 100"
    elif c == "email":
        new = "CAST(NULL AS VARCHAR)"
    else:
        new = f"CAST(l.{c} AS VARCHAR)"
    if c in S.RICH_INSERT_ONLY:
        new = f"CASE WHEN r.id IS NULL THEN {new} ELSE {RICH_KEPT.get(c, 'NULL')} END"
    return f"{new} AS {c}"


RICH_OTHERS = [c for c in S.DIM_RICH if c not in ("colaborador_sk", "colaborador_id_solides")]


@query(
    "upsert_partial_columns",
    f"""{EMPLOYEE_SQL}, {RICH_CUR}, lote AS (SELECT k + 1 AS sk, emp.* FROM emp
  WHERE colaborador_id_solides IS NOT NULL AND cpf IS NOT NULL)
  SELECT CAST(l.sk AS VARCHAR) AS colaborador_sk, CAST(l.k AS VARCHAR) AS colaborador_id_solides,
    {", ".join(map(_rich_column, RICH_OTHERS))}
  FROM lote l LEFT JOIN rica r ON r.id = l.k
  UNION ALL SELECT '0', '-1', {", ".join("NULL" for _ in RICH_OTHERS)}""",
)
def upsert_partial_columns(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    current = star.rich_with_unknown(rich_rows(spark, sf))
    batch = settle(star.rich_batch(staged_employees(spark, sf), everyone, run_ts()), "rich-batch")
    merged = star.upsert_rich(current, batch)
    stamp = F.date_format("data_ultima_atualizacao", "yyyy-MM-dd HH:mm:ss")
    shown = merged.withColumns({"data_ultima_atualizacao": stamp, **{c: F.col(c).cast("double") for c in S.API_MONEY}})
    return as_text(shown, *S.API_MONEY)


@query(
    "current_ts",
    f"{EMPLOYEE_SQL} SELECT CAST(ativo AS VARCHAR) AS ativo, '{RUN_TS}' AS data_ultima_atualizacao, count(*) AS n "
    "FROM emp WHERE colaborador_id_solides IS NOT NULL AND cpf IS NOT NULL GROUP BY ALL",
)
def current_ts(spark, sf):
    """Every row of a batch carries the one time of its run."""
    everyone = person_rows(spark, sf, known_only=False)
    batch = star.rich_batch(staged_employees(spark, sf), everyone, run_ts())
    return batch.groupBy("ativo", "data_ultima_atualizacao").agg(F.count(F.lit(1)).alias("n"))


# -- people who left -----------------------------------------------------------------


def api_side(spark, sf):
    """People the employee API still lists: customers with a positive balance."""
    return table(spark, sf, "customer").where("c_acctbal > 0").select(cpf_digits(F.col("c_custkey") * 10 + 1).alias("cpf"))


def payroll_side(spark, sf):
    """People on the latest payroll: customers with an order since mid-2001."""
    recent = table(spark, sf, "orders").where("o_orderdate >= timestamp'2001-06-01'")
    return recent.select(cpf_digits(F.col("o_custkey") * 10 + 1).alias("cpf"))


SIDES = """api AS (SELECT lpad(CAST(c_custkey * 10 + 1 AS VARCHAR), 11, '0') AS cpf FROM customer WHERE c_acctbal > 0),
folha AS (SELECT lpad(CAST(o_custkey * 10 + 1 AS VARCHAR), 11, '0') AS cpf FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-06-01')"""
ABSENT = "NOT EXISTS (SELECT 1 FROM api WHERE api.cpf = cur.cpf) AND NOT EXISTS " \
         "(SELECT 1 FROM folha WHERE folha.cpf = cur.cpf)"
GONE = f"{ABSENT} AND data_demissao_csv IS NULL AND situacao_csv NOT IN ('Transferido', 'Desligado')"


@query("anti_join_double", f"WITH {EVERYONE}, {SIDES} SELECT {BASE_OUT} FROM cur WHERE {ABSENT}")
def anti_join_double(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    return star.absent_from_both(everyone, api_side(spark, sf), payroll_side(spark, sf))


@query(
    "filter_not_in_null",
    f"WITH {EVERYONE} SELECT cpf, situacao_csv FROM cur WHERE data_demissao_csv IS NULL "
    "AND situacao_csv NOT IN ('Transferido', 'Desligado')",
)
def filter_not_in_null(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    return everyone.where(star.transferable()).select("cpf", "situacao_csv")


@query(
    "conditional_update",
    f"WITH {EVERYONE}, {SIDES}, m AS (SELECT cur.* REPLACE (CASE WHEN {GONE} THEN 'Transferido' "
    f"ELSE situacao_csv END AS situacao_csv) FROM cur) SELECT {BASE_OUT} FROM m",
)
def conditional_update(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    return star.mark_transferred(everyone, api_side(spark, sf), payroll_side(spark, sf))


@query(
    "semi_join_update",
    f"WITH {EVERYONE}, {SIDES}, m AS (SELECT cur.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM folha WHERE "
    "folha.cpf = cur.cpf) THEN 'Na folha' ELSE situacao_csv END AS situacao_csv) FROM cur) "
    f"SELECT {BASE_OUT} FROM m",
)
def semi_join_update(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    return merge.update_flagged(
        everyone, payroll_side(spark, sf), "cpf", F.lit(True), {"situacao_csv": F.lit("Na folha")}
    )


def _deactivated(status: str, extra: str = "") -> str:
    return (
        f"WITH {EVERYONE}, {RICH_CUR}{extra} SELECT r.colaborador_sk, CAST(r.ativo AND NOT ({status}) AS VARCHAR) "
        f"AS ativo, CASE WHEN r.ativo AND ({status}) THEN '{RUN_TS}' ELSE '{OLD_TS}' END AS data_ultima_atualizacao "
        "FROM rica r JOIN cur USING (colaborador_sk)"
    )


@query("update_from_join", _deactivated("coalesce(situacao_csv = 'Transferido', false)"))
def update_from_join(spark, sf):
    everyone = person_rows(spark, sf, known_only=False)
    updated = star.deactivate_transferred(rich_rows(spark, sf), everyone, run_ts())
    return updated.select("colaborador_sk", "ativo", "data_ultima_atualizacao")


@query(
    "cascade_update_guarded",
    _deactivated(f"coalesce(situacao_csv = 'Transferido' OR ({GONE}), false)", f", {SIDES}"),
)
def cascade_update_guarded(spark, sf):
    """The stored stage: base first, then the rich table because it exists."""
    wh = Warehouse(spark, work_folder(spark, "status"))
    wh.replace(run.BASE, person_rows(spark, sf, known_only=False))
    wh.replace(run.RICH, rich_rows(spark, sf))
    wh.replace(run.STG_API, api_side(spark, sf))
    wh.replace(run.STG_PAYROLL, payroll_side(spark, sf))
    run.mark_transferred(wh, run_ts())
    return wh.read(run.RICH, S.DIM_RICH).select("colaborador_sk", "ativo", "data_ultima_atualizacao")


# -- checks --------------------------------------------------------------------------


@query(
    "ref_integrity_check",
    f"""WITH {CUR}, f AS (SELECT l_suppkey + 1 AS sk, CASE WHEN l_partkey % 50 = 0 THEN 'CPF-' || l_partkey || '-LONGO'
    ELSE CAST(l_partkey AS VARCHAR) END AS cpf FROM lineitem), {REC}
  SELECT 'fato.colaborador_sk existe' AS regra, CAST(sk AS VARCHAR) AS chave, count(*) AS n FROM f
    WHERE NOT EXISTS (SELECT 1 FROM cur WHERE colaborador_sk = sk) GROUP BY sk
  UNION ALL SELECT 'fato.cpf_csv ate 11', cpf, count(*) FROM f WHERE length(cpf) > 11 GROUP BY cpf
  UNION ALL SELECT 'folha.cpf unico', cpf, count(*) FROM rec WHERE cpf IS NOT NULL GROUP BY cpf HAVING count(*) > 1
  UNION ALL SELECT 'folha.nome nao nulo', NULL, count(*) FROM rec WHERE nome IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'folha.cargo ate 6', cargo, count(*) FROM rec WHERE length(cargo) > 6 GROUP BY cargo
  UNION ALL SELECT 'base.cpf unico', cpf, count(*) FROM cur GROUP BY cpf HAVING count(*) > 1""",
)
def ref_integrity_check(spark, sf):
    base, payroll = person_rows(spark, sf), payroll_rows(spark, sf)
    part = F.col("l_partkey")
    fact = table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") + 1).alias("colaborador_sk"),
        F.when(part % 50 == 0, text_of("CPF-", part, "-LONGO")).otherwise(part.cast("string")).alias("cpf_csv"),
    )
    return checks.integrity_report(
        checks.orphans(fact, "colaborador_sk", base, "colaborador_sk", "fato.colaborador_sk existe"),
        checks.too_long(fact, "cpf_csv", 11, "fato.cpf_csv ate 11"),
        checks.duplicates(payroll, "cpf", "folha.cpf unico"),
        checks.row_rules(payroll, {"nome_funcionario": "folha.nome nao nulo"}, {"cargo": (6, "folha.cargo ate 6")}),
        checks.duplicates(base, "cpf", "base.cpf unico"),
    )


# -- documents to facts --------------------------------------------------------------

DOC_BAT = """bat AS (SELECT * FROM (SELECT cpf, nome_funcionario AS nome_colaborador, data_admissao AS data_admissao_csv,
  data_demissao AS data_demissao_csv, situacao AS situacao_csv, departamento AS departamento_csv, cargo AS cargo_csv,
  row_number() OVER (PARTITION BY cpf ORDER BY nome_funcionario DESC NULLS FIRST, data_admissao DESC NULLS LAST,
    data_demissao DESC NULLS LAST, situacao DESC NULLS LAST, departamento DESC NULLS LAST, cargo DESC NULLS LAST) AS rn
  FROM typed WHERE cpf IS NOT NULL AND cpf <> 'N/A' AND nome_funcionario IS NOT NULL) WHERE rn = 1)"""
DOC_BASE = f"{CUR}, {DOC_BAT}, {numbered('bat')}, base AS ({MERGED})"


def documents_to_base(spark, sf):
    """Records of all documents and the dimension after their upsert.

    The records are stored once: the dimension batch and both facts read the table.
    """
    records = spark.read.parquet(stored(spark, sf, "records", typed_records))
    batch = settle(star.base_batch(payslips.consolidated(records)), "batch")
    return records, star.upsert_base(person_rows(spark, sf), batch)


@query(
    "folha_consolidada",
    f"{TYPED_SQL}, {DOC_BASE} SELECT coalesce(colaborador_sk, 0) AS colaborador_sk, t.nome_funcionario AS "
    "nome_funcionario_csv, t.departamento AS centro_de_custo, t.cargo AS cargo_nome_csv, t.cpf AS cpf_csv, "
    "t.situacao AS situacao_csv, t.tipo_calculo AS tipo_calculo_csv, "
    + ", ".join(f"t.{c}" for c in S.CONSOL_MONEY)
    + ", t.file AS arquivo_origem, CAST(t.competencia AS VARCHAR) AS competencia FROM typed t LEFT JOIN base USING (cpf)",
)
def folha_consolidada(spark, sf):
    records, base = documents_to_base(spark, sf)
    return star.consolidated_fact(payslips.consolidated(records), base)


@query(
    "folha_detalhada",
    DETAIL_SQL + TYPED_SQL[TYPED_SQL.index(", typed AS"):] + f", {DOC_BASE} SELECT coalesce(colaborador_sk, 0) "
    "AS colaborador_sk, d.nome_funcionario AS nome_funcionario_csv, d.departamento AS centro_de_custo, "
    "d.cpf AS cpf_csv, d.situacao AS situacao_csv, d.tipo_calculo AS tipo_calculo_csv, codigo_rubrica, nome_rubrica, "
    "tipo_rubrica, valor_rubrica, d.file AS arquivo_origem, CAST(d.competencia AS VARCHAR) AS competencia "
    "FROM det d LEFT JOIN base USING (cpf)",
)
def folha_detalhada(spark, sf):
    records, base = documents_to_base(spark, sf)
    return star.detail_fact(payslips.detail(records, scan_rubric_map(spark)), base)
