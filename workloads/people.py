"""Queries over nested employee records."""

from __future__ import annotations

from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions.numbers import parse_money_variant
from payloom.operators.conform import conform, rename_paths
from payloom.plans import employees
from payloom.session import work_folder
from payloom.sources.files import scan_employee_json
from workloads.registry import query, table
from workloads.render import (
    EMPLOYEE_DOUBLES, EMPLOYEE_EXPECTED, EMPLOYEE_SQL, as_text, employee_json, expected_as_text, stored,
)


def json_rows(spark, sf):
    return spark.read.parquet(stored(spark, sf, "employees", employee_json))


def parsed(spark, sf):
    return employees.parse_employees(json_rows(spark, sf), "json")


ALL_COLUMNS = tuple(S.STG_COLABORADORES)


@query("json_flatten", f"{EMPLOYEE_SQL} SELECT {expected_as_text(ALL_COLUMNS)} FROM emp")
def json_flatten(spark, sf):
    return as_text(employees.flatten_employees(parsed(spark, sf)), *EMPLOYEE_DOUBLES)


def write_pages(rows, purpose: str) -> str:
    """Folder of landed pages: each file one JSON array of up to 100 employees over many lines."""
    folder = work_folder(rows.sparkSession, purpose)
    pages = rows.groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.collect_list("json").alias("items"))
    text = F.concat(F.lit("[\n  "), F.array_join("items", ",\n  "), F.lit("\n]"))
    pages.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


@query("scan_employee_json", f"{EMPLOYEE_SQL} SELECT {expected_as_text(ALL_COLUMNS)} FROM emp")
def scan_employee_json_query(spark, sf):
    """Pages of the employee list as they land, read with the fixed schema."""
    records = scan_employee_json(spark, write_pages(employee_json(spark, sf), "pages"))
    return as_text(employees.flatten_employees(records), *EMPLOYEE_DOUBLES)


# The texts before they are typed, where they differ from the staging columns; amounts are shown as numbers.
DMY, ISO = "strftime({0}, '%d/%m/%Y')", "strftime({0}, '%Y-%m-%d')"
DIGITS = "lpad(CAST(k * 10 + 1 AS VARCHAR), 11, '0')"
RAW = {
    "cpf": f"CASE WHEN k % 31 = 0 THEN 'sem numero' ELSE substr({DIGITS}, 1, 3) || '.' || substr({DIGITS}, 4, 3) || '.' "
           f"|| substr({DIGITS}, 7, 3) || '-' || substr({DIGITS}, 10, 2) END",
    "data_nascimento": f"CASE k % 3 WHEN 0 THEN {DMY.format('dia')} WHEN 1 THEN {ISO.format('dia')} "
                       f"ELSE {ISO.format('dia')} || 'T10:00:00' END",
    "data_admissao": DMY.format("dia"),
    "data_demissao": f"CASE WHEN k % 9 = 0 THEN {DMY.format('(dia + 700)')} END",
    "data_contrato": ISO.format("dia"),
    "data_expiracao_contrato": "strftime(dia, '%m/%Y')",
    "data_emissao_rg": DMY.format("dia"),
    "data_ultima_atualizacao_api": f"CASE WHEN k % 2 = 0 THEN {ISO.format('dia')} ELSE {ISO.format('dia')} || 'T10:00:00' END",
}
RAW_SQL = EMPLOYEE_SQL[: EMPLOYEE_SQL.index(", emp AS")] + ", raw AS (SELECT " + ", ".join(
    f"{RAW.get(name, sql)} AS {name}" for name, sql in EMPLOYEE_EXPECTED.items()
) + " FROM src)"


@query("project_rename_map", f"{RAW_SQL} SELECT {expected_as_text(ALL_COLUMNS)} FROM raw")
def project_rename_map(spark, sf):
    renamed = rename_paths(parsed(spark, sf), S.EMPLOYEE_RENAME)
    amounts = {c: parse_money_variant(F.col(c)) for c in S.API_MONEY}
    return as_text(renamed.withColumns(amounts), *EMPLOYEE_DOUBLES)


PRESENT = ("colaborador_id_solides", "nome_completo", "ativo", "data_admissao", "salario_api")


@query(
    "project_fixed_schema",
    f"{EMPLOYEE_SQL} SELECT {expected_as_text(PRESENT)}, "
    + ", ".join(f"'ausente' AS {c}" for c in ALL_COLUMNS if c not in PRESENT)
    + " FROM emp",
)
def project_fixed_schema(spark, sf):
    few = employees.flatten_employees(parsed(spark, sf)).select(*reversed(PRESENT))
    wide = as_text(conform(few, S.STG_COLABORADORES), *(c for c in EMPLOYEE_DOUBLES if c in PRESENT))
    return wide.select(
        *(F.col(c) if c in PRESENT else F.coalesce(c, F.lit("ausente")).alias(c) for c in wide.columns)
    )


@query(
    "explode_benefits",
    f"{EMPLOYEE_SQL} SELECT CAST(CASE WHEN k % 23 <> 0 THEN k END AS VARCHAR) AS colaborador_id_solides, "
    "'BENEFICIO ' || b AS nome_beneficio, c_mktsegment AS tipo_beneficio, "
    "CAST(k * 100 + b AS DOUBLE) / 100 AS valor_beneficio, CAST(k + b AS DOUBLE) AS valor_desconto, "
    "'mensal' AS periodicidade, 'opcao ' || (k % 3) AS opcao_desconto, 'folha' AS aplicado_como FROM ben",
)
def explode_benefits(spark, sf):
    benefits = employees.explode_benefits(parsed(spark, sf)).drop("ordem")
    return as_text(benefits, "valor_beneficio", "valor_desconto")


@query(
    "merge_detail_over_list",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'LISTA ' || c_custkey END AS name, "
    "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 4 <> 0 AS VARCHAR) END AS ativo "
    "FROM customer WHERE c_custkey % 23 <> 0",
)
def merge_detail_over_list(spark, sf):
    """Every third employee has a detail record; the list record has only id and name.

    Both are read from landed pages; details arrive twice.
    """
    rows = employee_json(spark, sf)
    short = F.to_json(F.struct(F.get_json_object("json", "$.id").cast("bigint").alias("id"), F.concat(F.lit("LISTA "), F.col("c_custkey")).alias("name")))
    listed = scan_employee_json(spark, write_pages(rows.select("c_custkey", short.alias("json")), "list-pages"))
    details = scan_employee_json(spark, write_pages(rows.where("c_custkey % 3 = 0"), "detail-pages"))
    merged = employees.merge_detail_over_list(listed, details.unionByName(details))
    return merged.select("id", "name", F.col("active").cast("string").alias("ativo"))


@query(
    "filter_id_not_null",
    f"{EMPLOYEE_SQL} SELECT colaborador_id_solides, nome_completo FROM emp WHERE colaborador_id_solides IS NOT NULL",
)
def filter_id_not_null(spark, sf):
    staged = employees.flatten_employees(parsed(spark, sf))
    return staged.where(F.col("colaborador_id_solides").isNotNull()).select(
        "colaborador_id_solides", "nome_completo"
    )
