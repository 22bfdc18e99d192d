"""Nested employee records -> flat staging rows and benefit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions.dates import parse_date_multi
from payloom.functions.numbers import nullable_int, parse_money_variant, to_boolean
from payloom.functions.text import clean_cpf
from payloom.operators.conform import conform, rename_paths, typed


def parse_employees(rows: DataFrame, column: str) -> DataFrame:
    """Employee records from a column of JSON objects."""
    parsed = F.from_json(column, S.EMPLOYEE)
    return rows.select(parsed.alias("e")).select("e.*")


def merge_detail_over_list(listed: DataFrame, details: DataFrame) -> DataFrame:
    """For every listed id the whole detail record when there is one, else the list record.

    Items without an id (missing or 0) are dropped.  Of several details of one id the one
    with the largest JSON text counts, so a person never becomes two rows.
    """
    whole = F.struct(*(F.col(c) for c in listed.columns))
    left = listed.where(F.col("id").isNotNull() & (F.col("id") != 0)).select(
        "id", whole.alias("_list")
    )
    detail = F.struct(*(F.col(c) for c in listed.columns))
    right = details.groupBy("id").agg(F.max_by(detail, F.to_json(detail)).alias("_detail"))
    return (
        left.join(right, "id", "left")
        .select(F.coalesce("_detail", "_list").alias("e"))
        .select("e.*")
    )


def flatten_employees(employees: DataFrame) -> DataFrame:
    """The 64 staging columns with their types; absent parents give NULL."""
    flat = rename_paths(employees, S.EMPLOYEE_RENAME)
    rules = {"cpf": clean_cpf(F.col("cpf"))}
    rules |= {c: parse_money_variant(F.col(c)) for c in S.API_MONEY}
    rules |= {c: parse_date_multi(F.col(c)) for c in S.API_DATES}
    rules |= {c: to_boolean(F.col(c)) for c in S.API_BOOLEANS}
    return conform(typed(flat, rules), S.STG_COLABORADORES)


def explode_benefits(employees: DataFrame) -> DataFrame:
    """One row per benefit; an employee without a list gives none."""
    # The outer form avoids an inferred size filter, which would parse the JSON twice.
    items = employees.select(
        nullable_int(F.col("id")).alias("colaborador_id_solides"),
        F.posexplode_outer("benefits").alias("ordem", "b"),
    ).where("b is not null")
    renamed = items.select(
        "colaborador_id_solides", "ordem",
        *(F.col(f"b.{path}").alias(name) for path, name in S.BENEFIT_RENAME.items()),
        parse_money_variant(F.col("b.value")).alias("valor_beneficio"),
        parse_money_variant(F.col("b.valueDiscount")).alias("valor_desconto"),
    )
    return renamed.select(*S.STG_BENEFICIOS)
