"""Rows a stage leaves out, as ``(etapa, regra, chave, valor)``: nothing vanishes without a record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions.numbers import decimal_or_reject, to_decimal_safe
from payloom.plans import payslips
from payloom.plans.star import valid_key


def _rows(df: DataFrame, stage: str, rule: str, key: Column, value: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(stage).alias("etapa"),
        F.lit(rule).alias("regra"),
        key.cast("string").alias("chave"),
        (F.lit(None) if value is None else value).cast("string").alias("valor"),
    )


def documents(docs: DataFrame) -> DataFrame:
    """Documents without an employee block."""
    return _rows(payslips.rejected_documents(docs), "folha", "documento sem bloco", F.col("file"))


def payroll_people(records: DataFrame) -> DataFrame:
    """Blocks whose person cannot enter the dimension: no name, or no usable cpf."""
    key = F.concat_ws("#", "file", F.col("pos").cast("string"))
    known = F.coalesce(valid_key(F.col("cpf")), F.lit(False))
    name = F.col("nome_funcionario")
    # One pass for both rules.  The outer form keeps Catalyst from turning the condition into a
    # filter below the extraction, where each use of a column would repeat its searches.
    row = F.struct(
        F.when(known, "pessoa sem nome").otherwise("pessoa sem cpf").alias("regra"),
        key.alias("chave"),
        F.when(known, F.col("cpf")).otherwise(name).alias("valor"),
    )
    out = records.select(F.explode_outer(F.when(~known | name.isNull(), F.array(row))).alias("o")).where("o is not null")
    return out.select(F.lit("folha").alias("etapa"), "o.regra", "o.chave", "o.valor")


def payroll_money(records: DataFrame) -> DataFrame:
    """Amounts of blocks and items that the decimal columns cannot hold; they are NULL in the facts."""
    key = F.concat_ws("#", "file", F.col("pos").cast("string"))
    amounts = records.select(key.alias("chave"), F.explode("perdas").alias("p")).select(
        F.lit("folha").alias("etapa"), F.concat("p.campo", F.lit(" fora da faixa")).alias("regra"), "chave", "p.valor"
    )
    items = records.select(key.alias("_block"), F.posexplode("itens").alias("item", "i")).where(
        to_decimal_safe(F.col("i.valor")).isNull()
    )
    item_key = F.concat_ws("#", "_block", F.col("item").cast("string"))
    return amounts.unionByName(_rows(items, "folha", "valor_rubrica fora da faixa", item_key, F.col("i.valor")))


def benefit_money(benefits: DataFrame) -> DataFrame:
    """Amounts of benefits that the decimal columns cannot hold; they are NULL in the fact."""
    key = F.concat_ws("#", F.col("colaborador_id_solides").cast("string"), F.col("ordem").cast("string"))
    return reduce(
        DataFrame.unionByName,
        (
            _rows(benefits.where(decimal_or_reject(F.col(c), 12, 2)["lost"].isNotNull()), "api", f"{c} fora da faixa", key, F.col(c))
            for c in ("valor_beneficio", "valor_desconto")
        ),
    )


def api_people(staged: DataFrame) -> DataFrame:
    """Employees that the API stage cannot load: no id, no usable cpf, or no name."""
    has_cpf = F.coalesce(valid_key(F.col("cpf"), "nan"), F.lit(False))
    who = F.col("colaborador_id_solides")
    return reduce(
        DataFrame.unionByName,
        (
            _rows(staged.where(who.isNull()), "api", "pessoa sem id", F.col("cpf"), F.col("nome_completo")),
            _rows(staged.where(~has_cpf), "api", "pessoa sem cpf", who, F.col("nome_completo")),
            _rows(staged.where(has_cpf & F.col("nome_completo").isNull()), "api", "pessoa sem nome", who, F.col("cpf")),
        ),
    )


def money(staged: DataFrame) -> DataFrame:
    """Amounts that the decimal columns cannot hold; they are NULL in the dimension."""
    lost = [
        _rows(
            staged.where(decimal_or_reject(F.col(c), 12, 2)["lost"].isNotNull()),
            "api", f"{c} fora da faixa", F.col("colaborador_id_solides"), F.col(c),
        )
        for c in S.API_MONEY
        if c in staged.columns
    ]
    return reduce(DataFrame.unionByName, lost)
