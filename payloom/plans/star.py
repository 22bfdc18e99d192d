"""Typed records + current tables -> new dimension and fact rows.

No table of the warehouse is read or written here; a merged dimension is stored once in the
work folder before its new rows are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions.numbers import to_decimal_safe
from payloom.operators import checks
from payloom.operators.conform import add_columns, conform
from payloom.operators.dedup import first_per_key
from payloom.operators.keys import assign_keys, lookup_surrogate_key, number_rows, with_unknown_member
from payloom.operators.merge import update_flagged, upsert
from payloom.session import settle

# Column names of the star, and the status words of people who left.
BASE_COLUMNS = {
    "cpf": "cpf",
    "nome_funcionario": "nome_colaborador",
    "data_admissao": "data_admissao_csv",
    "data_demissao": "data_demissao_csv",
    "situacao": "situacao_csv",
    "departamento": "departamento_csv",
    "cargo": "cargo_csv",
}
FACT_COLUMNS = {
    "nome_funcionario": "nome_funcionario_csv",
    "departamento": "centro_de_custo",
    "cargo": "cargo_nome_csv",
    "cpf": "cpf_csv",
    "situacao": "situacao_csv",
    "tipo_calculo": "tipo_calculo_csv",
    "file": "arquivo_origem",
}
TRANSFERRED = "Transferido"
LEFT_STATES = ("Transferido", "Desligado")


# -- person dimension ----------------------------------------------------------------


def project_base(records: DataFrame) -> DataFrame:
    return records.select(*(F.col(a).alias(b) for a, b in BASE_COLUMNS.items()))


def valid_key(key: Column, *also: str) -> Column:
    return key.isNotNull() & ~key.isin("N/A", *also)


def base_batch(records: DataFrame) -> DataFrame:
    """One row per cpf of a payroll batch; rows without a name cannot enter the dimension."""
    rows = project_base(records).where(
        valid_key(F.col("cpf")) & F.col("nome_colaborador").isNotNull()
    )
    return first_per_key(rows, "cpf", ("nome_colaborador",))


def base_batch_from_api(staged: DataFrame) -> DataFrame:
    """Name per cpf of an API batch; the largest API id wins."""
    rows = staged.where(valid_key(F.col("cpf"), "nan") & F.col("nome_completo").isNotNull())
    named = rows.select("cpf", F.col("nome_completo").alias("nome_colaborador"), "colaborador_id_solides")
    return first_per_key(named, "cpf", ("colaborador_id_solides",)).drop("colaborador_id_solides")


def _upsert_base(current: DataFrame, batch: DataFrame, policy: dict[str, str]) -> DataFrame:
    """One join of dimension and batch; the rows that come out of it without a key are the new ones."""
    merged = settle(upsert(current, batch, "cpf", policy), "merged")
    known = merged.where(F.col("colaborador_sk").isNotNull())
    fresh = merged.where(F.col("colaborador_sk").isNull()).drop("colaborador_sk")
    numbered = assign_keys(fresh, known, "cpf", "colaborador_sk")
    return conform(known.unionByName(numbered), S.DIM_BASE)


def upsert_base(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Payroll upsert: newest name, other attributes keep the old value if the batch has none."""
    policy = {"nome_colaborador": "overwrite", **dict.fromkeys(S.BASE_ATTRIBUTES, "coalesce")}
    return _upsert_base(current, batch, policy)


def upsert_base_name(current: DataFrame, batch: DataFrame) -> DataFrame:
    """API upsert: insert, or refresh only the name."""
    return _upsert_base(current, batch, {"nome_colaborador": "overwrite"})


def base_with_unknown(current: DataFrame) -> DataFrame:
    member = {"colaborador_sk": S.UNKNOWN_SK, "nome_colaborador": S.UNKNOWN_NAME, "cpf": S.UNKNOWN_CPF}
    return with_unknown_member(add_columns(current, S.DIM_BASE), "colaborador_sk", member)


# -- rich dimension ------------------------------------------------------------------


def rich_with_unknown(current: DataFrame) -> DataFrame:
    evolved = add_columns(current, S.DIM_RICH, drop=("total_benefits_api",))
    member = {"colaborador_sk": S.UNKNOWN_SK, "colaborador_id_solides": S.UNKNOWN_API_ID}
    return with_unknown_member(evolved, "colaborador_sk", member)


def rich_batch(staged: DataFrame, base: DataFrame, run_ts: Column) -> DataFrame:
    """Staged employees with an id and a known cpf, typed for the rich dimension."""
    keyed = staged.where(F.col("colaborador_id_solides").isNotNull()).join(
        base.select("cpf", "colaborador_sk"), "cpf", "inner"
    )
    money = {c: to_decimal_safe(F.col(c), 12, 2) for c in S.API_MONEY}
    return conform(keyed.withColumns({**money, "data_ultima_atualizacao": run_ts}), S.DIM_RICH)


def rich_conflicts(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Keys that make the upsert ambiguous: repeated ids or persons, or a person under a new id."""
    moved = batch.select("colaborador_sk", F.col("colaborador_id_solides").alias("_new")).join(
        current.select("colaborador_sk", F.col("colaborador_id_solides").alias("_old")),
        "colaborador_sk",
    )
    moved = moved.where("NOT (_new <=> _old)").groupBy("colaborador_sk").agg(F.count(F.lit(1)).alias("n"))
    return checks.integrity_report(
        checks.nulls(batch, "colaborador_id_solides", "id nulo no lote"),
        checks.duplicates(batch, "colaborador_id_solides", "id repetido no lote"),
        checks.duplicates(batch, "colaborador_sk", "pessoa repetida no lote"),
        moved.select(
            F.lit("pessoa com novo id").alias("regra"),
            F.col("colaborador_sk").cast("string").alias("chave"),
            "n",
        ),
    )


def upsert_rich(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert every column; on a known id refresh only the overwrite list."""
    return upsert(current, batch, "colaborador_id_solides", dict.fromkeys(S.RICH_OVERWRITE, "overwrite"))


# -- facts ---------------------------------------------------------------------------


def _fact(records: DataFrame, base: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The columns of ``schema`` with the person key, after a row number if the records have one."""
    ids = [c for c in S.FACT_IDS if c in records.columns]
    kept = [
        F.col(c).alias(FACT_COLUMNS.get(c, c))
        for c in records.columns
        if FACT_COLUMNS.get(c, c) in schema or c in ids
    ]
    rows = records.select(*kept)
    keyed = lookup_surrogate_key(rows, base, "cpf_csv", "cpf", "colaborador_sk", S.UNKNOWN_SK)
    for c in ids:
        schema = S.with_id(c, schema)
    return conform(keyed, schema)


def number_consolidated(records: DataFrame) -> DataFrame:
    """Blocks with their row number: one per file and block."""
    return number_rows(records, "fato_folha_id", ["file", "pos"], "competencia")


def number_detail(rows: DataFrame) -> DataFrame:
    """Items with their row number: one per file, block and item."""
    return number_rows(rows, "fato_rubrica_id", ["file", "pos", "item"], "competencia")


def consolidated_fact(records: DataFrame, base: DataFrame) -> DataFrame:
    return _fact(records, base, S.FATO_CONSOLIDADA)


def detail_fact(rows: DataFrame, base: DataFrame) -> DataFrame:
    return _fact(rows, base, S.FATO_DETALHADA)


def number_benefits(benefits: DataFrame) -> DataFrame:
    """Benefits with their row number: one per employee and place in the list."""
    return number_rows(benefits, "beneficio_id", ["colaborador_id_solides", "ordem"])


def benefits_fact(benefits: DataFrame, staged: DataFrame, base: DataFrame, run_ts: Column) -> DataFrame:
    """Benefits -> employee id -> cpf -> person key; rows that miss either step are left out."""
    ids = staged.select("colaborador_id_solides", "cpf")
    keyed = benefits.join(ids, "colaborador_id_solides").join(
        base.select("cpf", "colaborador_sk"), "cpf"
    )
    money = {c: to_decimal_safe(F.col(c), 12, 2) for c in ("valor_beneficio", "valor_desconto")}
    schema = S.with_id("beneficio_id", S.FATO_BENEFICIOS) if "beneficio_id" in benefits.columns else S.FATO_BENEFICIOS
    return conform(keyed.withColumns({**money, "data_atualizacao": run_ts}), schema)


# -- people who left the sources -----------------------------------------------------


def absent_from_both(base: DataFrame, api: DataFrame, payroll: DataFrame) -> DataFrame:
    """Base rows whose cpf is in neither source.

    The sources are reduced to one set of distinct keys first, so a hot cpf is one row
    and the dimension is joined once instead of twice.
    """
    seen = api.select("cpf").unionByName(payroll.select("cpf")).where("cpf is not null").distinct()
    return base.join(seen, "cpf", "left_anti").select(*base.columns)


def transferable() -> Column:
    """No dismissal date and a known status that is not final; a NULL status stays out."""
    return F.col("data_demissao_csv").isNull() & ~F.col("situacao_csv").isin(*LEFT_STATES)


def mark_transferred(base: DataFrame, api: DataFrame, payroll: DataFrame) -> DataFrame:
    """Set the status of the transferable people who are in neither source."""
    seen = api.select("cpf").unionByName(payroll.select("cpf")).where("cpf is not null").distinct()
    joined = base.join(seen.withColumn("_seen", F.lit(True)), "cpf", "left")
    status = F.when(F.col("_seen").isNull() & transferable(), F.lit(TRANSFERRED)).otherwise(
        F.col("situacao_csv")
    )
    return joined.select(
        *(status.alias(c) if c == "situacao_csv" else F.col(c) for c in base.columns)
    )


def deactivate_transferred(rich: DataFrame, base: DataFrame, run_ts: Column) -> DataFrame:
    """Deactivate active rich rows whose base status says the person was transferred."""
    gone = base.where(F.col("situacao_csv") == TRANSFERRED)
    return update_flagged(
        rich,
        gone,
        "colaborador_sk",
        F.col("ativo"),
        {"ativo": F.lit(False), "data_ultima_atualizacao": run_ts},
    )


def integrity(base: DataFrame, rich: DataFrame | None, facts: dict[str, DataFrame]) -> DataFrame:
    """Foreign keys, uniqueness, NOT NULL and longest texts of the given tables.

    One scan per table checks all rules on single rows.
    """

    def texts(df: DataFrame, table: str, short: str) -> dict[str, tuple[int, str]]:
        found = S.TEXT_LIMITS.get(table, {"cpf_csv": 11})
        return {c: (n, f"{short}.{c} ate {n}") for c, n in found.items() if c in df.columns}

    parts = [
        checks.duplicates(base, "colaborador_sk", "base.colaborador_sk unico"),
        checks.duplicates(base, "cpf", "base.cpf unico"),
        checks.row_rules(
            base, {"cpf": "base.cpf nao nulo", "nome_colaborador": "base.nome nao nulo"},
            texts(base, "dim_colaboradores_base", "base"),
        ),
    ]
    if rich is not None:
        parts += [
            checks.duplicates(rich, "colaborador_sk", "rica.colaborador_sk unico"),
            checks.duplicates(rich, "colaborador_id_solides", "rica.id unico"),
            checks.row_rules(rich, {"colaborador_id_solides": "rica.id nao nulo"}, texts(rich, "dim_colaboradores", "rica")),
            checks.orphans(rich, "colaborador_sk", base, "colaborador_sk", "rica.colaborador_sk existe"),
        ]
    for name, fact in facts.items():
        parts.append(
            checks.orphans(fact, "colaborador_sk", base, "colaborador_sk", f"{name}.colaborador_sk existe")
        )
        ids = [c for c in S.FACT_IDS if c in fact.columns]
        parts += [checks.duplicates(fact, c, f"{name}.{c} unico") for c in ids]
        parts.append(checks.row_rules(fact, {c: f"{name}.{c} nao nulo" for c in ids}, texts(fact, name, name)))
    return checks.integrity_report(*parts)
