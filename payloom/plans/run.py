"""The four stages in order: calendar, payroll, employees, people who left.

Each stage reads tables, applies the pure plans and writes.  Expensive extraction is
stored once as a staging table, and every later step of the stage reads that table.  The
constraints are checked on the written tables, and only then one commit record makes all
tables of the stage current: a stage that breaks a rule, or dies, changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from payloom import schemas as S
from payloom.operators.checks import require_clean
from payloom.operators.merge import has_period, insert_ignore
from payloom.plans import calendar, employees, payslips, rejected, star
from payloom.sources.files import write_csv_locale
from payloom.sources.rubrics import scan_rubric_map
from payloom.sources.tables import Warehouse

CALENDAR = "dim_calendario"
BASE = "dim_colaboradores_base"
RICH = "dim_colaboradores"
CONSOL = "fato_folha_consolidada"
DETAIL = "fato_folha_detalhada"
BENEFITS = "fato_beneficios_api"
STORED_CONSOL = S.with_id("fato_folha_id", S.FATO_CONSOLIDADA)
STORED_DETAIL = S.with_id("fato_rubrica_id", S.FATO_DETALHADA)
STORED_BENEFITS = S.with_id("beneficio_id", S.FATO_BENEFICIOS)
STG_PAYROLL = "stg_folha_consol"
STG_API = "staging_colaboradores"
STG_BENEFITS = "staging_beneficios_api"
# What a stage could not load, one row each, and the keys that stopped a stage.
REJECTS_PAYROLL = "rejeitados_folha"
REJECTS_API = "rejeitados_api"
CONFLICTS = "conflitos"
# Batches with one row per person, stored because a merge reads its batch several times.
BASE_BATCH = "lote_colaboradores_base"
RICH_BATCH = "lote_colaboradores"


def load_calendar(wh: Warehouse) -> None:
    days = calendar.dim_calendar(wh.spark)
    current = wh.read(CALENDAR, dict(days.dtypes))
    wh.replace(CALENDAR, insert_ignore(current, days, "data"))


def gate(wh: Warehouse, stage: str, report: DataFrame) -> None:
    """Stop before anything is published if a staged table breaks a rule; the table of offenders stays."""
    name = f"{CONFLICTS}_{stage}"
    staged, stored = wh.stage(name, report)
    require_clean(stored, staged.folder)


def load_payroll(wh: Warehouse, docs: DataFrame, csv_folder: str | None = None) -> None:
    """Documents -> staging -> base dimension and both facts of the batch periods, published together."""
    typed = payslips.type_records(payslips.raw_records(docs))
    staging, records = wh.stage(STG_PAYROLL, typed)
    lost = (rejected.documents(docs), rejected.payroll_people(records), rejected.payroll_money(records))
    rejects, _ = wh.stage(REJECTS_PAYROLL, reduce(DataFrame.unionByName, lost))
    if records.isEmpty():
        wh.publish(rejects)
        return
    consol = payslips.consolidated(records)
    detail = payslips.detail(records, scan_rubric_map(wh.spark))
    if csv_folder:
        write_csv_locale(consol.drop("file", "pos"), f"{csv_folder}/FOPAG_Consolidada_Tratada")
        write_csv_locale(detail.drop("file", "pos", "item"), f"{csv_folder}/FOPAG_Detalhada_Tratada")

    current = star.base_with_unknown(wh.read(BASE, S.DIM_BASE))
    _, people = wh.stage(BASE_BATCH, star.base_batch(consol))
    base_staged, base = wh.stage(BASE, star.upsert_base(current, people))
    changed, facts = [rejects, base_staged], {}
    if has_period(consol):
        for name, rows in (
            (CONSOL, star.consolidated_fact(star.number_consolidated(consol), base)),
            (DETAIL, star.detail_fact(star.number_detail(detail), base)),
        ):
            staged, facts[name] = wh.stage_periods(name, rows)
            changed.append(staged)
        changed.append(staging)
    gate(wh, "folha", star.integrity(base, None, facts))
    wh.publish(*changed)


def load_employees(wh: Warehouse, records: DataFrame, run_ts: Column, details: DataFrame | None = None) -> None:
    """Employee records -> staging -> base, rich dimension and benefits, published together.

    With ``details`` the records are list pages, and a detail takes the place of its list record.
    """
    if details is not None:
        records = employees.merge_detail_over_list(records, details)
    staging, staged = wh.stage(STG_API, employees.flatten_employees(records))
    if staged.isEmpty():
        return
    benefits_staging, benefits = wh.stage(STG_BENEFITS, employees.explode_benefits(records))
    lost = (rejected.api_people(staged), rejected.money(staged), rejected.benefit_money(benefits))
    rejects, _ = wh.stage(REJECTS_API, reduce(DataFrame.unionByName, lost))

    current = star.base_with_unknown(wh.read(BASE, S.DIM_BASE))
    _, names = wh.stage(BASE_BATCH, star.base_batch_from_api(staged))
    base_staged, base = wh.stage(BASE, star.upsert_base_name(current, names))
    rich = star.rich_with_unknown(wh.read(RICH, S.DIM_RICH))
    _, batch = wh.stage(RICH_BATCH, star.rich_batch(staged, base, run_ts))
    gate(wh, "lote", star.rich_conflicts(rich, batch))
    rich_staged, merged = wh.stage(RICH, star.upsert_rich(rich, batch))
    numbered = star.number_benefits(benefits)
    fact_staged, fact = wh.stage(BENEFITS, star.benefits_fact(numbered, staged, base, run_ts))
    gate(wh, "api", star.integrity(base, merged, {BENEFITS: fact}))
    wh.publish(staging, benefits_staging, rejects, base_staged, rich_staged, fact_staged)


def mark_transferred(wh: Warehouse, run_ts: Column) -> None:
    """Needs the staging of both sources; without either of them nothing changes."""
    if not (wh.exists(STG_API) and wh.exists(STG_PAYROLL) and wh.exists(BASE)):
        return
    base = wh.read(BASE, S.DIM_BASE)
    api = wh.read(STG_API, S.STG_COLABORADORES)
    payroll = wh.read(STG_PAYROLL, {})
    base_staged, stored = wh.stage(BASE, star.mark_transferred(base, api, payroll))
    changed = [base_staged]
    if wh.exists(RICH):
        rich = wh.read(RICH, S.DIM_RICH)
        changed.append(wh.stage(RICH, star.deactivate_transferred(rich, stored, run_ts))[0])
    wh.publish(*changed)


def run_all(
    wh: Warehouse,
    docs: DataFrame,
    records: DataFrame | None,
    run_ts: Column,
    csv_folder: str | None = None,
    details: DataFrame | None = None,
) -> None:
    """All stages; without employee records the third one is skipped.

    ``details`` are the detail records of listed employees, if there are any.
    """
    load_calendar(wh)
    load_payroll(wh, docs, csv_folder)
    if records is not None:
        load_employees(wh, records, run_ts, details)
    mark_transferred(wh, run_ts)


def check_integrity(wh: Warehouse) -> DataFrame:
    rich = wh.read(RICH, S.DIM_RICH) if wh.exists(RICH) else None
    facts = {
        CONSOL: wh.read_periods(CONSOL, STORED_CONSOL),
        DETAIL: wh.read_periods(DETAIL, STORED_DETAIL),
    }
    if wh.exists(BENEFITS):
        facts[BENEFITS] = wh.read(BENEFITS, STORED_BENEFITS)
    return star.integrity(wh.read(BASE, S.DIM_BASE), rich, facts)
