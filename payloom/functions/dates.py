"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from payloom.functions import patterns as P
from payloom.functions.text import strip

# Accepted shapes in order of preference, with the Spark format for each.
# The shape test runs first so that a mismatch costs a regex, not a parser exception.
_D, _M, _Y = r"(?: \d|\d{1,2})", r"\d{1,2}", r"(?!0000)\d{4}"
DATE_SHAPES = (
    (rf"^{_D}/{_M}/{_Y}$", "d/M/yyyy"),
    (rf"^{_Y}-{_M}-{_D}$", "yyyy-M-d"),
    (rf"^{_M}/{_Y}$", "M/yyyy"),
    (rf"^{_M}-{_Y}$", "M-yyyy"),
    (rf"^{_D}-{_M}-{_Y}$", "d-M-yyyy"),
    (rf"^{_Y}/{_M}/{_D}$", "yyyy/M/d"),
)

# Pt-BR names, Sunday first / January first.
DAY_NAMES = ("Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado")
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
MONTH_SHORT = (
    "Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez",
)


def parse_date_multi(c: Column) -> Column:
    """First accepted shape that fits the whole text; month shapes give day 1."""
    text = strip(c)
    # The commonest shapes first, put into the form that a cast reads without a formatter.
    month = F.concat(F.right(c, F.lit(4)), F.lit("-"), F.left(c, F.lit(2)), F.lit("-01"))
    day = F.concat(F.right(c, F.lit(4)), F.lit("-"), F.substring(c, 4, 2), F.lit("-"), F.left(c, F.lit(2)))
    parsed = F.when(c.rlike(r"^\d\d/(?!0000)\d{4}\z"), month.try_cast("date")).when(
        c.rlike(r"^\d\d/\d\d/(?!0000)\d{4}\z"), day.try_cast("date")
    )
    for shape, fmt in DATE_SHAPES:
        value = F.try_to_date(F.replace(text, F.lit(" "), F.lit("")), fmt)
        parsed = parsed.when(text.rlike(shape), value)
    return parsed


def period_from_text(text: Column) -> Column:
    """``MM/YYYY`` of a document: header, then vacation range, then payment date."""
    # a search for a letter of "Gozo" that few texts hold costs a fraction of one for the pattern
    has_gozo = text.contains("z") | text.contains("Z")
    return F.coalesce(
        P.first_rare(text, P.COMPETENCIA),
        F.when(has_gozo, P.first_rare(text, P.COMPETENCIA_GOZO)),
        P.first_rare(text, P.COMPETENCIA_PAGTO),
    )


def case_semester(d: Column) -> Column:
    return F.when(F.month(d) <= 6, 1).otherwise(2)


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), position)


def day_name(d: Column) -> Column:
    return _name(DAY_NAMES, F.dayofweek(d))


def month_name(d: Column) -> Column:
    return _name(MONTH_NAMES, F.month(d))


def month_short(d: Column) -> Column:
    return _name(MONTH_SHORT, F.month(d))


def calendar_columns(d: Column) -> list[Column]:
    """The 13 calendar columns of a date."""
    return [
        d.alias("data"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.quarter(d).alias("trimestre"),
        case_semester(d).alias("semestre"),
        (F.dayofweek(d) - 1).alias("dia_da_semana"),
        day_name(d).alias("nome_dia_da_semana"),
        month_name(d).alias("nome_mes"),
        month_short(d).alias("nome_mes_abrev"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.dayofyear(d).alias("dia_do_ano"),
        F.weekofyear(d).alias("semana_do_ano"),
    ]
