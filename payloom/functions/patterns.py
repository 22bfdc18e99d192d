"""Extraction patterns and the helpers that run them as Spark column expressions.

The patterns are written in Python syntax.  ``java`` spells out what Python means by
``\\s``, ``\\d`` and case-insensitive accented letters as explicit classes.  That gives
the JVM engine the same meaning without its Unicode flags, which slow every single
character test down and dominated the extraction time.
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace class, and its decimal digits of every script.  All
# digits beyond ASCII lie above U+065F, so that one comparison keeps the slow property
# lookup away from the letters of a document.  Characters below U+0100 are listed one by one,
# since the engine looks such lists up in a table but tries ranges in turn.
_WS_LOW = r"\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
_WS_HIGH = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
_WS = r"\t\n" + _WS_LOW + _WS_HIGH
_ND = r"0123456789[\u0660-\x{10ffff}&&\p{Nd}]"
_CLASSES = {r"\s": f"[{_WS}]", r"\S": f"[^{_WS}]", r"\d": f"[{_ND}]"}
_INSIDE = {r"\s": _WS, r"\d": _ND}
#: A character that is no decimal digit.
NO_DIGIT = f"[^{_ND}]+"
# Every decimal digit beyond ASCII, and the ASCII digit of the same value.
_OTHER_DIGITS = [c for c in map(chr, range(0x660, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
_SAME_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)
_OTHER_DIGITS = "".join(_OTHER_DIGITS)


class Pattern(str):
    """A JVM pattern that remembers the Python pattern and flags it stands for.

    ``skip`` is set for patterns with known first letters: it takes the text up to the next
    match, or to the end, in class runs that never give a character back.
    """

    source: str
    flags: str
    skip: str = ""


def java(pattern: str, flags: str = "", starts: str = "") -> Pattern:
    """JVM form of a Python pattern; ``.`` and ``$`` stop at newlines only.

    ``starts`` lists the letters a match can begin with: one class test then rejects
    most positions before the alternatives are tried, and searches run over all others in
    one step (``skip``).  No match of such a pattern is empty.
    """
    out, depth, i = [], 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            pair = pattern[i : i + 2]
            out.append((_INSIDE if depth else _CLASSES).get(pair, pair))
            i += 2
            continue
        if "i" in flags and ord(ch) > 127:
            both = ch.lower() + ch.upper()
            out.append(both if depth else f"[{both}]")
        else:
            depth += (ch == "[") - (ch == "]")
            out.append(ch)
        i += 1
    guard = f"(?=[{starts}])" if starts else ""
    body = "".join(out)
    compiled = Pattern(f"(?d{flags})" + guard + body)
    compiled.source, compiled.flags = pattern, flags
    if starts:
        letters = starts + starts.lower() if "i" in flags else starts
        bare = re.sub(r"(?<!\\)\((?!\?)", "(?:", body)
        compiled.skip = f"(?d{flags})[^{letters}]*+(?:(?!{bare})[{letters}][^{letters}]*+)*+"
    return compiled


# Document patterns (Python syntax) with their flags.
SPLIT = java(r"(?=(?:Empr|Contr)\.?\s*:\s*\d+|Matrícula:\s*\d+)", "i", "ECM")
COMPETENCIA = java(
    r"(?:Competência|Competencia|Referência|Referencia|Ref\.?)\s*[:.]?\s*(\d{2}/\d{4})", "i", "CR"
)
COMPETENCIA_GOZO = java(
    r"(?:Período de Gozo|Gozo).*?\d{2}/\d{2}/\d{4}\s+a\s+\d{2}/(\d{2}/\d{4})", "is", "PG"
)
COMPETENCIA_PAGTO = java(
    r"(?:Data de Pagamento|Pagamento|Data)[:\s]+\d{2}/(\d{2}/\d{4})", "i", "DP"
)
TIPO_CALCULO = java(r"Cálculo\s*:\s*(.+)", "i", "C")
DEPARTAMENTO = java(r"Departamento:\s*(.+)")
# A department header or an employee header, whichever comes first.  A header line that ends
# inside an employee header takes the rest of it along, so that none is cut in two.
HEADERS = java(
    r"(?:Empr|Contr)\.?\s*:\s*\d+|Matrícula:\s*\d+|(?-i:Departamento:)\s*.+(?:\s*:?\s*\d+)?", "i", "DECM"
)
# A department header that ends with the text, so that it might run on in the next part.
DEPARTAMENTO_OPEN = f"Departamento:{_CLASSES[r'\s']}*[^\\n]*\\z"
VINCULO = java(r"(Empr|Contr)\.?", starts="EC")
SITUACAO = java(r"Situação:\s*([^\n\r]+)")
SITUACAO_CUT = java(r"\s+(?:CPF:|Adm:|PIS/PASEP:|Matrícula:)")
SITUACAO_HEADER = java(r"((?:Empr|Contr)\.?\s*:\s*\d+.*?)(?=\n|CPF:)", "s", "EC")
SITUACAO_END = java(r"\s(Trabalhando|Afastado|Férias|Demitido)\s*$", "i")
DEMISSAO_MOTIVO = java(r"DEMITIDO EM\s+(\d{2}/\d{2}/\d{4})\s*-\s*(.*?)(?=\n|$)", "is")
DEMISSAO_DATA = java(r"(?:Data Demissão|Demissão):\s*(\d{2}/\d{2}/\d{4})", "i", "D")
NOME = java(
    r"(?:Empr|Contr)\.?\s*:\s*\d+\s+(.*?)(?=\s*Situação:|\s*CPF:|\s*Adm:|\n)", "is", "EC"
)
NOME_FERIAS = java(
    r"Nome do Funcionário\s+(.*?)(?=\s*Situação:|\s*PIS/PASEP:|\s*Matrícula:|\n)", "is"
)
NOME_LABEL_END = java(r"[^\s]+:\s*$")
CPF = java(r"CPF:\s*([\d\.\-]+)")
ADMISSAO = java(r"Adm?:\s*(\d{2}/\d{2}/\d{4})")
CARGO = java(r"Cargo:\s*\d+\s+(.*?)(?=\s+Salário:|\s+C\.|С\.)", "s")  # last letter: U+0421
CARGO_FERIAS = java(r"Cargo:\s+(.*?)(?=\s+Data de Pagamento:|\n)", "s")
SALARIO = java(r"Salário:\s*([\d\.,]+)")
# Two patterns per footer field: ``label: value`` on payslips, ``label value`` on receipts.
TOTALS = {
    name: tuple(java(p, "i") for p in both)
    for name, both in {
        "total_proventos": (r"Proventos:\s*([\d\.,]+)", r"Total de Proventos\s+([\d\.,]+)"),
        "total_descontos": (r"Descontos:\s*([\d\.,]+)", r"Total de Descontos\s+([\d\.,]+)"),
        "valor_liquido": (r"L[íi]quido:\s*([\d\.,]+)", r"L[íi]quido de F[ée]rias\s+([\d\.,]+)"),
        "base_inss": (r"Base INSS:\s*([\d\.,]+)", r"Base INSS F[ée]rias\s+([\d\.,]+)"),
        "base_fgts": (r"Base FGTS:\s*([\d\.,]+)", r"Base FGTS F[ée]rias\s+([\d\.,]+)"),
        "valor_fgts": (r"Valor FGTS:\s*([\d\.,]+)", r"Valor FGTS F[ée]rias\s+([\d\.,]+)"),
        "base_irrf": (r"Base IRRF:\s*([\d\.,]+)", r"Base IRRF F[ée]rias\s+([\d\.,]+)"),
    }.items()
}
# All footer labels of `TOTALS` at once: a label, and the amount after it.  No amount holds a
# letter, so no match reaches into the next label and one scan finds what each pattern finds.
AMOUNTS = java(
    r"(Proventos:|Descontos:|L[íi]quido:|Total de (?:Proventos|Descontos)(?=\s)|L[íi]quido de F[ée]rias(?=\s)"
    r"|(?:Base (?:INSS|FGTS|IRRF)|Valor FGTS)(?::| F[ée]rias(?=\s)))\s*([\d\.,]+)",
    "i",
    "PDLTBV",
)


def _label(pattern: Pattern) -> str:
    """The part of a pattern of `TOTALS` before its amount."""
    return java(pattern.source[: pattern.source.index("(")], "i")


def _next_amount(both: tuple[Pattern, Pattern]) -> str:
    """A bar with either label of a field, and its amount."""
    return rf"\|(?:{'|'.join(map(_label, both))})([^|]++)"


def _amount_anywhere(both: tuple[Pattern, Pattern]) -> str:
    """From the first bar on, the amount after the first label of a field, else after its second."""
    after = (rf"(?:\|(?!{_label(p)})[^|]*+)*+\|{_label(p)}([^|]++)" for p in both)
    return f"(?={'|'.join(after)}|)"


# Over the amounts of a block, each behind a bar: the amount of every field of `TOTALS`, one in a line.
# Nearly all blocks have them in order and once; any others are searched field by field.
EACH_AMOUNT = (
    r"\A(?:" + "".join(f"(?:{_next_amount(both)})?" for both in TOTALS.values()) + r"\z|"
    + "".join(map(_amount_anywhere, TOTALS.values())) + "(?s:.*))"
)
EACH_LINE = "\n".join(
    f"${i + 1}${len(TOTALS) + 2 * i + 1}${len(TOTALS) + 2 * i + 2}" for i in range(len(TOTALS))
)
ITEM_HOLERITE = java(r"(\d+)\s+(.*?)\s+([\d\.,]+)\s+([PD])(?=\s+\d{2,}|$)")
ITEM_FERIAS = java(r"(\d+)\s+(.*?)\s+[\d\.,/%]+\s+([\d\.,]+)\s+([PD])(?=\s+\d{2,}|$)")
# What every pattern of a dismissal holds.
DEMISSAO = java(r"DEM(?:ITIDO EM|issão:)", "i")
# The item pattern on a whole table: blanks and ``$`` stay inside a line.
ITEM_TABLE = ITEM_HOLERITE.replace(_WS, r"\t" + _WS_LOW + _WS_HIGH).replace(
    "|$)", r"|\n|\z)"
)
ANY_DIGIT = java(r"\d")


def ascii_digits(text: Column, more: str = "", same: str = "") -> Column:
    """Every decimal digit as the ASCII digit of its value; ``more`` becomes ``same``, the rest of it goes."""
    return F.translate(text, _OTHER_DIGITS + more, _SAME_DIGITS + same)


def all_matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array with the given group of every match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def rare_matches(text: Column, pattern: Pattern) -> Column:
    """Every match of a pattern whose first letters are rare in the text, like `all_matches`.

    The text before a match is taken along with it, and the text after the last one with an
    empty group, so that each search begins where the next match is.
    """
    found = F.regexp_extract_all(text, F.lit(f"{pattern.skip}(?:({pattern})|\\z)"), F.lit(1))
    return F.array_remove(found, "")


def parts_from(text: Column, pattern: Pattern) -> Column:
    """The text cut before each match: `F.split` by a lookahead, with a search only at first letters."""
    cut = F.regexp_extract_all(text, F.lit("(?s:.)" + pattern.skip), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; NULL without a match, '' when the group is empty.

    ``regexp_extract`` returns '' in both cases, and telling them apart decides
    whether a fallback pattern may run (``nullif`` tells them apart too, but runs the
    search twice wherever it is conditional).  The tail swallows the rest of the text, so the
    search ends with the first match.
    """
    return F.get(all_matches(text, pattern + "(?s:.*)", group), F.lit(0))


def first_full(text: Column, pattern: str, group: int = 1) -> Column:
    """`first_match` for a group that is never empty: '' then means no match, and no tail is read."""
    found = F.array(F.regexp_extract(text, pattern, group))
    return F.get(F.array_remove(found, ""), F.lit(0))


def first_rare(text: Column, pattern: Pattern, group: int = 1) -> Column:
    """The same for a pattern whose first letters are rare in the text."""
    return first_full(text, f"\\A{pattern.skip}{pattern}", group)


def first_of(text: Column, *patterns: str, group: int = 1) -> Column:
    """First match of the first pattern that matches at all."""
    return F.coalesce(*(first_match(text, p, group) for p in patterns))
