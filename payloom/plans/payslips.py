"""Payslip documents -> employee blocks -> typed records and line items.

Everything is a narrow, per-row plan: a document never leaves its task, so extraction
needs no shuffle at all, whatever the number or the naming of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions import patterns as P
from payloom.functions.dates import parse_date_multi, period_from_text
from payloom.functions.numbers import brl_number, decimal_or_reject, to_decimal_safe
from payloom.functions.text import clean_cpf, clean_text, name_suffix_strip, one_line, strip
from payloom.operators.conform import typed
from payloom.session import compiled_in_pieces

_BLOCK_MIN_CHARS = 50


# -- documents and blocks ------------------------------------------------------------


def document_fields(text: Column) -> list[Column]:
    """Period and calculation type, one pair per document."""
    return [
        period_from_text(text).alias("competencia"),
        # the accented letter is rare, and a search for it costs a fraction of one for the pattern
        strip(F.when(text.contains("á") | text.contains("Á"), P.first_rare(text, P.TIPO_CALCULO))).alias("tipo_calculo"),
    ]


def split_blocks(text: Column) -> Column:
    """Array of texts cut before each employee header."""
    return P.parts_from(text, P.SPLIT)


def is_employee_block(block: Column) -> Column:
    return (F.length(block) >= _BLOCK_MIN_CHARS) & (
        block.contains("CPF:") | block.contains("Matrícula:")
    )


def header_order(text: Column) -> Column:
    """The order of headers, found on the whole text: ``D`` for a department and ``E`` for an employee."""
    letters = F.transform(
        P.rare_matches(text, P.HEADERS),
        lambda m: F.when(
            m.startswith("Departamento:"), F.concat(F.lit("D"), F.repeat(F.lit("E"), F.regexp_count(m, F.lit(P.SPLIT))))
        ).otherwise("E"),
    )
    return F.array_join(letters, "")


def part_order(parts: Column) -> Column:
    """The same where every department line ends in its part: an ``E`` for a part, and a ``D`` for each line in it."""
    letters = F.transform(
        parts, lambda p: F.concat(F.lit("E"), F.repeat(F.lit("D"), F.regexp_count(p, F.lit(P.DEPARTAMENTO))))
    )
    return F.array_join(letters, "")


def departments(text: Column, parts: Column) -> Column:
    """For each part of a text the last department header that starts before it.

    A department line may hold employee headers of its own, which then come after it.  Only
    then are headers searched in the whole text; else each part tells how many lines it has.
    Written as letters, ``D`` for a department and ``E`` for a block, the order falls into runs
    of one ``D`` and the blocks up to the next, so each name is repeated for its run: no step
    looks back.
    """
    runs_on = F.exists(parts, lambda p: p.rlike(P.DEPARTAMENTO_OPEN))
    order = F.when(runs_on, header_order(text)).otherwise(part_order(parts))
    runs = P.all_matches(order, "DE*")
    names = F.transform(P.all_matches(text, P.DEPARTAMENTO, 1), strip)
    known = F.flatten(F.zip_with(names, runs, lambda name, run: F.array_repeat(name, F.length(run) - 1)))
    # blocks before the first department: employees without one, and a part that no header starts
    bare = F.array_repeat(F.lit(None).cast("string"), F.size(parts) - F.size(known))
    return F.concat(bare, known)


def all_blocks(docs: DataFrame) -> DataFrame:
    """``(file, competencia, tipo_calculo, pos, block, departamento)`` before filtering.

    The department is a backward as-of lookup inside the row: the last header that
    starts before the block, which is often in a preamble the filter drops later.  Headers
    are found on the whole text, so one that runs into the next employee line counts once.
    The work grows in step with the text, and nothing is written into it.
    """
    text = F.col("text")
    cut = compiled_in_pieces(docs).select("file", *document_fields(text), "text", split_blocks(text).alias("_blocks"))
    named = cut.select(
        "file", "competencia", "tipo_calculo", "_blocks", departments(text, F.col("_blocks")).alias("_departments")
    )
    # The outer form keeps Catalyst from adding a size filter that would cut every text twice.
    exploded = named.select("*", F.posexplode_outer("_blocks").alias("pos", "block"))
    return exploded.select(
        "file", "competencia", "tipo_calculo", "pos", "block", F.get("_departments", F.col("pos")).alias("departamento")
    )


def employee_blocks(docs: DataFrame) -> DataFrame:
    return all_blocks(docs).where(is_employee_block(F.col("block")))


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Documents that yield no employee block, instead of an error."""
    has_block = F.exists(split_blocks(F.col("text")), is_employee_block)
    return docs.where(~F.coalesce(has_block, F.lit(False))).select("file")


# -- block fields --------------------------------------------------------------------


def vinculo(block: Column) -> Column:
    """The kind that is named first (`P.VINCULO`); plain searches cost less than the pattern."""
    employee, contractor = block.contains("Empr"), block.contains("Contr")
    # a place is searched character by character, so only where both are named
    first = employee & (~contractor | (F.instr(block, "Empr") < F.instr(block, "Contr")))
    return F.when(first, "Empregado").when(contractor, "Contribuinte")


def with_header(block: Column, found: Column) -> Column:
    """What is found after an employee header: texts are cut there, so it can only begin the block."""
    return F.when(F.left(block, F.lit(1)).isin("E", "C", "e", "c"), found)


def situacao(block: Column) -> Column:
    labelled = P.first_full(block, P.SITUACAO)
    header = with_header(block, P.first_full(block, P.SITUACAO_HEADER))
    # a replacement keeps its compiled pattern; a split compiles it for each row
    return F.coalesce(
        strip(F.regexp_replace(labelled, P.SITUACAO_CUT + "(?s:.*)", "")), P.first_full(header, P.SITUACAO_END)
    )


def data_demissao(block: Column) -> Column:
    return F.coalesce(*(P.first_match(block, p) for p in (P.DEMISSAO_MOTIVO, P.DEMISSAO_DATA)))


def motivo_demissao(block: Column) -> Column:
    return strip(P.first_match(block, P.DEMISSAO_MOTIVO, 2))


def nome_bruto(block: Column) -> Column:
    return one_line(F.coalesce(with_header(block, P.first_match(block, P.NOME)), P.first_match(block, P.NOME_FERIAS)))


def cargo(block: Column) -> Column:
    return one_line(P.first_of(block, P.CARGO, P.CARGO_FERIAS))


def footer_amounts(block: Column) -> Column:
    """The texts of the amounts of a block, one for each field of `P.TOTALS` and empty where it has none.

    The first amount after the first label of a field counts, and one after its second label if
    the first is absent.  All are read from the footer by one search.
    """
    found = F.concat(F.lit("|"), F.array_join(P.all_matches(block, P.AMOUNTS), "|"))
    return F.split(F.regexp_replace(found, P.EACH_AMOUNT, P.EACH_LINE), "\n")


def total(amounts: Column, name: str) -> Column:
    return brl_number(F.get(amounts, F.lit(list(P.TOTALS).index(name))))


def extract_fields(blocks: DataFrame) -> DataFrame:
    """All block fields as read, plus the block itself; unused ones are pruned away."""
    block = F.col("block")
    leaves, amounts = F.col("_leaves"), F.col("_amounts")
    cut = blocks.select("*", block.rlike(P.DEMISSAO).alias("_leaves"), footer_amounts(block).alias("_amounts"))
    found = cut.select(
        *blocks.columns,
        vinculo(block).alias("vinculo"),
        situacao(block).alias("situacao"),
        F.when(leaves, data_demissao(block)).alias("data_demissao"),
        F.when(leaves, motivo_demissao(block)).alias("motivo_demissao"),
        nome_bruto(block).alias("_nome"),
        strip(P.first_full(block, P.CPF)).alias("cpf"),
        P.first_full(block, P.ADMISSAO).alias("data_admissao"),
        cargo(block).alias("cargo"),
        brl_number(P.first_full(block, P.SALARIO)).alias("salario_contratual"),
        *(total(amounts, name).alias(name) for name in P.TOTALS),
    )
    name = name_suffix_strip(F.col("_nome"), F.col("situacao"))
    return found.withColumn("nome_funcionario", name).drop("_nome")


# -- line items ----------------------------------------------------------------------


def item_table(block: Column) -> Column:
    """Text between the start and end markers; NULL when either is missing."""

    def at(marker: str) -> Column:
        # a place is searched character by character, so only where there is one
        return F.when(block.contains(marker), F.instr(block, marker))

    start = F.coalesce(at("CPF:"), at("Matrícula:"))
    end = F.coalesce(at("\nND:"), at("Total de Proventos"), at("Base INSS Férias"))
    return F.substring(block, start, end - start)


def lines_with_digit(text: Column) -> Column:
    """Lines of a text that hold a digit, of any script."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(P.ANY_DIGIT))


def table_body(block: Column) -> Column:
    """The item table after its first line, which is the tail of the header line and holds no item."""
    return F.get(F.split(item_table(block), "\n", 2), F.lit(1))


def item_lines(block: Column) -> Column:
    """Lines of the item table that can hold an item."""
    return lines_with_digit(table_body(block))


def layout_counts(line: Column) -> Column:
    """Matches of the regular and of the vacation item layout in one line.

    The vacation layout applies only with strictly more matches, and that cannot happen:
    a vacation match is also a regular one from the same start (its reference column
    joins the description) and the regular match ends no later, so scanning left to
    right the regular layout never falls behind.  Extraction therefore runs one pattern.
    """
    return F.struct(
        F.regexp_count(line, F.lit(P.ITEM_HOLERITE)).alias("holerite"),
        F.regexp_count(line, F.lit(P.ITEM_FERIAS)).alias("ferias"),
    )


def text_items(lines: Column) -> Column:
    """Items of one or more lines, in order; no match reaches over a line end.

    So a line end can part the groups of a match: no text inside an item holds one.
    """
    found = P.all_matches(lines, P.ITEM_TABLE)
    parted = F.transform(
        found, lambda m: F.split(F.regexp_replace(m, P.ITEM_TABLE, "$1\n$2\n$3\n$4"), "\n")
    )
    return F.transform(
        parted,
        lambda g: F.struct(
            F.get(g, F.lit(0)).alias("codigo"),
            F.get(g, F.lit(1)).alias("descricao"),
            brl_number(F.get(g, F.lit(2))).alias("valor"),
            F.get(g, F.lit(3)).alias("flag"),
        ),
    )


def has_value(item: Column) -> Column:
    """Keep an item only with a readable value other than zero."""
    return item["valor"].isNotNull() & (item["valor"] != 0)


def block_items(block: Column) -> Column:
    """Array of the items of a block; NULL or empty when it has none."""
    return F.filter(text_items(table_body(block)), has_value)


def flag_type(flag: Column) -> Column:
    """The printed flag decides the type whenever it and the map disagree."""
    return F.when(flag == "P", "Provento").when(flag == "D", "Desconto")


def fallback_name(description: Column) -> Column:
    trimmed = strip(F.regexp_replace(description, P.java(r"[\d\s/]+$"), ""))
    joined = F.upper(F.regexp_replace(trimmed, P.java(r"\s+"), "_"))
    return F.concat(F.lit("NAO_MAPEADO_"), joined)


def lookup_rubric(items: DataFrame, rubrics: DataFrame, code: str, description: str) -> DataFrame:
    """Add ``tipo_mapeado`` and ``nome_rubrica`` from the 188-row code map."""
    names = F.broadcast(
        rubrics.select(F.col("codigo").alias("_codigo"), "nome", F.col("tipo").alias("tipo_mapeado"))
    )
    name = F.coalesce("nome", F.when(F.col(code).isNotNull(), fallback_name(F.col(description))))
    return (
        items.join(names, strip(F.col(code)) == F.col("_codigo"), "left")
        .withColumn("nome_rubrica", name)
        .drop("_codigo", "nome")
    )


# -- records -------------------------------------------------------------------------


def raw_records(docs: DataFrame) -> DataFrame:
    """One row per employee block: file, position, block fields and nested items."""
    body = F.col("_body")
    fields = extract_fields(employee_blocks(docs)).withColumn("_body", table_body(F.col("block")))
    # Named twice, the body stays a column of its own; inside the lambdas it would be interpreted.
    items = F.when(body.isNotNull(), F.filter(text_items(body), has_value))
    return fields.withColumn("itens", items).drop("block", "_body")


def type_records(records: DataFrame) -> DataFrame:
    """Dates, decimals, digits-only cpf and clean texts; ``file``/``pos``/``itens`` as is.

    ``perdas`` lists the amounts that the decimal columns cannot hold, by column.
    """
    rules, lost = {}, []
    for name, kind in S.CONSOLIDATED.items():
        c = F.col(name)
        if kind == "date":
            rules[name] = parse_date_multi(c)
        elif kind == "decimal(10,2)":
            amount = decimal_or_reject(c)
            rules[name] = amount["value"]
            lost.append(F.when(amount["lost"].isNotNull(), F.struct(F.lit(name).alias("campo"), amount["lost"].alias("valor"))))
        else:
            rules[name] = clean_cpf(c) if name == "cpf" else clean_text(c)
    return typed(records.withColumn("perdas", F.array_compact(F.array(*lost))), rules)


def type_items(records: DataFrame) -> DataFrame:
    """Items by the rules of the detail frame: clean texts, the type of the printed flag, decimals (`S.ITEM`)."""

    def by_rule(item: Column) -> Column:
        return F.struct(
            clean_text(item["codigo"]).alias("codigo_rubrica"),
            clean_text(item["descricao"]).alias("descricao"),
            flag_type(item["flag"]).alias("tipo_rubrica"),
            to_decimal_safe(item["valor"]).alias("valor_rubrica"),
        )

    return typed(records, {"itens": F.transform("itens", by_rule)})


def consolidated(records: DataFrame, *also: Column) -> DataFrame:
    """The fields of each block; items and lost amounts are read only if they are asked for as well."""
    return records.select("file", "pos", *S.CONSOLIDATED, *also)


def detail(records: DataFrame, rubrics: DataFrame) -> DataFrame:
    """One row per item with the block keys; a block without items keeps one row of value 0.

    ``item`` is the place of the item in its block, 0 for the row of a block without items.
    """
    keys = ("file", "pos", "competencia", "tipo_calculo", "departamento", "vinculo",
            "nome_funcionario", "cpf", "situacao")
    rows = records.select(*keys, F.posexplode_outer("itens").alias("item", "found")).select(
        *keys,
        F.coalesce("item", F.lit(0)).alias("item"),
        F.col("found.codigo").alias("codigo_rubrica"),
        F.col("found.descricao").alias("_descricao"),
        flag_type(F.col("found.flag")).alias("tipo_rubrica"),
        F.when(F.col("found").isNull(), F.lit(0.0)).otherwise(F.col("found.valor")).alias("_valor"),
    )
    named = lookup_rubric(rows, rubrics, "codigo_rubrica", "_descricao")
    return named.select(
        "file",
        "pos",
        "item",
        *(
            to_decimal_safe(F.col("_valor")).alias(c)
            if c == "valor_rubrica"
            else clean_text(F.col(c)).alias(c)
            if c in ("codigo_rubrica", "nome_rubrica")
            else F.col(c)
            for c in S.DETAIL
        ),
    )
