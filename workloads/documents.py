"""Queries that read payslip texts: splitting, field extraction, line items, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.functions import patterns as P
from payloom.functions.text import name_suffix_strip
from payloom.plans import payslips, rejected
from payloom.session import work_folder
from payloom.sources.files import read_csv_locale, scan_payslip_table, scan_payslip_text, write_csv_locale
from payloom.sources.rubrics import RUBRICA_LABELS, scan_rubric_map
from workloads.registry import query, table
from workloads.render import BLOCKS_SQL, ITEMS_SQL, brl, cents, payslip_docs, spread, text_of

RUBRIC_SQL = "rub(codigo, tipo, nome) AS (VALUES " + ", ".join(
    "('{}', '{}', '{}')".format(
        code, "Provento" if label.startswith("P_") else "Desconto", label.split("_", 2)[2]
    )
    for code, label in (line.split(" ", 1) for line in RUBRICA_LABELS.strip().splitlines())
) + ")"
BR_DATE = "CAST(strptime({0}, '%d/%m/%Y') AS DATE)"
PERIOD = "strptime('01/' || competencia, '%d/%m/%Y')"


def block_fields(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    fields = payslips.extract_fields(payslips.employee_blocks(payslip_docs(spark, sf)))
    return fields.select("file", "pos", *columns)


def field_query(name: str, *columns: str) -> None:
    sql = f"{BLOCKS_SQL} SELECT file, pos, {', '.join(columns)} FROM blocks"
    query(name, sql)(lambda spark, sf: block_fields(spark, sf, *columns))


for _name, _columns in {
    "x_competencia": ("competencia",),
    "x_tipo_calculo": ("tipo_calculo",),
    "x_departamento": ("departamento",),
    "x_vinculo": ("vinculo",),
    "x_situacao": ("situacao",),
    "x_demissao": ("data_demissao", "motivo_demissao"),
    "x_nome": ("nome_funcionario",),
    "x_cpf": ("cpf",),
    "x_admissao": ("data_admissao",),
    "x_cargo": ("cargo",),
    "x_salario": ("salario_contratual",),
    "x_total_proventos": ("total_proventos",),
    "x_total_descontos": ("total_descontos",),
    "x_valor_liquido": ("valor_liquido",),
    "x_base_inss": ("base_inss",),
    "x_base_fgts": ("base_fgts",),
    "x_valor_fgts": ("valor_fgts",),
    "x_base_irrf": ("base_irrf",),
    "regex_extract_fields": (
        "competencia", "tipo_calculo", "departamento", "vinculo", "situacao", "data_demissao",
        "motivo_demissao", "nome_funcionario", "cpf", "data_admissao", "cargo", *S.CONSOL_MONEY,
    ),
}.items():
    field_query(_name, *_columns)


@query("case_employment_link", f"{BLOCKS_SQL} SELECT vinculo, count(*) AS n FROM blocks GROUP BY vinculo")
def case_employment_link(spark, sf):
    blocks = payslips.employee_blocks(payslip_docs(spark, sf))
    linked = blocks.select(payslips.vinculo(F.col("block")).alias("vinculo"))
    return linked.groupBy("vinculo").agg(F.count(F.lit(1)).alias("n"))


@query(
    "asof_section_header",
    f"{BLOCKS_SQL} SELECT departamento, count(*) AS n, count(DISTINCT file) AS n_docs "
    "FROM blocks GROUP BY departamento",
)
def asof_section_header(spark, sf):
    blocks = payslips.employee_blocks(payslip_docs(spark, sf)).select("file", "departamento")
    per_doc = blocks.groupBy("departamento", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("departamento").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs")
    )


@query(
    "split_blocks",
    BLOCKS_SQL
    + """, parts AS (
  SELECT file, pos FROM blocks
  UNION ALL SELECT file, 3 FROM ext WHERE k % 19 = 2
  UNION ALL SELECT file, 0 FROM ext WHERE vazio = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0 FROM orders WHERE o_orderkey % 17 IN (3, 4)
) SELECT file, count(*) AS n_partes FROM parts GROUP BY file""",
)
def split_blocks(spark, sf):
    docs = payslip_docs(spark, sf)
    return docs.select("file", F.size(payslips.split_blocks(F.col("text"))).alias("n_partes"))


@query("filter_blocks", f"{BLOCKS_SQL} SELECT file, count(*) AS n FROM blocks GROUP BY file")
def filter_blocks(spark, sf):
    kept = F.filter(payslips.split_blocks(F.col("text")), payslips.is_employee_block)
    counted = payslip_docs(spark, sf).select("file", F.size(kept).alias("n"))
    return counted.where("n > 0")


@query("x_item_table", f"{BLOCKS_SQL} SELECT file, pos, CAST(n_linhas AS BIGINT) AS n_linhas FROM blocks")
def x_item_table(spark, sf):
    blocks = payslips.employee_blocks(payslip_docs(spark, sf))
    lines = payslips.item_lines(F.col("block"))
    return blocks.select("file", "pos", F.coalesce(F.array_size(lines), F.lit(0)).alias("n_linhas"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    blocks = payslips.extract_fields(payslips.employee_blocks(payslip_docs(spark, sf)))
    exploded = blocks.withColumn("item", F.explode_outer(payslips.block_items(F.col("block"))))
    return exploded.where("item is not null").drop("block").select("*", "item.*").drop("item")


@query("x_items", f"{ITEMS_SQL} SELECT file, pos, codigo, descricao, valor, flag FROM items")
def x_items(spark, sf):
    return items(spark, sf).select("file", "pos", "codigo", "descricao", "valor", "flag")


@query(
    "x_item_type",
    f"{ITEMS_SQL}, {RUBRIC_SQL} SELECT codigo, flag, tipo AS tipo_mapeado, "
    "CASE flag WHEN 'P' THEN 'Provento' ELSE 'Desconto' END AS tipo_rubrica, count(*) AS n "
    "FROM items LEFT JOIN rub USING (codigo) GROUP BY ALL",
)
def x_item_type(spark, sf):
    rows = items(spark, sf).select("codigo", "descricao", "flag")
    mapped = payslips.lookup_rubric(rows, scan_rubric_map(spark), "codigo", "descricao")
    typed = mapped.withColumn("tipo_rubrica", payslips.flag_type(F.col("flag")))
    return typed.groupBy("codigo", "flag", "tipo_mapeado", "tipo_rubrica").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x_item_keys",
    f"{ITEMS_SQL} SELECT file, pos, competencia, tipo_calculo, departamento, vinculo, "
    "nome_funcionario, cpf, situacao, codigo FROM items",
)
def x_item_keys(spark, sf):
    return items(spark, sf).select(
        "file", "pos", "competencia", "tipo_calculo", "departamento", "vinculo",
        "nome_funcionario", "cpf", "situacao", "codigo",
    )


def item_line_rows(spark: SparkSession, sf: str) -> DataFrame:
    return render_item_lines(spark, sf)


def render_item_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One item line with two items per lineitem; every seventh line has no item."""
    rows = spread(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    ))
    price, part = cents(F.col("l_extendedprice")), F.col("l_partkey")
    line = F.when(part % 7 == 0, text_of("TOTAL GERAL ", part, " SEM ITEM")).otherwise(
        text_of(
            part + 10, " VENCIMENTO ", F.col("l_quantity").cast("int"), ",00 ", brl(price), " P ",
            F.col("l_orderkey") + 10, " DESCONTO 7/30 ", brl(cents(F.col("l_discount"))), " D",
        )
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", line.alias("linha"))


LINE_SQL = """WITH l AS (SELECT *, l_partkey % 7 <> 0 AS tem FROM lineitem), m AS (
  SELECT l_orderkey, l_linenumber, CAST(l_partkey + 10 AS VARCHAR) AS codigo,
         'VENCIMENTO ' || CAST(l_quantity AS INT) || ',00' AS descricao,
         CAST(round(l_extendedprice * 100) AS BIGINT) / 100 AS valor, 'P' AS flag FROM l WHERE tem
  UNION ALL
  SELECT l_orderkey, l_linenumber, CAST(l_orderkey + 10 AS VARCHAR), 'DESCONTO 7/30',
         CAST(round(l_discount * 100) AS BIGINT) / 100, 'D' FROM l WHERE tem)
"""


@query("regex_extract_repeating", LINE_SQL + "SELECT * FROM m")
def regex_extract_repeating(spark, sf):
    found = item_line_rows(spark, sf).select(
        "l_orderkey", "l_linenumber", F.explode_outer(payslips.text_items(F.col("linha"))).alias("i")
    ).where("i is not null")
    return found.select("l_orderkey", "l_linenumber", "i.codigo", "i.descricao", "i.valor", "i.flag")


@query(
    "filter_zero_values",
    LINE_SQL + "SELECT codigo, sum(CAST(round(valor * 100) AS BIGINT)) AS centavos, count(*) AS n "
    "FROM m WHERE valor <> 0 GROUP BY codigo",
)
def filter_zero_values(spark, sf):
    kept = F.filter(payslips.text_items(F.col("linha")), payslips.has_value)
    found = item_line_rows(spark, sf).select(F.explode_outer(kept).alias("i")).where("i is not null")
    found = found.select("i.*")
    return found.groupBy("codigo").agg(
        F.sum(cents(F.col("valor"))).alias("centavos"), F.count(F.lit(1)).alias("n")
    )


@query(
    "count_matches",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN 0 ELSE 2 END AS n_holerite, "
    "CASE WHEN l_partkey % 7 = 0 THEN 0 ELSE 2 END AS n_ferias, 'false' AS usa_ferias FROM lineitem",
)
def count_matches(spark, sf):
    n = payslips.layout_counts(F.col("linha"))
    counted = item_line_rows(spark, sf).select("l_orderkey", "l_linenumber", n.alias("n"))
    return counted.select(
        "l_orderkey", "l_linenumber",
        F.col("n.holerite").alias("n_holerite"),
        F.col("n.ferias").alias("n_ferias"),
        (F.col("n.ferias") > F.col("n.holerite")).alias("usa_ferias"),
    )


@query(
    "filter_lines_with_digit",
    "SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: "
    "regexp_matches(x, '\\p{Nd}'))) AS BIGINT) AS n_linhas FROM documents",
)
def filter_lines_with_digit(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.size(payslips.lines_with_digit(F.col("text"))).alias("n_linhas"))


@query(
    "first_match",
    "SELECT doc_id, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS numero, "
    "CAST(strpos(text, 'the') AS BIGINT) AS posicao FROM documents",
)
def first_match(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id",
        P.first_match(F.col("text"), "([0-9]+)").alias("numero"),
        F.instr("text", "the").alias("posicao"),
    )


@query(
    "substring_between",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 <> 0 THEN 'CPF: ' || l_suppkey "
    "|| chr(10) || 'ITEM ' || l_partkey END AS trecho FROM lineitem",
)
def substring_between(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    end = F.when(F.col("l_partkey") % 5 == 0, "FIM").otherwise("\nND: 0")
    text = text_of("CABECA ", F.col("l_orderkey"), " CPF: ", F.col("l_suppkey"), "\nITEM ",
                   F.col("l_partkey"), end)
    return rows.select("l_orderkey", "l_linenumber", payslips.item_table(text).alias("trecho"))


@query("name_suffix_strip", "SELECT c_custkey, c_name AS nome FROM customer")
def name_suffix_strip_query(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k, status = F.col("c_custkey"), F.col("c_mktsegment")
    shown = F.when(k % 3 == 0, text_of(F.col("c_name"), " ", F.lower(status))).when(
        k % 3 == 1, text_of(F.col("c_name"), " Depto: ", status)
    ).otherwise(F.col("c_name"))
    known = F.when(k % 3 != 2, status)
    return customers.select("c_custkey", name_suffix_strip(shown, known).alias("nome"))


@query(
    "period_from_text",
    f"{BLOCKS_SQL} SELECT file, competencia FROM doc UNION ALL "
    "SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 17 IN (3, 4)",
)
def period_from_text(spark, sf):
    docs = payslip_docs(spark, sf)
    return docs.select("file", payslips.document_fields(F.col("text"))[0])


# -- scans ---------------------------------------------------------------------------


@query("scan_payslip_text", f"{BLOCKS_SQL} SELECT cpf, count(*) AS n FROM blocks GROUP BY cpf")
def scan_payslip_text_query(spark, sf):
    """Texts written as packed files of at most 200 orders, then read back one row per file."""
    folder = work_folder(spark, "scan-text")
    payslip_docs(spark, sf).select("text").write.option("maxRecordsPerFile", 200).text(folder, compression="gzip")
    blocks = payslips.employee_blocks(scan_payslip_text(spark, folder, ".txt.gz"))
    cpf = payslips.extract_fields(blocks).select("cpf").where("cpf is not null")
    return cpf.groupBy("cpf").agg(F.count(F.lit(1)).alias("n"))


@query(
    "scan_isolate_bad_docs",
    "SELECT CAST(o_orderkey AS VARCHAR) AS file FROM orders WHERE o_orderkey % 17 IN (3, 4)",
)
def scan_isolate_bad_docs(spark, sf):
    return payslips.rejected_documents(payslip_docs(spark, sf))


@query(
    "union_append_docs",
    "SELECT CAST(o_orderkey AS VARCHAR) AS file, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS n "
    "FROM orders",
)
def union_append_docs(spark, sf):
    """Documents of two folders appended; a document in both stays twice."""
    first = work_folder(spark, "append-all")
    second = work_folder(spark, "append-monthly")
    payslip_docs(spark, sf).write.parquet(first)
    payslip_docs(spark, sf).join(
        table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
            F.col("o_orderkey").cast("string").alias("file")
        ),
        "file", "left_semi",
    ).write.parquet(second)
    both = scan_payslip_table(spark, first).unionByName(scan_payslip_table(spark, second))
    return both.groupBy("file").agg(F.count(F.lit(1)).alias("n"))


# -- records -------------------------------------------------------------------------

TYPED_SQL = f"""{BLOCKS_SQL}, typed AS (
  SELECT file, pos, k, CAST({PERIOD} AS DATE) AS competencia, tipo_calculo, departamento, vinculo,
         nome_funcionario, situacao, {BR_DATE.format('data_demissao')} AS data_demissao, motivo_demissao,
         cargo, {BR_DATE.format('data_admissao')} AS data_admissao,
         nullif(replace(replace(cpf, '.', ''), '-', ''), '') AS cpf,
         salario_contratual, total_proventos, total_descontos, valor_liquido, base_inss, base_fgts,
         valor_fgts, base_irrf FROM blocks)"""


def typed_text(columns) -> str:
    dates = set(S.CONSOL_DATES)
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in dates else c for c in columns)


def typed_records(spark: SparkSession, sf: str) -> DataFrame:
    return payslips.type_records(payslips.raw_records(payslip_docs(spark, sf)))


# Items and lost amounts of a block as text: ``;`` between the values of one, ``|`` between two.
MONEY_TEXT = "CAST(CAST({0} AS DECIMAL(38,2)) AS VARCHAR)"
TYPED_ALL_SQL = (
    TYPED_SQL.replace(BLOCKS_SQL, ITEMS_SQL)
    + """, listed AS (
  SELECT file, pos, string_agg(codigo || ';' || descricao || ';' || CASE flag WHEN 'P' THEN 'Provento' ELSE 'Desconto' END
         || ';' || CASE WHEN abs(valor) < 99999999.995 THEN """
    + MONEY_TEXT.format("valor")
    + """ ELSE '' END, '|' ORDER BY n) AS itens
  FROM (SELECT DISTINCT file, pos, n, codigo, descricao, valor, flag FROM items) GROUP BY file, pos)"""
    + f" SELECT file, pos, {typed_text(S.CONSOLIDATED)}, coalesce(itens, '') AS itens, concat_ws('|', "
    + ", ".join(f"CASE WHEN abs({c}) >= 99999999.995 THEN '{c};' || {MONEY_TEXT.format(c)} END" for c in S.CONSOL_MONEY)
    + ") AS perdas FROM typed LEFT JOIN listed USING (file, pos)"
)


@query("typed_cast_columns", TYPED_ALL_SQL)
def typed_cast_columns(spark, sf):
    """Both frames of a block by their column rules: its fields and its items, and the amounts that they cannot hold."""
    records = payslips.type_items(typed_records(spark, sf))

    def listed(column: str, *values) -> Column:
        shown = F.transform(column, lambda x: F.concat_ws(";", *(F.coalesce(v(x), F.lit("")) for v in values)))
        return F.coalesce(F.array_join(shown, "|"), F.lit("")).alias(column)

    return payslips.consolidated(
        records,
        listed("itens", *(lambda i, c=c: i[c].cast("string") for c in S.ITEM)),
        listed("perdas", lambda p: p["campo"], lambda p: p["valor"].cast("decimal(38,2)").cast("string")),
    )


@query(
    "rejects",
    f"{TYPED_SQL} SELECT 'folha' AS etapa, 'documento sem bloco' AS regra, CAST(o_orderkey AS VARCHAR) AS chave, "
    "NULL AS valor FROM orders WHERE o_orderkey % 17 IN (3, 4) UNION ALL "
    "SELECT 'folha', 'pessoa sem cpf', file || '#' || pos, nome_funcionario FROM typed WHERE cpf IS NULL",
)
def rejects(spark, sf):
    """What the payroll stage leaves out: documents without a block and people without a cpf."""
    people = rejected.payroll_people(typed_records(spark, sf))
    return rejected.documents(payslip_docs(spark, sf)).unionByName(people)


DETAIL_SQL = f"""{ITEMS_SQL}, {RUBRIC_SQL}, det AS (
  SELECT file, pos, CAST({PERIOD} AS DATE) AS competencia, tipo_calculo, departamento, vinculo,
         nome_funcionario, nullif(replace(replace(cpf, '.', ''), '-', ''), '') AS cpf, situacao,
         codigo AS codigo_rubrica,
         coalesce(nome, 'NAO_MAPEADO_' || CASE n WHEN 3 THEN 'ITEM_NOVO_1,' ELSE
           CASE flag WHEN 'P' THEN 'DESC_UM_220,' ELSE 'DESC_DOIS_11,' END END) AS nome_rubrica,
         CASE flag WHEN 'P' THEN 'Provento' ELSE 'Desconto' END AS tipo_rubrica, valor AS valor_rubrica
  FROM items LEFT JOIN rub USING (codigo)
  UNION ALL
  SELECT file, pos, CAST({PERIOD} AS DATE), tipo_calculo, departamento, vinculo, nome_funcionario,
         nullif(replace(replace(cpf, '.', ''), '-', ''), ''), situacao, NULL, NULL, NULL, 0.0
  FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.file = b.file AND i.pos = b.pos))"""


@query("explode_outer_default", f"{DETAIL_SQL} SELECT file, pos, {typed_text(S.DETAIL)} FROM det")
def explode_outer_default(spark, sf):
    return payslips.detail(typed_records(spark, sf), scan_rubric_map(spark)).drop("item")


@query(
    "sink_csv_locale",
    f"{DETAIL_SQL} SELECT {typed_text(S.DETAIL)} FROM det",
)
def sink_csv_locale(spark, sf):
    folder = work_folder(spark, "csv")
    rows = payslips.detail(typed_records(spark, sf), scan_rubric_map(spark))
    write_csv_locale(rows.drop("file", "pos", "item"), folder)
    return read_csv_locale(spark, folder, S.DETAIL)


@query(
    "distinct_periods",
    f"{BLOCKS_SQL} SELECT DISTINCT CAST(CAST({PERIOD} AS DATE) AS VARCHAR) AS competencia FROM blocks "
    "WHERE competencia IS NOT NULL",
)
def distinct_periods_query(spark, sf):
    from payloom.operators.dedup import distinct_periods

    return distinct_periods(payslips.consolidated(typed_records(spark, sf)))
