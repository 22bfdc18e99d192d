"""Extraction against the brute-force reading on many small, dirty documents."""

import random
import time

from pyspark.sql import functions as F

import brute
from payloom.functions import patterns as P
from payloom.plans import payslips
from test_payslips import SAMPLE

VACATION = """Período de Gozo: 01/03/2023 a 30/03/2023
Departamento: RH
Matrícula: 77
Nome do Funcionário BIA EXEMPLO PIS/PASEP: 1
CPF: 222.333.444-55 Adm: 03/04/2019
Cargo: AUXILIAR Data de Pagamento: 05/03/2023
8783 DIAS FERIAS 30/30 1.000,00 P 812 INSS 9,00 90,00 D
Total de Proventos 1.000,00 Total de Descontos 90,00
Líquido de Férias 910,00
Base INSS Férias 1.000,00 Base FGTS Férias 1.000,00 Valor FGTS Férias 80,00 Base IRRF Férias 910,00
"""
CONTRACTOR = """Contr: 9 CAIO EXEMPLO Afastado
CPF: 333.444.555-66 Adm: 01/01/2021
Cargo: 7 SOCIO C.B.O. 123
9380 PRO LABORE 30,00 2.000,00 P
150 HORAS 0,00 0,00 P
ND: 1
DEMITIDO EM 05/10/2023 - PEDIDO
Proventos: 2.000,00 Descontos: 0,00 Líquido: 2.000,00
"""
TWISTS = [
    ("\n", " "), (" ", "\xa0"), (" ", " "), (" ", "  "), ("\n", "\r\n"), (" ", "\x1d"), ("\n", "\x85"),
    (":", " :"), (",", "."), ("5", "٥"), ("0", "०"), ("1", "𝟙"), ("2", "᠒"), (".", "²"), ("Situação", "SITUAÇÃO"), ("Empr.", "EMPR"), ("Empr.", "Empr"),
    ("CPF:", ""), ("ND:", "XX"), ("Departamento", "departamento"), ("Férias", "FÉRIAS"),
    ("Líquido", "Liquido"), ("Total de", "TOTAL DE"), ("EXEMPLO", "EXEMPLO PIS:"), ("Trabalhando", ""),
    ("C.B.O", "С.B"), ("\nEmpr", " Empr"), ("Departamento: RH\n", "Departamento:\n"),
    (" ", " \uffff"), ("EXEMPLO", "EX\ufdd0EMPLO"), ("Departamento", "\uffffDepartamento"), ("ITEM", "IT\ufffeEM"),
    ("\n", "\n\n"), ("P ", "P\n"), ("10/2023", "1/2023"), (" Situação", "\nDepartamento: X Empr.\n: 7 Situação"), ("Departamento: ", "Departamento: A Departamento: "),
    ("FINANCEIRO\n", "FINANCEIRO "), ("RH\n", "RH EMPR:\n"), ("Departamento: ", "Departamento:\n Empr: 12 \n"), ("Competência", "REFERÊNCIA"), ("Adm", "Ad"),
]


def documents(n=400, seed=7):
    rng = random.Random(seed)
    for _ in range(n):
        text = "".join(rng.choices([SAMPLE, VACATION, CONTRACTOR, "Departamento: NOVO SETOR\n", "lixo\n"], k=rng.randint(0, 5)))
        for _ in range(rng.randint(0, 5)):
            old, new = rng.choice(TWISTS)
            spots = [i for i in range(len(text)) if text.startswith(old, i)]
            for i in sorted(rng.sample(spots, min(len(spots), rng.randint(1, 3))), reverse=True):
                text = text[:i] + new + text[i + len(old):]
        if rng.random() < 0.1:
            text = text.upper()
        yield text


def test_documents_match_brute_force(spark):
    texts = list(documents())
    docs = spark.createDataFrame([(f"{i:04d}", t) for i, t in enumerate(texts)], "file string, text string")
    got = {}
    for r in payslips.raw_records(docs).orderBy("file", "pos").collect():
        got.setdefault(r.file, []).append(r)
    blocks = 0
    for i, text in enumerate(texts):
        want, have = brute.read(text), got.get(f"{i:04d}", [])
        assert len(want) == len(have), (i, text)
        for (fields, items), row in zip(want, have):
            blocks += 1
            assert {k: row[k] for k in fields} == fields, (i, text)
            assert [tuple(x) for x in row.itens or []] == items, (i, text)
    assert blocks > 500
    rejected = {r.file for r in payslips.rejected_documents(docs).collect()}
    assert rejected == {f"{i:04d}" for i, t in enumerate(texts) if not brute.read(t)}


def test_patterns_match_python(spark):
    """Every pattern finds the same texts as Python's engine."""
    texts = list(documents(150, seed=11))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    named = {n: p for n, p in vars(P).items() if isinstance(p, P.Pattern) and n not in ("SPLIT", "ITEM_TABLE")}
    rows = df.select("id", *(P.all_matches(F.col("t"), p).alias(n) for n, p in named.items())).collect()
    for row in rows:
        for name, pattern in named.items():
            assert row[name] == [m.group(0) for m in brute.rx(pattern).finditer(texts[row.id])], name


def test_vacation_layout_never_wins(spark):
    rng = random.Random(3)
    words = ["12", "777", "ITEM", "30/30", "1,00", "5.000,00", "P", "D", "X", "9%", " ", "\xa0"]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "linha string")
    n = df.select(payslips.layout_counts(F.col("linha")).alias("n"))
    assert n.where("n.ferias > n.holerite").isEmpty()
    assert not n.where("n.ferias > 0").isEmpty()


def test_items_of_many_lines_equal_items_per_line(spark):
    rng = random.Random(5)
    words = ["12", "777", "ITEM", "30/30", "1,00", "5.000,00", "P", "D", "X", "\n", "\n"]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for row in df.select("id", payslips.text_items(F.col("t")).alias("i")).collect():
        want = [
            (m.group(1), m.group(2), brute.money(m.group(3)), m.group(4))
            for line in texts[row.id].split("\n")
            for m in brute.rx(P.ITEM_HOLERITE).finditer(line)
        ]
        assert [tuple(x) for x in row.i] == want


def test_work_grows_with_the_number_of_blocks(spark):
    """Eight times the blocks take about eight times as long, and give the right departments."""
    def seconds(n, every=1):
        """``every``: blocks for each header; a text may go on for long after its last header."""
        text = "".join(
            (f"Departamento: D{i}\n" if i % every == 0 else "")
            + f"Empr: {i} FUNC {i} CPF: 111.222.333-44 Adm: 01/02/2020 resto da linha\n"
            for i in range(n)
        )
        docs = spark.createDataFrame([("f", text)], "file string, text string")
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            blocks = payslips.all_blocks(docs).where("pos > 0")
            wrong = F.sum((F.col("departamento") != F.concat(F.lit("D"), F.col("pos") - 1 - (F.col("pos") - 1) % every)).cast("int"))
            row = blocks.agg(F.count("*").alias("n"), wrong.alias("wrong")).first()
            best = min(best, time.perf_counter() - start)
            assert (row.n, row.wrong) == (n, 0)
        return best

    seconds(100)
    assert seconds(32_000) < 16 * max(seconds(4_000), 0.25)
    assert seconds(32_000, every=32_000) < 16 * max(seconds(4_000, every=4_000), 0.25)
