from datetime import date
from decimal import Decimal

from payloom.plans import payslips
from payloom.sources.rubrics import scan_rubric_map

SAMPLE = """Competência: 10/2023
Cálculo: Folha Mensal
Departamento: FINANCEIRO
Empr.: 101 ANA EXEMPLO Situação: Trabalhando CPF: 111.222.333-44 Adm: 01/02/2020
Cargo: 12 ANALISTA Salário: 5.000,00
8781 SALARIO 220,00 5.000,00 P 998 INSS 11,00 550,00 D
777777 ITEM NOVO 1,00 10,00 P
ND: 0
Proventos: 5.010,00 Descontos: 550,00 Líquido: 4.460,00
Base INSS: 5.000,00 Base FGTS: 5.000,00 Valor FGTS: 400,00 Base IRRF: 4.450,00
"""


def records(spark, *texts):
    docs = spark.createDataFrame(
        [(f"d{i}", t) for i, t in enumerate(texts)], "file string, text string"
    )
    return payslips.type_records(payslips.raw_records(docs))


def test_sample_document(spark):
    rows = records(spark, SAMPLE)
    (r,) = payslips.consolidated(rows).collect()
    assert (r.departamento, r.competencia, r.tipo_calculo) == (
        "FINANCEIRO", date(2023, 10, 1), "Folha Mensal",
    )
    assert (r.vinculo, r.situacao, r.nome_funcionario, r.cpf, r.cargo) == (
        "Empregado", "Trabalhando", "ANA EXEMPLO", "11122233344", "ANALISTA",
    )
    assert r.data_admissao == date(2020, 2, 1)
    assert [r.salario_contratual, r.total_proventos, r.total_descontos, r.valor_liquido] == [
        Decimal("5000.00"), Decimal("5010.00"), Decimal("550.00"), Decimal("4460.00"),
    ]
    assert [r.base_inss, r.base_fgts, r.valor_fgts, r.base_irrf] == [
        Decimal("5000.00"), Decimal("5000.00"), Decimal("400.00"), Decimal("4450.00"),
    ]
    items = payslips.detail(rows, scan_rubric_map(spark)).collect()
    assert [(i.codigo_rubrica, i.nome_rubrica, i.tipo_rubrica, i.valor_rubrica) for i in items] == [
        ("8781", "Salario_Empregado", "Provento", Decimal("5000.00")),
        ("998", "INSS", "Desconto", Decimal("550.00")),
        ("777777", "NAO_MAPEADO_ITEM_NOVO_1,", "Provento", Decimal("10.00")),
    ]
