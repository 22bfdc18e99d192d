"""Fixed schemas and column policies of the star schema."""

from __future__ import annotations


def ddl(text: str) -> dict[str, str]:
    """``"a int, b date"`` as an ordered column -> type mapping."""
    return dict(part.split(" ", 1) for part in text.split(", "))


def to_ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in schema.items())


UNKNOWN_SK = 0
UNKNOWN_NAME = "Desconhecido"
UNKNOWN_CPF = "N/A"
UNKNOWN_API_ID = -1

# Block fields of a payslip, by type.
CONSOL_DATES = ("competencia", "data_demissao", "data_admissao")
CONSOL_MONEY = (
    "salario_contratual", "total_proventos", "total_descontos", "valor_liquido",
    "base_inss", "base_fgts", "valor_fgts", "base_irrf",
)

CONSOLIDATED = ddl(
    "competencia date, tipo_calculo string, departamento string, vinculo string, "
    "nome_funcionario string, situacao string, data_demissao date, motivo_demissao string, "
    "cargo string, data_admissao date, cpf string, salario_contratual decimal(10,2), "
    "total_proventos decimal(10,2), total_descontos decimal(10,2), valor_liquido decimal(10,2), "
    "base_inss decimal(10,2), base_fgts decimal(10,2), valor_fgts decimal(10,2), "
    "base_irrf decimal(10,2)"
)
DETAIL = ddl(
    "competencia date, tipo_calculo string, departamento string, vinculo string, "
    "nome_funcionario string, cpf string, situacao string, codigo_rubrica string, "
    "nome_rubrica string, tipo_rubrica string, valor_rubrica decimal(10,2)"
)
ITEM = ddl("codigo_rubrica string, descricao string, tipo_rubrica string, valor_rubrica decimal(10,2)")

BASE_ATTRIBUTES = (
    "data_admissao_csv", "data_demissao_csv", "situacao_csv", "departamento_csv", "cargo_csv",
)
DIM_BASE = ddl(
    "colaborador_sk bigint, nome_colaborador string, cpf string, data_admissao_csv date, "
    "data_demissao_csv date, situacao_csv string, departamento_csv string, cargo_csv string"
)

FATO_CONSOLIDADA = ddl(
    "colaborador_sk bigint, nome_funcionario_csv string, centro_de_custo string, "
    "cargo_nome_csv string, cpf_csv string, situacao_csv string, tipo_calculo_csv string, "
    "salario_contratual decimal(12,2), total_proventos decimal(12,2), "
    "total_descontos decimal(12,2), valor_liquido decimal(12,2), base_inss decimal(12,2), "
    "base_fgts decimal(12,2), valor_fgts decimal(12,2), base_irrf decimal(12,2), "
    "arquivo_origem string, competencia date"
)
FATO_DETALHADA = ddl(
    "colaborador_sk bigint, nome_funcionario_csv string, centro_de_custo string, cpf_csv string, "
    "situacao_csv string, tipo_calculo_csv string, codigo_rubrica string, nome_rubrica string, "
    "tipo_rubrica string, valor_rubrica decimal(12,2), arquivo_origem string, competencia date"
)
FATO_BENEFICIOS = ddl(
    "colaborador_sk bigint, tipo_beneficio string, nome_beneficio string, "
    "valor_beneficio decimal(12,2), valor_desconto decimal(12,2), periodicidade string, "
    "opcao_desconto string, aplicado_como string, data_atualizacao timestamp"
)

# Stored facts begin with a row number of their own.
FACT_IDS = ("fato_folha_id", "fato_rubrica_id", "beneficio_id")


def with_id(name: str, schema: dict[str, str]) -> dict[str, str]:
    return {name: "bigint", **schema}


# Money fields are VARIANT: a JSON number and a JSON string follow different rules.
EMPLOYEE = (
    "id bigint, name string, email string, registration string, birthDate string, "
    "gender string, maritalStatus string, salutation string, nationality string, "
    "typeOfSpecialNeed string, birthplace string, fatherName string, motherName string, "
    "disabledPerson boolean, dateAdmission string, dateDismissal string, salary variant, "
    "workShift string, typeContract string, dateContract string, education string, "
    "course string, hierarchicalLevel string, durationContract string, "
    "contractExpirationDate string, experiencePeriod int, formDismissal string, "
    "decisionDismissal string, terminationAmount variant, totalBenefits variant, "
    "active boolean, ethnicity string, updated_at string, "
    "senior struct<id: bigint, name: string>, unity struct<id: bigint, name: string>, "
    "position struct<id: bigint, name: string>, departament struct<id: bigint, name: string>, "
    "address struct<zipCode: string, streetName: string, number: string, "
    "additionalInformation: string, neighborhood: string, "
    "city: struct<name: string, state: struct<initials: string>>>, "
    "contact struct<cellPhone: string, personalEmail: string, emergencyPhoneNumber: string>, "
    "documents struct<idNumber: string, rg: string, dispatchDate: string, issuingBody: string, "
    "voterRegistration: string, electoralZone: string, electoralSection: string, "
    "ctpsNum: string, ctpsSerie: string, pis: string, bank: string, agency: string, "
    "checkingsAccount: string>, "
    "benefits array<struct<benefitName: string, typeBenefit: string, value: variant, "
    "valueDiscount: variant, dates: string, discountOption: string, benefitAppliedAs: string>>"
)

# JSON path -> staging column.
EMPLOYEE_RENAME = {
    "id": "colaborador_id_solides",
    "documents.idNumber": "cpf",
    "name": "nome_completo",
    "registration": "matricula",
    "email": "email_corporativo",
    "birthDate": "data_nascimento",
    "gender": "genero",
    "maritalStatus": "estado_civil",
    "salutation": "saudacao",
    "nationality": "nacionalidade",
    "typeOfSpecialNeed": "tipo_necessidade_especial",
    "birthplace": "naturalidade",
    "fatherName": "nome_pai",
    "motherName": "nome_mae",
    "disabledPerson": "pcd",
    "dateAdmission": "data_admissao",
    "dateDismissal": "data_demissao",
    "salary": "salario_api",
    "workShift": "turno_trabalho",
    "typeContract": "tipo_contrato",
    "dateContract": "data_contrato",
    "education": "escolaridade",
    "course": "curso_formacao",
    "hierarchicalLevel": "nivel_hierarquico",
    "durationContract": "duracao_contrato",
    "contractExpirationDate": "data_expiracao_contrato",
    "experiencePeriod": "periodo_experiencia_dias",
    "formDismissal": "forma_demissao",
    "decisionDismissal": "decisao_demissao",
    "terminationAmount": "valor_rescisao",
    "totalBenefits": "total_beneficios_api",
    "active": "ativo",
    "ethnicity": "etnia",
    "updated_at": "data_ultima_atualizacao_api",
    "senior.name": "nome_lider_imediato",
    "senior.id": "lider_id_solides",
    "unity.name": "unidade_nome",
    "unity.id": "unidade_id_solides",
    "position.name": "cargo_nome_api",
    "position.id": "cargo_id_solides",
    "departament.name": "departamento_nome_api",
    "departament.id": "departamento_id_solides",
    "address.zipCode": "cep",
    "address.streetName": "logradouro",
    "address.number": "numero_endereco",
    "address.additionalInformation": "complemento_endereco",
    "address.neighborhood": "bairro",
    "address.city.name": "cidade",
    "address.city.state.initials": "estado",
    "contact.cellPhone": "celular",
    "contact.personalEmail": "email_pessoal",
    "contact.emergencyPhoneNumber": "telefone_emergencia",
    "documents.rg": "rg",
    "documents.dispatchDate": "data_emissao_rg",
    "documents.issuingBody": "orgao_emissor_rg",
    "documents.voterRegistration": "titulo_eleitor",
    "documents.electoralZone": "zona_eleitoral",
    "documents.electoralSection": "secao_eleitoral",
    "documents.ctpsNum": "ctps_numero",
    "documents.ctpsSerie": "ctps_serie",
    "documents.pis": "pis",
    "documents.bank": "banco_nome",
    "documents.agency": "banco_agencia",
    "documents.checkingsAccount": "banco_conta",
}
API_DATES = (
    "data_nascimento", "data_admissao", "data_demissao", "data_contrato",
    "data_expiracao_contrato", "data_emissao_rg", "data_ultima_atualizacao_api",
)
API_MONEY = ("salario_api", "valor_rescisao", "total_beneficios_api")
API_BOOLEANS = ("pcd", "ativo")
API_IDS = (
    "colaborador_id_solides", "lider_id_solides", "unidade_id_solides", "cargo_id_solides",
    "departamento_id_solides",
)


def _api_type(column: str) -> str:
    if column in API_DATES:
        return "date"
    if column in API_MONEY:
        return "double"
    if column in API_BOOLEANS:
        return "boolean"
    if column in API_IDS:
        return "bigint"
    return "int" if column == "periodo_experiencia_dias" else "string"


# The 64 staging columns, in order.
STG_COLABORADORES = ddl(", ".join(f"{c} {_api_type(c)}" for c in EMPLOYEE_RENAME.values()))

BENEFIT_RENAME = {
    "benefitName": "nome_beneficio",
    "typeBenefit": "tipo_beneficio",
    "dates": "periodicidade",
    "discountOption": "opcao_desconto",
    "benefitAppliedAs": "aplicado_como",
}
STG_BENEFICIOS = ddl(
    "colaborador_id_solides bigint, ordem int, nome_beneficio string, tipo_beneficio string, "
    "valor_beneficio double, valor_desconto double, periodicidade string, "
    "opcao_desconto string, aplicado_como string"
)

# Columns of the rich dimension refreshed on every load.
RICH_OVERWRITE = (
    "cpf", "nome_completo", "matricula", "rg", "pis", "data_nascimento", "genero",
    "estado_civil", "nacionalidade", "naturalidade", "etnia", "nome_pai", "nome_mae",
    "email_corporativo", "email_pessoal", "celular", "telefone_emergencia", "cep",
    "logradouro", "numero_endereco", "complemento_endereco", "bairro", "cidade", "estado",
    "cargo_nome_api", "nivel_hierarquico", "departamento_nome_api", "salario_api",
    "data_admissao", "ativo", "nome_lider_imediato", "unidade_nome", "banco_nome",
    "banco_agencia", "banco_conta", "data_ultima_atualizacao",
)
# Columns that keep what the first insert wrote.
RICH_INSERT_ONLY = (
    "escolaridade", "data_demissao", "turno_trabalho", "tipo_contrato", "curso_formacao",
    "saudacao", "tipo_necessidade_especial", "pcd", "data_emissao_rg", "orgao_emissor_rg",
    "titulo_eleitor", "zona_eleitoral", "secao_eleitoral", "ctps_numero", "ctps_serie",
    "data_contrato", "duracao_contrato", "data_expiracao_contrato",
    "periodo_experiencia_dias", "forma_demissao", "decisao_demissao", "valor_rescisao",
    "total_beneficios_api", "cargo_id_solides", "departamento_id_solides",
    "lider_id_solides", "unidade_id_solides", "data_ultima_atualizacao_api",
)


def _rich_type(column: str) -> str:
    if column in API_MONEY:
        return "decimal(12,2)"
    if column == "data_ultima_atualizacao":
        return "timestamp"
    return _api_type(column)


# API ids keep 64 bits here, so none is lost on the way in; ``email`` exists but no load fills it.
DIM_RICH = ddl(
    "colaborador_sk bigint, colaborador_id_solides bigint, "
    + ", ".join(f"{c} {_rich_type(c)}" for c in (*RICH_OVERWRITE, *RICH_INSERT_ONLY))
    + ", email string"
)

CALENDAR_START, CALENDAR_END = "2023-01-01", "2030-12-31"

# The longest text that a column of a table takes.
_BASE_TEXT = dict(
    nome_colaborador=255, cpf=20, situacao_csv=100, departamento_csv=255, cargo_csv=255,
)
_CONSOL_TEXT = dict(
    nome_funcionario_csv=255, centro_de_custo=255, cargo_nome_csv=255, cpf_csv=11, situacao_csv=100,
    tipo_calculo_csv=100,
)
_DETAIL_TEXT = dict(
    nome_funcionario_csv=255, centro_de_custo=255, cpf_csv=11, situacao_csv=100, tipo_calculo_csv=100,
    codigo_rubrica=100, nome_rubrica=255, tipo_rubrica=100,
)
_BENEFIT_TEXT = dict(
    tipo_beneficio=100, nome_beneficio=255, periodicidade=50, opcao_desconto=50, aplicado_como=50,
)
_RICH_TEXT = dict(
    cpf=11, nome_completo=255, genero=50, departamento_nome_api=255, cargo_nome_api=255, email=255,
    matricula=50, email_corporativo=255, estado_civil=50, saudacao=50, nacionalidade=100,
    tipo_necessidade_especial=100, naturalidade=100, nome_pai=255, nome_mae=255, turno_trabalho=100,
    tipo_contrato=100, escolaridade=100, curso_formacao=255, nivel_hierarquico=100,
    duracao_contrato=100, forma_demissao=100, decisao_demissao=100, etnia=50,
    nome_lider_imediato=255, unidade_nome=255, cep=20, logradouro=255, numero_endereco=50,
    complemento_endereco=100, bairro=100, cidade=100, estado=50, celular=50, email_pessoal=255,
    telefone_emergencia=50, rg=50, orgao_emissor_rg=50, titulo_eleitor=50, zona_eleitoral=50,
    secao_eleitoral=50, ctps_numero=50, ctps_serie=50, pis=50, banco_nome=100, banco_agencia=50,
    banco_conta=50,
)
TEXT_LIMITS = {
    "dim_colaboradores_base": _BASE_TEXT,
    "dim_colaboradores": _RICH_TEXT,
    "fato_folha_consolidada": _CONSOL_TEXT,
    "fato_folha_detalhada": _DETAIL_TEXT,
    "fato_beneficios_api": _BENEFIT_TEXT,
}
