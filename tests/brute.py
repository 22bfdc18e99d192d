"""Plain-Python reading of a payslip text: the slow, obvious answer for small fixtures."""

import re

from payloom.functions import patterns as P


def rx(pattern):
    flags = 0
    if "i" in pattern.flags:
        flags |= re.I
    if "s" in pattern.flags:
        flags |= re.S
    return re.compile(pattern.source, flags)


def first(pattern, text, group=1):
    found = rx(pattern).search(text)
    return found.group(group) if found else None


def either(patterns, text):
    for pattern in patterns:
        value = first(pattern, text)
        if value is not None:
            return value
    return None


def money(text):
    if text is None:
        return None
    plain = text.replace("R$", "").strip().replace(".", "").replace(",", ".")
    try:
        return float(plain) if plain else None
    except ValueError:
        return None


def stripped(text):
    return None if text is None else text.strip()


def one_line(text):
    return None if text is None else text.replace("\n", " ").strip()


def status_of(block):
    labelled = first(P.SITUACAO, block)
    if labelled is not None:
        return rx(P.SITUACAO_CUT).split(labelled, maxsplit=1)[0].strip()
    header = first(P.SITUACAO_HEADER, block)
    return None if header is None else first(P.SITUACAO_END, header)


def name_of(block, status):
    name = one_line(either([P.NOME, P.NOME_FERIAS], block))
    if name is None:
        return None
    if status is not None and name.lower().endswith(status.lower()):
        name = name[: -len(status)].strip()
    return rx(P.NOME_LABEL_END).sub("", name).strip()


def items_of(block):
    start = block.find("CPF:")
    if start < 0:
        start = block.find("Matrícula:")
    ends = [block.find(m) for m in ("\nND:", "Total de Proventos", "Base INSS Férias")]
    end = next((e for e in ends if e >= 0), -1)
    if start < 0 or end < 0:
        return []
    out = []
    for line in block[start:end].split("\n")[1:]:
        regular = list(rx(P.ITEM_HOLERITE).finditer(line))
        vacation = list(rx(P.ITEM_FERIAS).finditer(line))
        for m in vacation if len(vacation) > len(regular) else regular:
            value = money(m.group(3))
            if value:
                out.append((m.group(1), m.group(2), value, m.group(4)))
    return out


def read(text):
    """``[(department, fields, items)]`` in block order."""
    period = either([P.COMPETENCIA, P.COMPETENCIA_GOZO, P.COMPETENCIA_PAGTO], text)
    kind = stripped(first(P.TIPO_CALCULO, text))
    headers = [(m.start(), m.group(1).strip()) for m in rx(P.DEPARTAMENTO).finditer(text)]
    out, at = [], 0
    for block in rx(P.SPLIT).split(text):
        begin, at = at, at + len(block)
        if len(block) < 50 or ("CPF:" not in block and "Matrícula:" not in block):
            continue
        earlier = [name for where, name in headers if where < begin]
        link = first(P.VINCULO, block)
        status = status_of(block)
        fields = {
            "competencia": period,
            "tipo_calculo": kind,
            "departamento": earlier[-1] if earlier else None,
            "vinculo": {"Empr": "Empregado", "Contr": "Contribuinte"}.get(link),
            "situacao": status,
            "data_demissao": either([P.DEMISSAO_MOTIVO, P.DEMISSAO_DATA], block),
            "motivo_demissao": stripped(first(P.DEMISSAO_MOTIVO, block, 2)),
            "nome_funcionario": name_of(block, status),
            "cpf": stripped(first(P.CPF, block)),
            "data_admissao": first(P.ADMISSAO, block),
            "cargo": one_line(either([P.CARGO, P.CARGO_FERIAS], block)),
            "salario_contratual": money(first(P.SALARIO, block)),
            **{name: money(either(both, block)) for name, both in P.TOTALS.items()},
        }
        out.append((fields, items_of(block)))
    return out
