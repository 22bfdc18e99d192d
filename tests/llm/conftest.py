import random

import pytest
from samples import prose

@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and very long texts, copies, repeated rows and clashing columns."""
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    texts += [None, "", " ", "\n\t\r\x0b\x0c ", "one", "a b c d", "A B C D", "x" * 30_000, prose(rng, 20_000)]
    texts += ["<|endoftext|> in <|startoftext|>text", "a  b   c \n\n d \t e\x00f\x1cg", "ΣΑΣ İstanbul ǅ ﬁ e\u0301 \u200b\u3000\xa0x", "  lead trail  ", "▁ ▁▁ <s> </s> <0x0A>"]
    texts += [texts[0]] * 3 + [texts[1].upper(), texts[2] + " tail"]
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, 1, "x", 2.0) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[3], None, "src1", None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n long, h string, component double"
    )


@pytest.fixture(scope="session")
def none(messy):
    return messy.limit(0)
