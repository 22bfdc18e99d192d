"""Texts and row helpers of these tests."""

WORDS = "the of and in to that with for is on as by this from have been anhe tion reou wher stle Ünder côté niño 日本 42 3.14 don't".split()


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n)).replace(" that", ".\nThat")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
