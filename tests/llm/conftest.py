import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, pos int, words string, n long, class string, score string, block string")
SF = "/root/testdata/sf0.001"


def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, all with extra columns."""
    rng = random.Random(3)
    prose = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the", "été", "groß"]) for _ in range(120))
    texts = [
        prose, prose, prose.replace("alpha", "omega", 1), "", None, " ", "\n\n", "\t", "word", "two words",
        "Ünï çödé ☃ 日本語 text", "a  b   c \n d\n\n  e ", "don't 'TIS it's 12345 <|endoftext|> x", "#" * 300,
        "long " * 4000, "x" * 5000, "!!! ??? 123 456", "All rights reserved. Licensed under CC BY 4.0",
        "same line of words that is at least eight words long\nother", "same line of words that is at least nine words long",
        "\n".join(["one two three four five six seven eight nine"] * 3), "nul\x00 and sep\x1c in it",
    ]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[9], (50, None, None, None, None), (None, "no id here at all", "en", "s1", 17),
             (51, prose, None, None, 3), (7, "another text with the same id", "de", "s0", 29)]
    return [(*r, "k", 1, "w", 2, "c", "s", "b") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
