"""A small table with every awkward case, and an empty one."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, start long, ids string, key long, "
    "n long, g long, home long, label long, size long, row string, m string, part int, data string"
)
EXTRA = (1, "x", 2, 3, 4, 5, 6, 7, "r", "m", 8, "d")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeioulmnrst") for _ in range(rng.randint(1, 7))) for _ in range(n))


def cases():
    rng = random.Random(5)
    long = sentence(rng, 400)
    passage = sentence(rng, 60)
    words = long.split(" ")
    texts = [
        None, None, "", "   ", "one", "one two", "one two three", "a\n\nb\t c", long, long, long.upper(),
        " ".join(words[:200] + ["edit"] + words[201:]), " ".join(words[:350]), passage, "x " + passage, passage + " y",
        "la " * 300, "é" * 250 + " ü" * 30, "0" * 500, "<|endoftext|> two  spaces \n and\r\nlines", "🙂" * 120,
        "write to a.b+c@mail.example.com or +1 (017) 555-7713, card 4111 1111 1111 1111, host 10.0.0.255.1 and 1.2.3.256",
        "4026083977531332 4026083977531333", "same line here\n" * 30, "### *** $$$ " * 40, sentence(rng, 3000),
    ] + [sentence(rng, rng.randint(5, 120)) + " " + rng.choice([passage, "", long]) for _ in range(24)]
    sources = ["b", "a", None, "c", "Z"]
    rows = [(k, t, "en", sources[k % 5], None if t is None else len(t)) for k, t in enumerate(texts)]
    return rows + [rows[8], rows[13], (None, passage, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """The cases as a table read from files, with extra columns whose names the operators use."""
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame([r + EXTRA for r in cases()], SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
