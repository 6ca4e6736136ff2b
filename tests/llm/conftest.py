"""Small documents with everything that may go wrong in them."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n))


def rows() -> list[tuple]:
    base = [words(i, 120) for i in range(12)]
    near = base[0].split()
    near[60] = "changed"
    texts = [
        *base,
        base[0],  # an exact copy
        " ".join(near),  # a near copy
        base[1].upper(),  # equal words
        words(50, 30) + " " + base[2] + " " + words(51, 30),
        "",
        "   \n\t",
        None,
        "one two",
        "One  two",
        "... 123 !!!",
        "é" * 300 + " ünïcode \U0001f600 " + words(60, 20),
        words(70, 4000),
        "x" * 3000,
    ]
    out = [(i, t, "en" if i % 2 else "de", ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    out += [out[3], out[3]]  # rows that repeat
    out += [(None, base[4], None, "b", 0), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def doc_rows() -> list[tuple]:
    return rows()


@pytest.fixture()
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(3)


@pytest.fixture()
def clashing(docs):
    """Extra columns that bear the names of outputs and of inner columns."""
    from pyspark.sql import functions as F

    names = "key cls n size target copies taken tie row spans score held_out id range number term pos u rank bin found".split()
    return docs.select("*", *[F.lit("clash").alias(c) for c in names])


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
