from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    common = ["the", "of", "and", "to", "in", "is"]
    out = [rng.choice(common) if rng.random() < 0.3 else rng.choice(words) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in out)


def edge_texts() -> list[str | None]:
    base = prose(1, 300)
    near = base.split(" ")
    near[150] = "changed"
    return [
        base, None, "", " \n\t ", base, " ".join(near), prose(2, 30_000), prose(3, 60) + base[:700], "x", "one two three", "ÄÖÜ ßtraße émile 😀 " * 30,
        "a" * 5000, prose(4, 200), prose(4, 200).upper(), "*** ### %%% | " * 50, "<|endoftext|> it's  two   spaces and　more\x1c.\x1cend ",
    ]


@pytest.fixture(scope="session")
def texts():
    return edge_texts()


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """Nulls, empty and very long texts, copies, a repeated row, a null id."""
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, prose(9, 80), "en", "a", 5)]
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    extra = ("_row", "row", "words", "_text", "_stats", "quality_rules", "size", "_doc", "_tie", "_cuts", "doc", "tie", "a.b", "_words", "k", "_size")
    return docs.select("*", *(F.lit(i).alias(name) for i, name in enumerate(extra)))
