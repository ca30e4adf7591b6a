import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# columns that some operator makes or uses inside
CLASHING = ("size", "target", "score", "kept", "node", "id", "tkey", "f", "n", "h", "c", "unit", "ids", "n_words", "bands", "rows", "times",
            "component", "passages", "draw", "m", "edits", "tree", "g")


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def small_docs():
    """Rows with copies, near copies, shared passages, nulls, empty and long texts, and repeated rows."""
    rng = random.Random(3)
    rows, passage, long_one = [], prose(rng, 70, 5000), prose(rng, 300, 5000)
    for i in range(60):
        text = prose(rng, rng.choice([3, 40, 120, 260]), 5000)
        if i % 7 == 0:
            text = f"{prose(rng, 30, 5000)}\n{passage}  {prose(rng, 25, 5000)}"
        if i % 9 == 0:
            words = long_one.split(" ")
            words[rng.randrange(len(words))] = f"new{i}"
            text = " ".join(words)
        rows.append((i, text, ("en", "fr", None)[i % 3], ("a", "b", None, "")[i % 4], len(text)))
    rows += [(rows[k][0] + 100, rows[k][1], "en", "a", 1) for k in (0, 3, 9)]
    rows += [(200, None, "en", "a", None), (201, "", None, None, 0), (202, " \n\t ", "fr", "b", 4), (203, "one", "en", "b", 3),
             (None, prose(rng, 80, 5000), "en", "a", 5), (None, None, None, None, None), (204, passage, "en", "a", 7),
             (205, "go " * 3000, "en", "a", 9000), (205, "go " * 3000, "en", "a", 9000), (206, "x" * 70000, "fr", "b", 70000),
             (207, "é ü 漢字   😀 don't stop", "fr", "b", 1), (208, "same words here now ok", "en", "a", 1),
             (209, "same words here now ok", "en", "a", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, small_docs):
    """The rows in several partitions, with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(small_docs, COLUMNS).repartition(3, "text").withColumns({c: F.lit(1) for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("doc_id < -1")
