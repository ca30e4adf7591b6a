"""Exact duplicates against a dictionary."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lowered(text)].append(i)
    out = Counter()
    for text, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        once = False
        for i in ids:
            kept = i == best and not once
            once |= kept
            out[i, best, len(ids), kept, digest] += 1
    return out


def made(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect())


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_groups_equal_a_dictionary_however_many_counters(spark, docs, small_docs, counters):
    assert made(exact.exact_copies(docs, counters)) == brute([(r[0], r[1]) for r in small_docs])


def test_letters_beyond_ascii_keep_their_case(spark):
    rows = [(1, "Éa"), (2, "éA"), (3, "ÉA"), (4, "éa"), (5, "İ"), (6, "i̇"), (7, "K"), (8, "k"), (9, "K")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert made(exact.exact_copies(df)) == brute(rows)


@pytest.mark.parametrize("counters", [4, 64])
def test_hot_groups_are_winners_and_nothing_else_is_lost(spark, counters):
    rng = random.Random(5)
    rows = [(i, "Hot" if rng.random() < 0.4 else "warm" if rng.random() < 0.3 else f"t{rng.randrange(900)}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    numbered = exact._numbered(df)
    won = {bytes(r.digest).hex(): r.group_size for r in exact.winners(numbered, counters).collect()}
    sizes = Counter(hashlib.sha256(lowered(t).encode()).hexdigest() for _, t in rows)
    assert len(won) <= counters
    assert all(won.get(d) == n for d, n in sizes.items() if n > 2 * len(rows) / counters)
    assert all(sizes[d] == n for d, n in won.items())
    assert made(exact.exact_copies(df, counters)) == brute(rows)


def test_summary_bounds_hold_after_merging():
    rng = random.Random(7)
    rows = [min(int(rng.expovariate(0.15)), 60) for _ in range(5000)]
    summary = Counter()
    for at in range(0, len(rows), 250):
        summary = exact.merged(summary, Counter(rows[at:at + 250]), 20)
    true = Counter(rows)
    assert len(summary) <= 20
    assert all(true[k] - len(rows) / 20 <= summary[k] <= true[k] for k in true)


def test_keep_one_returns_whole_rows(spark, docs, small_docs):
    left = exact.keep_one(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert Counter(lowered(r.text) for r in rows) == Counter({t: 1 for t in {lowered(r[1]) for r in small_docs}})
    best = {}
    for r in small_docs:
        key = lowered(r[1])
        best[key] = max(best.get(key, (False, 0)), (r[0] is not None, r[0] or 0))
    assert all((r.doc_id is not None, r.doc_id or 0) == best[lowered(r.text)] for r in rows)


def test_empty_table(spark, no_docs):
    assert exact.exact_copies(no_docs).count() == 0 and exact.keep_one(no_docs).count() == 0


def test_frequent_rows_are_not_shuffled(spark, docs):
    plan = exact.exact_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning(digest") == 1


def test_columns_named_like_its_own(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string").withColumns(
        {c: F.lit(9) for c in ("digest", "row", "top", "group_size", "kept", "keep_id", "n")})
    assert sorted(r.kept for r in exact.exact_copies(df).collect()) == [False, True]
    assert [r.doc_id for r in exact.keep_one(df).collect()] == [2]
