"""The conversation trie against nested dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(sequences):
    nodes = defaultdict(lambda: [[], []])
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])][0].append(c)
        nodes[tuple(turns)][1].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, (members, _) in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = Counter()
    for p, (members, ends) in nodes.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        parent = min(nodes[p[:-1]][0]) if p else None
        out[min(members), len(p), parent, len(members), children[p], leaves[p], saved[p], digest] += 1
    return out


def made(df):
    return Counter(tuple(r) for r in df.collect())


def talk(rng, conversations, longest, words=3):
    rows = []
    for c in conversations:
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "bot"]), f"é{rng.randrange(words)}" * rng.randrange(3)))
    rng.shuffle(rows)
    return rows


def test_rebuilt_trie_equals_dictionaries(spark):
    rng = random.Random(2)
    rows = talk(rng, [*range(40), *range(200, 260, 3), 10**12, 10**12 + 4], 7)
    rows += [(500, None, None, None), (500, None, "user", "z"), (500, 1, "user", "b"), (500, 1, "user", "a"), (500, 1, "user", "a"),
             (501, 0, "user", ""), (501, 0, None, "user"), (None, 0, "user", "x"), (None, None, None, None), (502, 3, "us", "ertext"), (503, 3, "user", "text")]
    rows += [(c, i, "user", "same") for c in range(700, 760) for i in range(12)]  # one hot head and group
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert made(pt.conversation_trie(df)) == brute(rebuilt(rows))


@pytest.mark.parametrize("longest", [2, 9, 150])
def test_depths_beyond_a_span_and_a_conversation_with_most_turns(spark, longest):
    rng = random.Random(longest)
    sequences = {c: [("r", rng.choice("ab")) for _ in range(rng.randrange(longest))] for c in range(30)}
    head = [("r", "h")] * longest
    sequences |= {c: head[:rng.randrange(longest)] for c in range(30, 50)} | {60: head + sequences[3], 61: head + sequences[3], 62: head}
    rows = [(c, i + 1, r, t) for c, turns in sequences.items() for i, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "c long, at long, r string, t string").select(
        "c", "at", pt._token(F.col("r"), F.col("t")).alias("token"), F.octet_length("t").cast("long").alias("bytes"))
    sizes = spark.createDataFrame([(c, len(ts)) for c, ts in sequences.items()], "c long, size long")
    want = brute({c: [(r, t.encode()) for r, t in ts] for c, ts in sequences.items()})
    assert made(pt.prefix_nodes(turns, sizes)) == want


def test_ids_below_zero_divide_towards_zero(spark):
    rows = [(-7, 0, "u", "a"), (-5, 0, "u", "b"), (-3, 0, "u", "c"), (0, 0, "u", "d"), (-3, 1, "u", "e")]
    turns, sizes = pt.rebuilt(pt.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    first = {-7: -5, -5: -5, -3: 0, 0: 0}
    own = {-7: "a", -5: "b", -3: "ce", 0: "d"}
    want = {c: len(own[b][:h]) + len(own[c][h:]) for c, b in first.items() for h in [zlib.crc32(str(c).encode()) % 9]}
    assert {r.c: r.size for r in sizes.collect()} == want
    assert Counter(r.c for r in turns.collect()) == Counter({c: n for c, n in want.items() if n})


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "u", "a"), (None, 0, "u", "a")], SCHEMA).withColumns(
        {c: F.lit(5) for c in ("c", "k", "top", "n", "size", "at", "token", "depth", "t", "r", "x", "z", "member", "mid", "part")})
    assert made(pt.conversation_trie(df)) == brute(rebuilt([(1, 0, "u", "a")]))
    assert pt.conversation_trie(df.where("turn > 5")).count() == 0


def test_member_digests_of_a_large_group(spark):
    ids = [*range(0, 9000), *range(10**7, 10**7 + 300_000, 1000), *range(-50, 0)]
    df = spark.createDataFrame([(i, 4 if i % 2 else 7) for i in ids], "member long, c long").repartition(6)
    got = {r.c: r.ends_sha256 for r in pt.member_digests(df).collect()}
    for c, odd in ((4, 1), (7, 0)):
        assert got[c] == hashlib.sha256(",".join(str(i) for i in sorted(ids) if i % 2 == odd).encode()).hexdigest()


def test_digests_run_on_across_batches():
    table = pa.table({"c": pa.array([1, 1, 2, 2, 3], pa.int64()), "ids": ["1,2", "9", "3", "4", "5"]})
    out = {r["c"]: r["ends_sha256"] for b in pt._hashed(iter(table.to_batches(max_chunksize=1))) for r in b.to_pylist()}
    assert out == {c: hashlib.sha256(s.encode()).hexdigest() for c, s in ((1, "1,2,9"), (2, "3,4"), (3, "5"))}
