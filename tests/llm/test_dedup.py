"""Near-duplicates, repeated passages and embeddings against brute force."""

import hashlib
import inspect
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash, neighbours, substring
from tidemark.llm.graph import components
from tidemark.session import scratch_mark, scratch_since, settled

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def labels(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = labels({n for p in pairs for n in p}, pairs)
    assert got == {n: c for n, c in want.items() if n != 300}  # a node linked to itself only is no component
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates_match_all_pairs(spark, docs, small_docs):
    sets = {k: shingles(t) for k, t in {(r[1] or "") for r in small_docs} and {r[1] or "": r[1] for r in small_docs}.items()}
    df = Counter(s for r in small_docs for s in shingles(r[1]))
    n = len(small_docs)
    weight = lambda s: 1 + math.log((1 + n) / (1 + df[s])) / math.log(1 + n)
    texts, pairs = [t for t in sets if sets[t]], []
    for i, a in enumerate(texts):
        for b in texts[:i]:
            keys = sets[a].keys() | sets[b].keys()
            least = sum(weight(k) * min(sets[a][k], sets[b][k]) for k in keys)
            if least / sum(weight(k) * max(sets[a][k], sets[b][k]) for k in keys) >= 0.8:
                pairs.append((a, b))
    group = labels(texts, pairs)
    least = {}
    for r in small_docs:
        if r[1] in group and r[0] is not None:
            least[group[r[1]]] = min(least.get(group[r[1]], r[0]), r[0])
    want = Counter((r[0], least.get(group[r[1]]) if r[1] in group else r[0]) for r in small_docs)
    got = Counter((r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).collect())
    assert got == want
    assert len(pairs) > 10


def test_one_of_each_class_stays(docs, no_docs):
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    classes = {(r.doc_id, r.class_id, r.component) for r in minhash.near_duplicates(docs).collect()}
    with_words = [r for r in rows if words(r[1])]
    assert len(with_words) == len({c for _, _, c in classes if c is not None})
    assert len([r for r in rows if not words(r[1])]) == 4  # all that have no word
    assert sorted(i for i, t in with_words if t and t.startswith("go ")) == [205]
    assert minhash.keep_one(no_docs).count() == 0


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    weights = rng.uniform(1, 2, minhash.FEATURES).astype(np.float32)
    sampler = minhash.Sampler(weights, 100, 4, 2)
    pool = np.sort(rng.integers(1 << 62, size=900).astype(np.uint64))
    a, b = pool[:700], pool[150:]
    s = sampler.samples(np.concatenate([a, b]), np.array([0, len(a)]))
    weigh = lambda x: weights[(x & np.uint64(minhash.FEATURES - 1)).astype(int)].sum()
    alike = weigh(np.intersect1d(a, b)) / weigh(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - alike) < 4 * math.sqrt(alike * (1 - alike) / s.shape[1])


def test_pairs_of_a_bucket_link_whatever_their_samples(spark):
    weigh = lambda ids: np.sort(np.array(ids, np.int64) << minhash._BITS | minhash._UNIT)
    # in one bucket, all in components of their own: a and b are 0.8 alike, c is less alike to both
    sets = {b"a": range(1, 91), b"b": range(11, 101), b"c": range(31, 121)}
    rows = [(1, 0, k, k) for k in sets]
    labelled = spark.createDataFrame(rows, "bucket long, band int, node binary, component binary")
    vectors = spark.createDataFrame([(k, weigh(v).tolist()) for k, v in sets.items()], "node binary, vector array<long>")
    for threshold, want in ((0.8, {(b"a", b"b")}), (0.81, set())):
        got = minhash._across(labelled, vectors, threshold).collect()
        assert {(bytes(r.a), bytes(r.b)) for r in got} == want
    assert inspect.signature(minhash.near_duplicates).parameters["bands"].default == 20


def brute_removal(rows, window):
    first = {}
    key = lambda r: math.inf if r[0] is None else r[0]
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, math.inf), key(r))
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(r):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        yield r[0], len(w), sum(gone), kept


@pytest.mark.parametrize("window", [50, 7])
def test_removed_words_match_brute_force(docs, small_docs, window):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs, window).select(
        "doc_id", "n_words", "n_removed", "kept").collect())
    want = Counter(brute_removal(small_docs, window))
    assert got == want
    assert sum(k[2] for k in want) > 1000


def test_periodic_and_shifted_passages(spark):
    w = [f"t{i}" for i in range(200)]
    rows = [(5, " ".join(w[:120])), (2, " ".join(w[40:100])), (9, "q " * 60 + " ".join(w[30:150])), (1, "go " * 80), (7, "stop " + "go " * 200),
            (8, " ".join(w[60:115] * 2)), (3, " ".join(w[50:112])), (4, "go " * 49)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(frame).select("doc_id", "n_words", "n_removed", "kept").collect())
    assert got == Counter(brute_removal([(i, t) for i, t in rows], 50))


def test_texts_keep_their_form_where_nothing_is_removed(docs, no_docs, small_docs):
    done = substring.remove_repeats(docs, as_words=False)
    assert set(docs.columns) - {"kept", "n_words"} <= set(done.columns)
    for r in done.where("n_removed = 0").select("text", "kept").collect():
        assert r.kept == (r.text or "")
    assert substring.remove_repeats(no_docs).count() == 0


def vectors(rng, n=300):
    rows = []
    for i in range(n):
        v = rng.standard_normal(16)
        if i % 3 == 0 and rows:
            v = np.array(rows[rng.integers(max(0, len(rows) - 5), len(rows))][1]) + 0.12 * rng.standard_normal(16)
        rows.append((i, [float(x) for x in v], int(i % 2)))
    centre = rng.standard_normal(16)
    rows += [(n + i, [float(x) for x in centre + 0.05 * rng.standard_normal(16)], 0) for i in range(90)]
    rows += [(1000, [0.0] * 16, 0), (1001, None, 0), (1002, [1.0] * 16, None), (1003, [float("nan")] * 16, 1), (1004, [None] + [1.0] * 15, 1),
             (1005, [1.0] * 16, 1), (1006, [2.0] * 16, 1), (1006, [2.0] * 16, 1), (1007, [1.0] * 4, 1), (1008, [float("inf")] + [1.0] * 15, 1),
             (1009, [1e300] * 16, 1), (1010, [1e-300] * 16, 0), (1011, [], 0)]
    return rows


def test_links_match_all_pairs(spark):
    rows = vectors(np.random.default_rng(5))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.link_vectors(frame).collect())
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    unit = {k: np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in good}
    pairs = [(a, b) for i, a in enumerate(good) for b in good[:i] if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
             and unit[a] @ unit[b] / math.sqrt((unit[a] @ unit[a]) * (unit[b] @ unit[b])) >= 0.98]
    links = Counter(k for p in pairs for k in p)
    group = labels(range(len(rows)), pairs)
    least = {}
    for k, g in group.items():
        least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    want = Counter((r[0], links[k], least[group[k]], r[0] == least[group[k]]) for k, r in enumerate(rows))
    assert got == want
    assert neighbours.link_vectors(frame.where("vec_id < 0")).count() == 0


def test_dense_groups_beside_each_other_are_one_component(spark):
    rng = np.random.default_rng(3)
    left, right = np.zeros(32), np.zeros(32)
    left[0], right[:2] = 1, (0.987, math.sqrt(1 - 0.987**2))
    rows = [(i, [float(x) for x in (left if i < 80 else right) + 0.002 * rng.standard_normal(32)], 0) for i in range(160)]
    rows += [(i, [float(x) for x in rng.standard_normal(32)], 0) for i in range(200, 1200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    x = np.array([v for _, v, _ in rows])
    x /= np.sqrt((x * x).sum(1))[:, None]
    want = (x @ x.T >= 0.98).sum(1) - 1
    got = {r.vec_id: r for r in neighbours.link_vectors(frame).collect()}
    assert want[:160].min() >= 100
    assert [got[i].n_links for i, *_ in rows] == want.tolist()
    assert {got[i].component_id for i in range(160)} == {0}


def test_links_that_stay_too_few_are_an_error(spark, monkeypatch):
    rows = [(i, [1.0, 0.001 * i], 0) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(neighbours, "_ATTEMPTS", 1, raising=False)
    monkeypatch.setattr(neighbours, "audit", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="0.5000"):
        neighbours.link_vectors(frame)


def test_rounds_of_components_are_deleted(spark, docs):
    """Of all the tables written on the way, only the one that the result reads is left."""
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    mark = scratch_mark()
    assert {r.component for r in components(pairs).collect()} == {0}
    assert len(scratch_since(mark)) == 1
    mark = scratch_mark()
    assert minhash.near_duplicates(docs).count() == docs.count()
    assert len(scratch_since(mark)) == 1


def test_settled_tables_keep_no_shuffle_files(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    settled(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert tracker.shuffleStatuses().size() <= before
