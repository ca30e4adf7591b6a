"""Distances between sources against whole numbers in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def f(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, min_docs, top):
    """``rows``: text, lang, source."""
    n, docs, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall(lowered(text or ""))
        for t in found:
            n[lang, source, t] += 1
        docs.update((lang, t) for t in set(found))
    out = Counter()
    for lang, sources in groups.items():
        kept = [t for (g, t), k in docs.items() if g == lang and k >= min_docs]
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        every = {t: sum(n[lang, s, t] for s in sources) for t in kept}
        share = lambda c, of: 1 + 1000000000 * (c + 2) // (of + 2 * len(kept))
        p = {(s, t): share(n[lang, s, t], total[s]) for s in sources for t in kept}
        q = {t: share(every[t], sum(every.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum(f(p[s, t], p[o, t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s, t], q[t])) for t in kept if n[lang, s, t] and p[s, t] > q[t]]
            for part, items, upto in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:upto], 1):
                    out[lang, s, part, item, value, rank] += 1
    return out


def made(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, rows=300):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "tHE", "été", "Été", "漢字", "a", "b1c", "x-y", "İ", "😀"] + [f"w{chr(97 + i % 26)}{'z' * (i // 26)}" for i in range(120)]
    out = []
    for _ in range(rows):
        source = rng.choice(["hot"] * 6 + ["a", "B", "é", "", None, "z9"])
        lang = rng.choice(["en"] * 4 + ["fr", "", None])
        text = rng.choice([None, "", "  \n", "12 34"]) if rng.random() < 0.1 else " \t.,"[rng.randrange(4)].join(
            vocabulary[min(int(rng.expovariate(0.05)), len(vocabulary) - 1)] for _ in range(rng.choice([1, 5, 60])))
        out.append((text, lang, source))
    return out + [("only here", "xx", "lonely"), (None, "yy", None), ("", "yy", "s"), ("long " * 5000 + "end", "en", "a")]


@pytest.mark.parametrize("seed, min_docs", [(1, 10), (2, 1), (3, 40)])
def test_equals_plain_python(spark, seed, min_docs):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert made(dv.audit(df, min_docs, 4)) == brute(rows, min_docs, 4)


def test_documents_with_odd_rows_and_clashing_columns(spark, docs, small_docs):
    odd = docs.withColumns({c: F.lit(1) for c in ("term", "zero", "at", "total", "held", "peers", "value", "rank", "item", "part", "lang_n")})
    assert made(dv.audit(odd, 3)) == brute([(r[1], r[2], r[3]) for r in small_docs], 3, 10)


def test_empty_table(spark, no_docs):
    assert dv.audit(no_docs).count() == 0


def batches(rows, size, names):
    table = pa.Table.from_pylist(rows, schema=names)
    return iter(table.to_batches(max_chunksize=size))


def test_counts_do_not_depend_on_when_they_are_passed_on(monkeypatch):
    rows = [{"lang": a or "", "source": s or "", "text": (t or "").encode()} for t, a, s in corpus(4)]
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("text", pa.binary())])

    def total():
        out = Counter()
        for b in dv._counted(batches(rows, 17, schema)):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return out

    whole = total()
    monkeypatch.setattr(dv, "_TERMS", 5)
    monkeypatch.setattr(dv, "_PIECE", 64)
    assert total() == whole


def test_accumulators_do_not_depend_on_when_they_are_passed_on(monkeypatch):
    rng = random.Random(9)
    rows = [{"lang": rng.choice("ab"), "peers": [{"at": g, "p": rng.randrange(1, 10**9), "zero": 1 + g} for g in rng.sample(range(12), rng.randrange(1, 9))]}
            for _ in range(200)]
    schema = pa.schema([("lang", pa.string()), ("peers", pa.list_(pa.struct([("at", pa.int32()), ("p", pa.int64()), ("zero", pa.int64())])))])
    want = Counter()
    for r in rows:
        for x in r["peers"]:
            for y in r["peers"]:
                want[r["lang"], x["at"], y["at"]] += f(x["p"], y["p"]) - f(x["p"], y["zero"]) - f(x["zero"], y["p"]) + f(x["zero"], y["zero"])
    want = {k: v for k, v in want.items() if v}

    def total(size):
        out = Counter()
        for b in dv._accumulated(batches(rows, size, schema)):
            for r in b.to_pylist():
                out[r["lang"], r["at"], r["peer"]] += r["value"]
        return {k: v for k, v in out.items() if v}

    assert total(50) == want
    monkeypatch.setattr(dv, "_POSTINGS", 3)
    monkeypatch.setattr(dv, "_CELLS", 20)
    assert total(7) == want


def test_shares_are_exact_beyond_doubles(spark):
    rows = [(7, 10**15 + 3, 12345), (10**15, 10**15 + 3, 1), (0, 1, 1), (5, 9, 10**6)]
    df = spark.createDataFrame(rows, "n long, total long, kept long")
    got = [r[0] for r in df.select(dv.share(F.col("n"), F.col("total"), F.col("kept"))).collect()]
    assert got == [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in rows]


def test_posting_pairs_are_not_rows(spark, docs):
    plan = dv.audit(docs, 3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
