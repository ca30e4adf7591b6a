"""Quality, language, rules, mixing and the text helper against brute force and held-out rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, perplexity, quality, queries, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def test_words_and_hashes_of_whole_texts():
    rng = random.Random(1)
    texts = [None, "", " ", "a", "a b", " a\x0b\tb\r\n", "é漢 😀", "\x1c a\x85b"] + ["".join(rng.choices("ab é\n\t", k=rng.randint(0, 300))) for _ in range(200)]
    texts += ["z" * 200_000 + " " + "y " * 90_000]
    seen, runs, k = {}, {}, 3
    for t in text.slices(pa.array(texts), 500):
        h, grams = text.word_hashes(t), text.run_hashes(text.word_hashes(t), k)
        whole = set(text.run_starts(t, k).tolist())
        for i in range(t.n):
            own = WORD.findall(texts[t.first + i] or "")
            assert [t.word(j).decode() for j in range(t.words[i], t.words[i + 1])] == own
            assert t.joined(i) == " ".join(own)
            for j, w in enumerate(own):
                assert seen.setdefault(w, h[t.words[i] + j]) == h[t.words[i] + j]
                at = t.words[i] + j
                assert (at in whole) == (j + k <= len(own))
                if at in whole:
                    assert runs.setdefault(tuple(own[j:j + k]), grams[at]) == grams[at]
    assert len(set(map(int, seen.values()))) == len(seen) and len(set(map(int, runs.values()))) == len(runs)
    x = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for width in range(1, 8):
        assert text.sliding(np.minimum, x, width).tolist() == [min(x[i:i + width]) for i in range(len(x) - width + 1)]


def held(i, folds, left):
    return i is not None and zlib.crc32(str(i).encode()) % folds == left


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = [r for r in got.values() if r.held_out and r.doc_id in truth]
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out) and len(out) > 50
    assert {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()} == {i for i, r in got.items() if r.predicted}


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(5), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda y: sorted((r.doc_id, r.score) for r in quality.classify(docs, y).collect())
    assert score(labels) == score(turned)


def test_quality_of_odd_rows(spark, docs, no_docs, small_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (3, 0), (4, 1), (6, 0), (7, 1), (8, None), (None, 1), (9, 7), (0, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(small_docs) and all(0 <= r.score <= 1 for r in got)
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((r[0], held(r[0], 5, 0)) for r in small_docs)
    assert {r.predicted for r in quality.classify(docs, labels.where("quality = 1")).collect()} == {1}
    assert {r.score for r in quality.classify(docs, labels.where("doc_id < 0")).collect()} == {0.5}
    assert quality.classify(no_docs, labels).count() == 0


def test_discriminant_scores_are_ratios_of_gaussian_densities():
    rng = np.random.default_rng(3)
    d = len(quality.FEATURES)
    x0, x1 = rng.standard_normal((400, d)) * 2 + 1, rng.standard_normal((900, d))
    m0, m1, c0, c1 = x0.mean(0), x1.mean(0), np.cov(x0.T), np.cov(x1.T)
    factors = tuple(np.linalg.inv(np.linalg.cholesky(c)) for c in (c0, c1))
    offset = math.log(900 / 400) + (np.linalg.slogdet(c0)[1] - np.linalg.slogdet(c1)[1]) / 2
    model = quality.Discriminant(np.zeros(d), np.ones(d), (m0, m1), factors, offset)
    x = rng.standard_normal((20, d))
    dens = lambda m, c: -0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1]
    want = dens(m1, c1) - dens(m0, c0) + math.log(900 / 400)
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-want)))


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got) and len(got) == len(truth)
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.col("lang"))).withColumn("source", F.lit("x"))
    key = lambda rows: sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in rows)
    assert key(language.identify(hidden).collect()) == key(got)


def test_languages_of_odd_rows(docs, no_docs, small_docs):
    got = language.identify(docs).collect()
    assert len(got) == len(small_docs)
    wordless = {r[0] for r in small_docs if not any(c.isalpha() for c in r[1] or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == wordless
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and {r.lang_pred for r in got} <= {"und", "en", "fr"}
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(no_docs).count() == 0


def _skewed(spark):
    """1,500 rows of one language, 300 of a second, 12 of a third; one row 400 times over, one text of a megabyte."""
    rng, letters = random.Random(7), {"aa": "etaoinsh", "bb": "rdlucmfw", "cc": "ypvbgkqj"}
    word = lambda lang: "".join(rng.choices(letters[lang], k=rng.randint(2, 7)))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang)
            for i, lang in enumerate(["aa"] * 1500 + ["bb"] * 300 + ["cc"] * 12)]
    rows += [rows[0]] * 400 + [(5000, " ".join(word("bb") for _ in range(200_000)), "bb")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), {r[0]: r[2] for r in rows}


def test_rare_languages_and_repeated_rows_teach(spark):
    docs, truth = _skewed(spark)
    got = language.identify(docs).collect()
    assert len(got) == docs.count()
    wrong = [r for r in got if r.lang_pred != truth[r.doc_id]]
    assert not wrong
    drawn = language.drawn_texts(docs, 40).collect()
    assert Counter(r.lang for r in drawn) == {"aa": 40, "bb": 40, "cc": 12}
    assert len({(r.lang, r.n) for r in drawn}) == len(drawn)


def test_only_drawn_texts_are_moved_by_the_fit(spark):
    docs, _ = _skewed(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = language.drawn_texts(docs, 40)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    ids = plan[plan.index("BroadcastExchange"):]
    assert "text#" not in ids[:ids.index("Scan")] and "WindowGroupLimit" in ids


def test_presence_kernel_matches_sets():
    texts = ["Abc abd", "xyz", "", "abc"]
    rows = np.concatenate([x for t in text.slices(pa.array(texts)) for _, x in language.presence(t)])
    grams = lambda t: {t.lower().encode()[i:i + n] for n in range(1, 5) for i in range(len(t) - n + 1)}
    for i, j in itertools.product(range(4), repeat=2):
        assert (rows[i] & rows[j]).sum() == len(grams(texts[i]) & grams(texts[j]))


def brute_rules(t):
    w = WORD.findall(t or "")
    count, covered = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), dup, len(covered)


def test_rules_match_brute_force():
    rng = random.Random(6)
    texts = [None, "", "\n\n", "\na b\n a b\na b", "a\r\na\r\nb|c#\n"] + [
        "".join(rng.choice(["one", "two", "é", "<b>"]) + rng.choice([" ", " ", "\n", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts.append("x y z " * 4000 + "\n")
    for t in text.slices(pa.array(texts), 300):
        r = perplexity.rules(t)
        for k in range(t.n):
            assert tuple(int(r[c][k]) for c in perplexity._COUNTS) == brute_rules(texts[t.first + k]), texts[t.first + k]


def test_kneser_ney_sums_to_one_and_matches_its_definition():
    rng = np.random.default_rng(2)
    s = rng.choice(5, size=3000, p=[0.4, 0.3, 0.15, 0.1, 0.05])
    keys = [int("".join(f"{v:06b}" for v in s[i:i + 4]), 2) for i in range(len(s) - 3)]
    grams, counts = np.unique(np.array(keys, np.uint32), return_counts=True)
    model = perplexity.estimate(grams, counts)
    table = Counter(keys)
    tables = [Counter(table)]
    for bits in (18, 12, 6):
        tables.insert(0, Counter(k & ((1 << bits) - 1) for k in (table if len(tables) == 1 else tables[0])) if False else Counter(
            k & ((1 << bits) - 1) for k in tables[0]))

    def p(order, gram):
        t = tables[order - 1]
        d = perplexity._discounts(np.array(list(t.values())))
        own = {g: n for g, n in t.items() if g >> 6 == gram >> 6}
        lower = 2.0**-6 if order == 1 else p(order - 1, gram & ((1 << 6 * (order - 1)) - 1))
        if not own:
            return lower
        total = sum(own.values())
        cut = lambda n: d[min(n, 3) - 1]
        return (max(own.get(gram, 0) - cut(own[gram]), 0) if gram in own else 0) / total + sum(cut(n) for n in own.values()) / total * lower

    for context in [keys[0] >> 6, keys[7] >> 6, 0b000111000111000111]:
        wanted = np.array([context << 6 | last for last in range(64)], np.uint32)
        got = np.exp(perplexity._look(model, wanted))
        assert abs(got.sum() - 1) < 1e-6
        assert np.allclose(got, [p(4, int(g)) for g in wanted], rtol=1e-9)


def test_judged_rows(docs, no_docs, small_docs):
    got = perplexity.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in got) == Counter((r[0], *brute_rules(r[1])) for r in small_docs)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert not any(r.base_failed and r.kept for r in got)
    assert perplexity.judge(no_docs).count() == 0


def test_word_probabilities_match_their_definition(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdef", [9, 7, 4, 2, 1, 1], k=rng.randint(1, 30))) for _ in range(40)] + ["漢字 漢Ab"] * 2
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    keyed = perplexity._keyed(docs).join(docs.select("text", "doc_id"), "text").select("key", "fold", "text").distinct().collect()
    rates = {r.key: r.rate for r in perplexity.log_probabilities(docs).collect()}
    split = lambda t: ["漢", "字", "漢", "ab"] if "漢" in t else t.split()
    fold, grams = {r.text: r.fold for r in keyed}, lambda t: list(zip(["<"] * 2 + split(t), ["<"] + split(t), split(t)))
    vocabulary = len({w for t in texts for w in split(t)})
    for f in range(perplexity.FOLDS):
        tables = [Counter(g for t in texts if fold[t] != f for g in grams(t))]
        for _ in range(2):
            tables.insert(0, Counter(g[1:] for g in tables[0]))

        def p(g):
            if not g:
                return 1 / (vocabulary + 1)
            table = tables[len(g) - 1]
            d = perplexity._discounts(np.array(list(table.values())))
            own = {w: n for w, n in table.items() if w[:-1] == g[:-1]}
            if not own:
                return p(g[1:])
            cut = lambda n: d[min(n, 3) - 1]
            return ((own[g] - cut(own[g]) if g in own else 0) + sum(map(cut, own.values())) * p(g[1:])) / sum(own.values())

        for r in keyed:
            if r.fold == f:
                assert math.isclose(rates[r.key], np.mean([math.log(p(g)) for g in grams(r.text)]), rel_tol=1e-9), r.text


def test_shuffled_words_and_foreign_gibberish_are_rejected(spark):
    rng = random.Random(9)
    cast, rows = [f"{a}{b}a" for a in "bcdfghklmn" for b in "aeiou"], []
    wide = [chr(0x4E00 + k) for k in range(200)]

    def walk(pool, n):  # every word has three that may follow
        at, out = rng.randrange(len(pool)), []
        for _ in range(n):
            out.append(pool[at])
            at = (7 * at + rng.randrange(3) + 1) % len(pool)
        return out

    rows += [(i, " ".join(walk(cast, 200)), "en") for i in range(150)] + [(1000 + i, "".join(walk(wide, 200)) + " x" * 25, "zh") for i in range(150)]
    rows += [(500 + i, " ".join(rng.sample(w := walk(cast, 200), len(w))), "en") for i in range(4)]
    rows += [(1500 + i, "".join(rng.sample(w := walk(wide, 200), len(w))) + " x" * 25, "zh") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    bad = {r.doc_id for r in perplexity.judge(docs, most_repeated=100).collect() if not r.kept}
    assert {i for i, *_ in rows if i % 1000 >= 500} <= bad and len(bad) <= 8 + 15


def targets(sizes, weights, most):
    """By resharing what capped sources leave over until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def test_mix_hits_its_targets(docs, no_docs, small_docs):
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in small_docs:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = targets(sizes, (1, 2, 3), 3)
    assert Counter((r.doc_id, r.source, r.size, r.source_size) for r in got) == Counter((r[0], r[3], len(WORD.findall(r[1] or "")), sizes[r[3]]) for r in small_docs)
    taken = Counter()
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.taken == r.size * r.repeats and 0 <= r.repeats <= 3
        taken[r.source] += r.taken
    for s, t in want.items():
        passes = min(round(t) // sizes[s], round(t))
        reach = 1  # bit r: some documents have r words together
        for r in got:
            if r.source == s:
                reach |= reach << r.size
        left = round(t) - passes * sizes[s]
        assert taken[s] == passes * sizes[s] + (reach & ((2 << left) - 1)).bit_length() - 1
    again = Counter((r.doc_id, r.tkey, r.taken) for r in mixing.mix(docs.repartition(7)).collect())
    assert again == Counter((r.doc_id, r.tkey, r.taken) for r in got)
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    copies = Counter((r.doc_id, r.source, r.text) for r in rows.collect())
    assert sum(copies.values()) == sum(r.repeats for r in got)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_water_level_matches_resharing(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "B", "é", "z", "\U0001f600", "￿"][:rng.randint(1, 8)]
    sizes = {s: rng.choice([0, 1, 5, 50, 1000]) for s in names}
    frame = spark.createDataFrame([(("=" + s) if s is not None else "", s, n) for s, n in sizes.items()], "key string, source string, size long")
    got = {r.key: r.target for r in mixing.source_targets(frame, (1, 2, 3), 1.0, 3).collect()}
    for s, t in targets(sizes, (1, 2, 3), 3).items():
        assert math.isclose(got[("=" + s) if s is not None else ""], t, rel_tol=1e-9, abs_tol=1e-9)


def test_subsets_reach_the_budget():
    rng = np.random.default_rng(8)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, rng.choice([12, 400]), size=rng.integers(1, 12)))
        counts = rng.integers(1, 6, size=len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 3))
        taken = mixing.fit_subset(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all() and (taken * lengths).sum() <= budget
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * n for s in sums for k in range(c + 1)}
        assert (taken * lengths).sum() == max(s for s in sums if s <= budget)
    big = mixing.fit_subset(np.arange(1, 3000), np.full(2999, 1000), 1_234_567_891)
    assert (big * np.arange(1, 3000)).sum() == 1_234_567_891


def test_few_long_documents_reach_large_budgets():
    taken = mixing.fit_subset(np.array([300_000, 400_000, 500_000]), np.ones(3, int), 700_000)
    assert taken.tolist() == [1, 1, 0]
    assert mixing.fit_subset(np.array([3_000_001, 4_000_000, 5_000_000]), np.ones(3, int), 7_000_001).tolist() == [1, 1, 0]
    rng = np.random.default_rng(4)
    lengths = np.unique(rng.integers(200_000, 400_000, size=40))
    budget = int(lengths[rng.permutation(len(lengths))[:15]].sum())
    taken = mixing.fit_subset(lengths, np.ones(len(lengths), int), budget)
    assert (taken * lengths).sum() == budget and taken.max() == 1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_every_row(spark, name):
    table, key = ("embeddings", "vec_id") if name.startswith("op7") else ("documents", "doc_id")
    got = queries.QUERIES[name](spark, FOLDER)
    want = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in want.select(key).collect())


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= first
        first = now
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count()
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()) == Counter(r.doc_id for r in docs.collect())
