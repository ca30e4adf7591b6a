"""Token counts, token files and pieces against the libraries on whole texts."""

import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import pieces, text, token_counts, token_files
from tidemark.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "  a  b\n\n c\t", "don't, won't. I'LL", "中文字符梦想 日本語テキスト😀🚀 ½²x_9", "x" * 300 + " " + "ab" * 200, "▁ a▁b", "<0x0A> <s> </s>",
       "Straße—naïve “quotes”… 12,345.67 a.b.c İ ΣΑΣ", "\x0b\x0c\x1c\x85 　z", "á é́", "abc.,", "<|endoftext|> x", "\r\n"]


def in_ascending_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_token_files_match_the_library(spark, docs, small_docs, no_docs):
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    rows = small_docs + [(300 + i, t, None, None, None) for i, t in enumerate(ODD)]
    more = spark.createDataFrame([r[:2] for r in rows[len(small_docs):]], "doc_id long, text string").select("*", F.lit(1).alias("size"))
    manifest = token_files.write_token_files(docs.select("doc_id", "text", "size").unionByName(more), scratch_path(spark, "t"), WORDS, end_id=1)
    got = token_files.read_documents(spark, manifest).collect()
    assert sum(r.n_tokens for r in manifest.collect()) == sum(r.n_tokens for r in got)
    want, start = [], 0
    for r in in_ascending_order(rows):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), tuple(ids)))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, tuple(r.ids)) for r in got), key=lambda r: r[1]) == want
    sums = token_files.fold_documents(spark, manifest, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "crc", "long")
    assert Counter(r.crc for r in sums.collect()) == Counter(zlib.crc32(np.array(w[3], "<u4").tobytes()) for w in want)
    assert token_files.read_documents(spark, token_files.write_token_files(no_docs, scratch_path(spark, "t"), WORDS, 1)).count() == 0


def test_small_tables_forget_and_still_encode():
    library = Tokenizer.from_file(WORDS)
    encoder = token_files.WordEncoder(open(WORDS, encoding="utf-8").read(), slots=16, pool=64)
    rng = random.Random(2)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcdeé.,'", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 60))) for _ in range(9)]
        for t in text.slices(pa.array(texts), 200):
            ids, counts = encoder.encode(t)
            want = [library.encode(x, add_special_tokens=False).ids for x in texts[t.first:t.first + t.n]]
            assert ids.tolist() == [i for w in want for i in w]
            assert counts.tolist() == [len(w) for w in want]


@pytest.fixture(scope="module")
def counter():
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(path, "rb") as f:
        return token_counts.Counter(f.read(), public_tokenizers.PATTERN), lambda t: len(whole.encode_ordinary(t))


def test_edits_count_as_the_whole_edited_text(counter):
    count, whole = counter
    rng = random.Random(1)
    blanks = [" ", " ", " ", "  ", "\n", "\t\n", "  "]
    for _ in range(400):
        base = "".join(rng.choice(["word", "it's", "12", "...", "é", "漢字"]) + rng.choice(blanks) for _ in range(rng.choice([0, 3, 200, 500])))
        tree = token_counts.grow(token_counts.leaves(base), count)
        assert (tree[1][1], tree[2][1]) == (len(base), whole(base))
        edits = [{"start": rng.randint(-1, len(base) + 2), "length": rng.choice([0, 1, 3, 700, None]), "replacement": rng.choice(["", " ", "  x", "word", "\n\n", None])}
                 for _ in range(rng.randint(0, 4))]
        new, (_, lengths, counts), _, again = token_counts.apply_edits(base, tree, edits, count)
        want, end, todo = base, 0, []
        for e in sorted(edits, key=lambda e: (e["start"], e["length"] or 0)):
            low = min(max(e["start"], 0), len(base))
            high = min(low + (e["length"] or 0), len(base))
            if low >= end:
                todo.append((low, high, e["replacement"] or ""))
                end = high
        for low, high, word in reversed(todo):
            want = want[:low] + word + want[high:]
        assert new == want and lengths[1] == len(want) and counts[1] == whole(want)
        for i in range(1, len(lengths) // 2):
            assert lengths[i] == lengths[2 * i] + lengths[2 * i + 1] and counts[i] == counts[2 * i] + counts[2 * i + 1]


def test_only_touched_leaves_are_encoded_again(counter):
    count, _ = counter
    base = "some words " * 5000
    calls = []
    tree = token_counts.grow(token_counts.leaves(base), count)
    _, _, _, again = token_counts.apply_edits(base, tree, [{"start": 30000, "length": 4, "replacement": "other"}], lambda t: calls.append(t) or count(t))
    assert again < 3 * token_counts.LEAF and sum(map(len, calls)) == again


def test_recount_of_a_table(spark, docs, small_docs, no_docs, counter):
    import re

    _, whole = counter
    shared = token_counts.load_counter(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rules = [(r"w1\d*", "<one>"), (r"\bgo\b", "")]
    got = Counter((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after) for r in token_counts.recount(docs, token_counts.replacements(rules), shared).collect())
    find, put = re.compile(r"(w1\d*)|(\bgo\b)"), ["<one>", ""]
    want = Counter((r[0], whole(r[1] or ""), len(find.findall(r[1] or "")), whole(find.sub(lambda m: put[m.lastindex - 1], r[1] or ""))) for r in small_docs)
    assert got == want
    assert token_counts.recount(no_docs, token_counts.replacements(rules), shared).count() == 0


@pytest.fixture(scope="module")
def vocab():
    return pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_match_the_library(spark, docs, small_docs, no_docs, vocab):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(r[0], r[1]) for r in small_docs if len(r[1] or "") < 20_000] + [(300 + i, t) for i, t in enumerate(ODD)]
    frame = docs.where("text is null or length(text) < 20000").select("doc_id", "text", "unit", "ids").unionByName(
        spark.createDataFrame([(i, t, 1, 1) for i, t in rows if i is not None and i >= 300], "doc_id long, text string, unit int, ids int"))
    coded = pieces.encode(frame, vocab, frequent=50)
    got = coded.select("*", pieces.decode("ids", vocab).alias("back")).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.back) for r in got) == Counter(
        (i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows)
    assert pieces.encode(no_docs, vocab).count() == 0


def test_units_are_cut_and_shuffled_once(spark, vocab):
    counts = pieces.unit_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), vocab)
    plan = pieces.encode_units(counts, vocab)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_counted_units_leave_in_small_batches():
    batches = list(pieces._counted(Counter({f"u{i}": i + 1 for i in range(40_000)})))
    assert max(b.num_rows for b in batches) <= 1 << 14
    assert {u: n for b in batches for u, n in zip(*(c.to_pylist() for c in b.columns))} == {f"u{i}": i + 1 for i in range(40_000)}


def test_decoding_skips_what_is_no_id(spark, vocab):
    frame = spark.createDataFrame([([413, None, 99999, 413],), ([],), (None,)], "ids array<int>")
    got = [r[0] for r in frame.select(pieces.decode("ids", vocab)).collect()]
    one = bytes.fromhex(vocab.texts[413]).decode()
    assert got[0] == (one * 2).removeprefix(" ") and got[1] == ""


def best_path(unit, scores, worst):
    best = [(0.0, [])] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(end):
            s = scores.get(unit[start:end], worst if end == start + 1 else None)
            if s is not None and best[start] and (best[end] is None or best[start][0] + s > best[end][0]):
                best[end] = (best[start][0] + s, best[start][1] + [unit[start:end]])
    return best[-1][1]


def test_viterbi_fold_finds_the_best_path(spark):
    rng = random.Random(4)
    scores = {"".join(p): -rng.random() * len(p) * 1.1 - 0.5 for p in ["a", "b", "ab", "ba", "aa", "aba", "bab", "abab", "▁", "▁a", "▁ab", "bb"]}
    table = [(p, i + 10, s) for i, (p, s) in enumerate(scores.items())]
    toy = pieces.vocabulary(table, [""] * 10 + [p.replace("▁", " ").encode().hex() for p in scores], [0] * 256)
    units = ["".join(rng.choices("aab", k=rng.randint(1, 12))) for _ in range(60)] + ["▁abc", "c"]
    got = {r.unit: r.ids for r in pieces.encode_units(spark.createDataFrame([(u,) for u in set(units)], "unit string"), toy, "unigram").collect()}
    ids = {p: i for p, i, _ in table}
    for u in units:
        assert got[u] == [ids.get(p, 0) for p in best_path(u, scores, min(scores.values()) - 10)]


def test_vocabularies_that_cross_words_are_refused():
    with pytest.raises(ValueError):
        pieces.vocabulary([("a▁b", 1, 0.0)], ["", ""], [0] * 256)
    assert pieces.vocabulary([("a1", 1, 0.0)], ["", ""], [0] * 256).units == pieces._WHOLE
    assert json.dumps(pieces.vocabulary([("ab", 1, 0.0)], ["", ""], [0] * 256).units)
