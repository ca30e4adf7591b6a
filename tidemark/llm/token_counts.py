"""Token counts that follow edits.

A text is cut into leaves of about ``LEAF`` characters, each before a blank, line break or tab that follows a character
other than white space. No pre-token of a byte-level BPE pattern reaches across such a place, so leaves can be encoded
one by one and their counts add up. Per document two segment trees are kept over the leaves, of lengths and of token
counts, as arrays: node 1 is the whole text, node i has the children 2i and 2i + 1.

An edit re-encodes only the leaves that it touches, and a neighbour where its end is no place to cut any more; the sums on
the way to the root follow. Edits of one text are given by places in the text before any of them.

Nulls: a null text is an empty one (no tokens, one empty leaf); a null list of edits is an empty one. An edit that reaches
outside the text is cut to it; one that overlaps an earlier one (by place) is left out and not counted; null places or
lengths are 0, a null replacement is an empty one. Rows with equal id and text share a tree. An empty table stays empty.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import settled

LEAF = 512
TREE = "struct<leaves: int, lengths: array<int>, counts: array<int>>"
EDITS = "array<struct<start: int, length: int, replacement: string>>"
_CUT = re.compile(r"(?<=\S)[ \n\t]")


class Counter:
    """Counts the tokens of a leaf with a tiktoken vocabulary; made once in each Python worker."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern, self.encoding = ranks, pattern, None

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "encoding": None}

    def __call__(self, text: str) -> int:
        if self.encoding is None:
            import tiktoken

            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, self.ranks.splitlines())}
            self.encoding = tiktoken.Encoding("counter", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return len(self.encoding.encode_ordinary(text)) if text else 0


def leaves(text: str) -> list[str]:
    out, at = [], 0
    while True:
        m = _CUT.search(text, at + LEAF)
        if m is None:
            return [*out, text[at:]]
        out.append(text[at:m.start()])
        at = m.start()


def grow(parts: list[str], count) -> tuple[int, list[int], list[int]]:
    """The trees of the leaves: their number, lengths and counts."""
    size = 1
    while size < len(parts):
        size *= 2
    lengths, counts = [0] * (2 * size), [0] * (2 * size)
    for i, p in enumerate(parts):
        lengths[size + i], counts[size + i] = len(p), count(p)
    for i in range(size - 1, 0, -1):
        lengths[i], counts[i] = lengths[2 * i] + lengths[2 * i + 1], counts[2 * i] + counts[2 * i + 1]
    return len(parts), lengths, counts


def _put(tree: list[int], leaf: int, value: int) -> None:
    i = len(tree) // 2 + leaf
    change = value - tree[i]
    while i and change:
        tree[i] += change
        i //= 2


def _leaf_at(lengths: list[int], place: int, n: int) -> tuple[int, int]:
    """The leaf that holds a place, and where it starts; past the end, the last leaf that is not empty."""
    size, i, start = len(lengths) // 2, 1, 0
    place = min(place, max(lengths[1] - 1, 0))
    while i < size:
        i *= 2
        if place - start >= lengths[i]:
            start += lengths[i]
            i += 1
    return i - size, start


def apply_edits(text: str, tree: tuple[int, list[int], list[int]], edits: list[dict], count) -> tuple[str, tuple, int, int]:
    """The edited text and its tree, the number of edits made and of characters that were encoded again."""
    n, lengths, counts = tree
    lengths, counts, again = list(lengths), list(counts), 0
    todo, end = [], 0
    for e in sorted(edits, key=lambda e: (e["start"] or 0, e["length"] or 0)):
        start = min(max(e["start"] or 0, 0), len(text))
        stop = min(max(start + (e["length"] or 0), start), len(text))
        if start >= end:
            todo.append((start, stop, e["replacement"] or ""))
            end = stop
    for start, stop, new in reversed(todo):  # places before an edit stay as they are
        low, a = _leaf_at(lengths, start, n)
        high, b = _leaf_at(lengths, max(stop - 1, start), n)
        size = len(lengths) // 2
        b += lengths[size + high]
        while True:
            region = text[a:start] + new + text[stop:b]
            left, right = text[a - 1:a], text[b:b + 1]
            if left and not (region[:1] or right or " ") in (" ", "\n", "\t"):
                low -= 1
                a -= lengths[size + low]
            elif right and (region[-1:] or left or " ").isspace():
                high += 1
                b += lengths[size + high]
            else:
                break
        text = text[:a] + region + text[b:]
        again += len(region)
        for leaf in range(low, high + 1):
            _put(lengths, leaf, len(region) if leaf == low else 0)
            _put(counts, leaf, count(region) if leaf == low else 0)
    return text, (n, lengths, counts), len(todo), again


def _trees(rows: list[tuple[int, list[int], list[int]]]) -> pa.Array:
    n, lengths, counts = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(lengths, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                                      ["leaves", "lengths", "counts"])


def load_counter(spark, ranks: str, pattern: str):
    """A broadcast counter over a tiktoken rank file."""
    with open(ranks, "rb") as f:
        return spark.sparkContext.broadcast(Counter(f.read(), pattern))


def trees(counter, text: str | Column = "text") -> Column:
    """The trees of a text column; ``counts[1]`` is the number of tokens of the text."""

    @F.arrow_udf(TREE)
    def of(texts: pa.Array) -> pa.Array:
        return _trees([grow(leaves(t.as_py() or ""), counter.value) for t in texts])

    return of(text)


def edited(counter, text: Column, tree: Column, edits: Column) -> Column:
    """A struct of the edited text, its tree, the number of edits made and of characters encoded again."""

    @F.arrow_udf(f"struct<text: string, tree: {TREE}, n_edits: int, encoded: long>")
    def of(texts: pa.Array, known: pa.Array, changes: pa.Array) -> pa.Array:
        out = [apply_edits(t.as_py() or "", tuple(k.as_py().values()), e.as_py() or [], counter.value)
               for t, k, e in zip(texts, known, changes)]
        new, grown, made, again = zip(*out) if out else ((), (), (), ())
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), _trees(list(grown)), pa.array(made, pa.int32()),
                                           pa.array(again, pa.int64())], ["text", "tree", "n_edits", "encoded"])

    return of(text, tree, edits)


def replacements(rules: list[tuple[str, str]], text: str | Column = "text") -> Column:
    """Edits that put a word in place of whatever matches a pattern; patterns are tried at each place in order."""
    whole = "|".join(f"({p})" for p, _ in rules)

    @F.arrow_udf(EDITS)
    def of(texts: pa.Array) -> pa.Array:
        find, words = re.compile(whole), [w for _, w in rules]
        return pa.array([[{"start": m.start(), "length": m.end() - m.start(), "replacement": words[m.lastindex - 1]}
                          for m in find.finditer(t.as_py() or "")] for t in texts],
                        pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("replacement", pa.string())])))

    return of(text)


def recount(docs: DataFrame, edits: Column, counter) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, encoded, n_chars_before`` of every document.

    The trees of all documents are written once; only documents with edits are read again, with their trees.
    """
    key = F.xxhash64("text").alias("tkey")
    known = settled(docs.select("doc_id", key, F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars_before"), trees(counter).alias("tree")))
    changed = docs.select("doc_id", key, "text", edits.alias("edits")).where(F.size("edits") > 0)
    # rows with equal id and text have equal trees and equal edits: one of each is enough
    one = known.groupBy("doc_id", "tkey").agg(F.first("tree").alias("tree")).select(
        F.col("doc_id").alias("d"), F.col("tkey").alias("k"), "tree")
    done = changed.join(one, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k"))).select(
        "d", "k", edited(counter, F.col("text"), F.col("tree"), F.col("edits")).alias("e"))
    done = done.select("d", "k", "e.n_edits", "e.encoded", F.col("e.tree.counts")[1].alias("after")).distinct()
    before = F.col("tree.counts")[1].cast("long")
    return known.join(done, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k")), "left").select(
        "doc_id", "n_chars_before", before.alias("n_tokens"), F.coalesce("n_edits", F.lit(0)).cast("long").alias("n_edits"),
        F.coalesce(F.col("after").cast("long"), before).alias("n_tokens_after"), F.coalesce("encoded", F.lit(0)).cast("long").alias("encoded"))
