"""Removal of passages that repeat across documents.

A word goes if a window of ``window`` consecutive words that covers it also starts in a document with a smaller id.

Recurring passages are found without writing every window down. Each window points to its smallest half-window hash, its
anchor; equal windows have equal anchors, so anchors of a single document need no further look. Around each other anchor
lies the context that its windows can reach. Where the context first occurred in a smaller document, all of it is a
recurring passage. Only where one anchor has several contexts, the first document of each compares single windows.

Passages are then confirmed on the words themselves: for each document, a few passages that cover what hashes say is
repeated are fetched from the text of the first document that has them, automata (Aho-Corasick) are compiled for the
passages of some consecutive documents at a time, and these documents are streamed through them. What the automaton
finds is removed, at every occurrence. No step pairs documents, and a passage that a third of all documents share is
one row per document that holds it.

Nulls: a null text has no words; a null id counts as larger than any other. Rows with equal ids do not remove from each
other; equal rows get equal results. Empty texts and an empty table pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import Texts, owned, run_hashes, run_starts, slices, sliding, stretch_hashes, word_hashes
from tidemark.session import settled

_LAST = np.iinfo(np.int64).max
_KEY = ["id", "tkey"]
_STREAM = 1 << 18  # bytes of text that share an automaton


def anchors(t: Texts, window: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts: hash, hash of the context, first place in its text, whether the text has it again, text."""
    half = window // 2
    reach = window - half
    h, doc = word_hashes(t), t.doc_of_word()
    g = run_hashes(h, half)
    whole = run_starts(t, window)
    empty = np.zeros(0, np.int64)
    if not len(whole):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty.astype(bool), empty
    least = np.zeros(len(h) + reach, np.uint64)  # 0 where no window starts
    least[whole + reach] = sliding(np.minimum, g, reach + 1)[whole]
    g = np.maximum(g, 1)
    most = sliding(np.maximum, least, reach + 1)[:len(g)]
    at = np.flatnonzero(g == most)
    first, last = t.words[doc[at]], t.words[doc[at] + 1]
    low, high = np.maximum(at - reach, first), np.minimum(at + window, last)
    context = stretch_hashes(h, low, high) ^ ((at - low).astype(np.uint64) << np.uint64(32))
    key = owned(doc[at], context)
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    again = np.diff(np.r_[np.flatnonzero(new), len(order)]) > 1
    keep = order[new]
    at = at[keep]
    return g[at], context[keep], at - t.words[doc[at]], again, doc[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _occurrences(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("tkey").to_numpy()
            for t in slices(batch.column("text")):
                h, context, place, again, doc = anchors(t, window)
                yield pa.RecordBatch.from_arrays(
                    [_signed(h), _signed(context), _signed(ids[t.first + doc]), _signed(keys[t.first + doc]),
                     pa.array(place.astype(np.int32)), pa.array(again)], names=["h", "c", "id", "tkey", "place", "again"])

    return find


def _windows(window: int):
    half = window // 2
    reach = window - half

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, places = batch.column("id").to_numpy(), batch.column("tkey").to_numpy(), batch.column("places")
            for t in slices(batch.column("text")):
                wanted = places.slice(t.first, t.n)
                owner = np.repeat(np.arange(t.n), np.diff(wanted.offsets.to_numpy()))
                at = wanted.flatten().to_numpy() + t.words[owner]
                start = (at[:, None] + np.arange(-reach, 1)[None, :]).ravel()
                owner = np.repeat(owner, reach + 1)
                start = np.unique(start[(start >= t.words[owner]) & (start + window <= t.words[owner + 1])])
                h = word_hashes(t)
                doc = t.doc_of_word()[start]
                yield pa.RecordBatch.from_arrays(
                    [_signed(stretch_hashes(h, start, start + window)), _signed(ids[t.first + doc]), _signed(keys[t.first + doc]),
                     pa.array((start - t.words[doc]).astype(np.int32))], names=["w", "id", "tkey", "place"])

    return find


def _cover(rows: pa.Array) -> list[list[dict]]:
    """Of each document's passages, those needed to cover what all of them cover; repeated ones are all needed."""
    out = []
    for passages in rows.to_pylist():
        passages.sort(key=lambda p: (p["low"], -p["high"]))
        need, end, best = {}, 0, None
        for p in passages:
            if p["again"]:
                need[(p["oid"], p["okey"], p["olow"], p["ohigh"])] = None
            if p["low"] > end:
                if best is not None:
                    need[best[1]], end = None, best[0]
                    best = None
                if p["low"] > end:
                    end = p["low"]
            if p["high"] > end and (best is None or p["high"] > best[0]):
                best = (p["high"], (p["oid"], p["okey"], p["olow"], p["ohigh"]))
        if best is not None:
            need[best[1]] = None
        out.append([dict(zip(("oid", "okey", "olow", "ohigh"), k)) for k in need])
    return out


_PASSAGE = "struct<oid: long, okey: long, olow: int, ohigh: int>"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted places of each text, joined by one space."""
    for batch in batches:
        ids, keys, wanted = (batch.column(c).to_pylist() for c in ("id", "tkey", "wanted"))
        out = []
        for t in slices(batch.column("text")):
            for k in range(t.n):
                row, first = t.first + k, t.words[k]
                for w in wanted[row]:
                    words = [t.word(i) for i in range(first + w["olow"], min(first + w["ohigh"], t.words[k + 1]))]
                    out.append((ids[row], keys[row], w["olow"], w["ohigh"], b" ".join(words).decode("utf-8", "replace")))
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["oid", "okey", "olow", "ohigh", "words"])


def repeated_passages(keyed: DataFrame, window: int = 50) -> DataFrame:
    """``id, tkey, passages``: for each text that repeats a smaller one, passages (``words, owner``) of first documents
    that cover its repeated words. ``keyed``: id, tkey, text."""
    half = window // 2
    reach = window - half
    occurrences = keyed.select(*_KEY, "text").mapInArrow(
        _occurrences(window), "h long, c long, id long, tkey long, place int, again boolean")
    shared = occurrences.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h")
    found = settled(occurrences.join(shared, "h"))
    firsts = found.groupBy("h", "c").agg(F.min(F.struct("id", "tkey", "place")).alias("first"))
    firsts = settled(firsts)
    several = firsts.groupBy("h").agg((F.count("*") > 1).alias("several"))
    # an anchor that a third of all texts share is one hot key of plain joins, whose partitions Spark can split
    firsts = settled(firsts.join(several, "h"))
    placed = settled(found.join(firsts, ["h", "c"]))
    low, high = F.greatest(F.col("place") - reach, F.lit(0)), F.col("place") + window
    o = F.col("first.place")
    by_context = placed.where("first.id < id").select(
        *_KEY, low.alias("low"), high.alias("high"), "again", F.col("first.id").alias("oid"), F.col("first.tkey").alias("okey"),
        F.greatest(o - reach, F.lit(0)).alias("olow"), (o + window).alias("ohigh"))
    single = placed.where("several and first.id = id").groupBy(*_KEY).agg(F.collect_list("place").alias("places"))
    windows = settled(keyed.join(single, _KEY).select(*_KEY, "text", "places").mapInArrow(
        _windows(window), "w long, id long, tkey long, place int"))
    owners = windows.groupBy("w").agg(F.min(F.struct("id", "tkey", "place")).alias("first"), F.max("id").alias("most")).where("first.id < most")
    by_window = windows.join(owners, "w").where("first.id < id").select(
        *_KEY, F.col("place").alias("low"), (F.col("place") + window).alias("high"), F.lit(False).alias("again"),
        F.col("first.id").alias("oid"), F.col("first.tkey").alias("okey"), F.col("first.place").alias("olow"),
        (F.col("first.place") + window).alias("ohigh"))
    each = F.collect_list(F.struct("low", "high", "again", "oid", "okey", "olow", "ohigh"))

    @F.arrow_udf(f"array<{_PASSAGE}>")
    def cover(rows: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("oid", pa.int64()), ("okey", pa.int64()), ("olow", pa.int32()), ("ohigh", pa.int32())]))
        return pa.array(_cover(rows), kind)

    needs = settled(by_context.unionByName(by_window).groupBy(*_KEY).agg(each.alias("all"))
                    .select(*_KEY, F.explode(cover("all")).alias("p")).select(*_KEY, "p.*"))
    passage = ["oid", "okey", "olow", "ohigh"]
    wanted = needs.select(*passage).distinct().groupBy("oid", "okey").agg(
        F.collect_list(F.struct("olow", "ohigh")).alias("wanted"))
    texts = keyed.join(
        wanted.select(F.col("oid").alias("id"), F.col("okey").alias("tkey"), "wanted"), _KEY).select(*_KEY, "text", "wanted")
    words = texts.mapInArrow(_cut_out, "oid long, okey long, olow int, ohigh int, words string")
    return needs.join(words, passage).groupBy(*_KEY).agg(
        F.collect_set(F.struct("words", F.col("oid").alias("owner"))).alias("passages"))


def _stream(t: Texts, ids: np.ndarray, passages: list[list[dict] | None]) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Number of removed words and, where there are any, the marks of the words to keep, of each text."""
    removed, keep = np.zeros(t.n, np.int64), [None] * t.n
    automaton = ahocorasick.Automaton()
    for of_text in passages:
        for p in of_text or ():
            known = automaton.get(f" {p['words']} ", None)
            owner = p["owner"] if known is None else min(known[1], p["owner"])
            automaton.add_word(f" {p['words']} ", (p["words"].count(" ") + 1, owner))
    if not len(automaton):
        return removed, keep
    automaton.make_automaton()
    for k in range(t.n):
        first, n = t.words[k], t.words[k + 1] - t.words[k]
        text = f" {t.joined(k)} "
        hits = [(end, length) for end, (length, owner) in automaton.iter(text) if owner < ids[k]]
        if not hits:
            continue
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
        end, length = np.array(hits).T
        last = np.searchsorted(spaces, end)
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, last - length, 1)
        np.add.at(change, last, -1)
        gone = np.cumsum(change)[:n] > 0
        removed[k], keep[k] = gone.sum(), ~gone
    return removed, keep


def _without(t: Texts, k: int, keep: np.ndarray | None, as_words: bool) -> str:
    """The text without its removed words: the kept words joined by a space, or the text as it stands between them."""
    first, last = t.words[k], t.words[k + 1]
    if as_words and keep is None:
        return t.joined(k)
    if as_words:
        return b" ".join([t.word(i) for i in np.flatnonzero(keep) + first]).decode("utf-8", "replace")
    low, high = t.bounds[k], t.bounds[k + 1]
    if keep is None:
        return t.data[low:high].tobytes().decode("utf-8", "replace")
    out = [t.data[low:t.starts[first]].tobytes()]
    for i in np.flatnonzero(keep) + first:
        out.append(t.data[t.starts[i]:t.starts[i + 1] if i + 1 < last else high].tobytes())
    return b"".join(out).decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, window: int = 50, as_words: bool = True) -> DataFrame:
    """The documents with ``n_words``, ``n_removed`` and ``kept``: the kept words joined by one space, or, without
    ``as_words``, the text with the removed words and the white space after them cut out."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
                        F.xxhash64("text").alias("tkey"), "text")
    found = settled(repeated_passages(keyed, window))

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string>")
    def strip(texts: pa.Array, ids: pa.Array, passages: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        ids = ids.to_numpy(zero_copy_only=False)
        for t in slices(texts, _STREAM):
            gone, keep = _stream(t, ids[t.first:t.first + t.n], passages.slice(t.first, t.n).to_pylist())
            n_words.append(t.counts())
            n_removed.append(gone)
            kept += [_without(t, k, keep[k], as_words) for k in range(t.n)]
        join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.StructArray.from_arrays([join(n_words), join(n_removed), pa.array(kept, pa.string())], ["n_words", "n_removed", "kept"])

    own = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "__tkey": F.xxhash64("text")})
    found = found.select(F.col("id").alias("__id"), F.col("tkey").alias("__tkey"), F.col("passages").alias("__passages"))
    done = own.join(found, ["__id", "__tkey"], "left").withColumn("__done", strip("text", "__id", "__passages"))
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    return done.select(*kept, "__done.*")
