"""Divergence between the sources of a language, by terms, in whole numbers.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z in lower case. A language keeps the terms that are in
at least ``MIN_DOCS`` of its documents; V is their number. A group (language and source), and a language as a whole, gives a
kept term that it holds c times, c >= 0, the share p = 1 + floor(10^9 (c + 2) / (N + 2 V)), N being the sum of its c. The
distance of shares p and q is f = floor((p - q)^2 / (p + q)).

The distance of two groups sums f over all kept terms, with the terms that both, one or none of them holds. It is computed row by
row as in Gustavson's product of sparse matrices: the term-major index (term -> groups that hold it, with shares) is
cut into shards of terms; in a shard each group walks its terms and scatters every term's row of the index into one dense
accumulator with a cell a peer. What leaves the task is that accumulator once a group and shard, never a row a pair of postings.
The accumulator starts from the shares that stand for a count of zero: with p0 and q0 the groups' shares at count 0,

    sum f(p, q) = sum over both: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)      the scattered cells
                + sum over p's terms: f(p, q0) + sum over q's terms: f(p0, q)   baselines
                + (V - terms of p - terms of q) f(p0, q0)

A baseline needs a group's shares only with how often each occurs: a group of N occurrences has fewer than
sqrt(2 N) + 1 distinct counts, so that histogram is short, and each entry is spread over the dense row of the peers' q0.

Work grows with the terms of the groups times the sources of a language; results with the square of the sources, as asked.
Memory of a task is bounded: counts of terms are passed on every ``_TERMS`` terms, an index shard is worked off ``_POSTINGS``
postings at a time, accumulators are passed on every ``_CELLS`` cells. A row of the index and an accumulator are as long as a
language has sources.

Nulls: null text, language and source are empty texts, and the empty language or source is one like any other. Empty texts
have no terms, but their group occurs. Very long texts are cut into pieces of a megabyte between terms. Repeated rows are
documents of their own. A language without kept terms has distance 0 between its groups. Ties of a value are ordered
by the bytes of the item. Extra columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import settled

MIN_DOCS = 10
TOP_TERMS = 10
_TERMS = 200_000
_PIECE = 1 << 20
_POSTINGS = 1 << 19
_CELLS = 1 << 21

_FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_GAP = re.compile(rb" ")


def _pieces(data: bytes):
    """The terms of a text, some at a time."""
    data = data.translate(_FOLD)
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + _PIECE)
        upto = gap.end() if gap else len(data)
        yield data[at:upto].split()
        at = upto


def _counted(batches):
    """Occurrences and documents of each term by language and source, summed over as many rows as memory allows."""
    terms: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    held = 0

    def flush():
        rows = [(*g, t, n, docs[g][t]) for g, of in terms.items() for t, n in of.items()]
        terms.clear(), docs.clear()
        langs, sources, names, counts, n_docs = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(names, pa.binary()).cast(pa.string()),
             pa.array(counts, pa.int64()), pa.array(n_docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = (batch.column(k).to_pylist() for k in (0, 1))
        for lang, source, text in zip(langs, sources, batch.column(2)):
            key = lang, source
            if key not in terms:
                terms[key], docs[key] = Counter(), Counter()
            data = text.as_buffer()
            seen: set[bytes] = set()
            before = len(terms[key])
            for words in _pieces(data.to_pybytes() if data is not None else b""):
                terms[key].update(words)
                seen.update(words)
            docs[key].update(seen)
            held += len(terms[key]) - before
            if held > _TERMS:
                yield flush()
                held = 0
    yield flush()


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], "text")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n``: kept terms with a count above 0, and the count in their whole language.

    One shuffle by language and term serves the counts of groups, the counts of languages and the term-major order.
    """
    raw = _named(docs).select("lang", "source", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = raw.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    groups = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = groups.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"),
                                               F.collect_list(F.struct("source", "n")).alias("held"))
    return terms.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n", F.inline("held"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exact: three digits of the quotient at a time stay within 64 bits."""
    below = total + 2 * kept
    quotient, rest = F.lit(0).cast("long"), n + 2
    for _ in range(3):
        scaled = rest * 1000
        quotient, rest = quotient * 1000 + _div(scaled, below), scaled % below
    return quotient + 1


def distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per group: ``lang, source, at`` (place in its language), ``total, held`` (kept terms in it), ``lang_total, kept, zero``.

    ``zero`` is the share of a count of 0, null where the language keeps nothing.
    """
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    per_term = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    per_lang = per_term.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("kept"))
    all_groups = _named(docs).groupBy("lang", "source").agg(F.lit(1).alias("one"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = all_groups.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").select(
        "lang", "source", zero("total"), zero("held"), zero("lang_total"), zero("kept"))
    return joined.withColumns({
        "at": F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1,
        "zero": F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))})


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _accumulated(batches):
    """Index rows ``lang, peers (place, share, share of 0)`` to ``lang, at, peer, value``: one accumulator per group and shard."""
    rows_of: dict[str, dict[int, np.ndarray]] = {}  # accumulators of the groups of a language
    cells = 0

    def flush():
        out = [(lang, g, np.flatnonzero(acc), acc) for lang, groups in rows_of.items() for g, acc in groups.items()]
        rows_of.clear()
        for lang, g, peers, acc in out:
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(peers)), pa.array(np.full(len(peers), g, np.int32)),
                 pa.array(peers.astype(np.int32)), pa.array(acc[peers])], ["lang", "at", "peer", "value"])

    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        lists = batch.column(1)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values
        at, p, zero = (flat.field(k).to_numpy() for k in ("at", "p", "zero"))
        code = langs.indices.to_numpy()
        for c, lang in enumerate(langs.dictionary.to_pylist()):
            terms = np.flatnonzero(code == c)
            starts, sizes = bounds[terms], np.diff(bounds)[terms]
            # group-major order of the postings: for each group, the index rows that it walks
            term_of = np.repeat(np.arange(len(terms)), sizes)
            place = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            order = np.argsort(at[place], kind="stable")
            groups, first = np.unique(at[place][order], return_index=True)
            width = int(at[place].max(initial=-1)) + 1
            held = rows_of.setdefault(lang, {})
            for g, a, b in zip(groups, first, [*first[1:], len(order)]):
                acc = held.get(g, np.zeros(0, np.int64))
                if len(acc) < width:
                    cells += width - len(acc)
                    acc = np.r_[acc, np.zeros(width - len(acc), np.int64)]
                walked = order[a:b]
                done = 0
                while done < len(walked):  # some index rows at a time
                    upto = done + max(1, int(np.searchsorted(np.cumsum(sizes[term_of[walked[done:]]]), _POSTINGS, "right")))
                    mine, row = place[walked[done:upto]], term_of[walked[done:upto]]
                    reach = sizes[row]
                    peers = np.repeat(starts[row] - np.r_[0, np.cumsum(reach)[:-1]], reach) + np.arange(reach.sum())
                    own = np.repeat(mine, reach)
                    value = _f(p[own], p[peers]) - _f(p[own], zero[peers]) - _f(zero[own], p[peers]) + _f(zero[own], zero[peers])
                    np.add.at(acc, at[peers], value)
                    done = upto
                held[g] = acc
                if cells > _CELLS:
                    yield from flush()
                    cells, held = 0, rows_of.setdefault(lang, {})
    yield from flush()


def _baselines(held: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, at, peer, value``: the sum over the terms of group ``peer`` of f(share of 0 in group ``at``, its share), both ways."""
    shares = held.groupBy("lang", "at", "p").agg(F.count("*").alias("times"))
    short = shares.groupBy("lang", "at").agg(F.collect_list(F.struct("p", "times")).alias("shares"))
    zeros = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "zero"))).alias("zeros"))
    spread = F.transform("zeros", lambda z: F.struct(z["at"].alias("peer"), F.aggregate(
        "shares", F.lit(0).cast("long"), lambda acc, s: acc + s["times"] * distance(s["p"], z["zero"])).alias("value")))
    one_way = short.join(zeros, "lang").select("lang", "at", F.inline(spread))
    return one_way.unionAll(one_way.select("lang", F.col("peer").alias("at"), F.col("at").alias("peer"), "value"))


def divergences(groups: DataFrame, held: DataFrame) -> DataFrame:
    """``lang, at, peer, value`` of every two groups of a language. ``held``: lang, term, at, p, zero of the groups' terms."""
    index = held.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p", "zero")).alias("peers"))
    scattered = index.select("lang", "peers").mapInArrow(_accumulated, "lang string, at int, peer int, value long")
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("at", "held", "zero")).alias("others"))
    none = (F.col("kept") - F.col("held") - F.col("o.held")) * distance(F.col("zero"), F.col("o.zero"))
    empty = groups.join(peers, "lang").withColumn("o", F.explode("others")).select(
        "lang", "at", F.col("o.at").alias("peer"), F.coalesce(none, F.lit(0)).alias("value"))
    return (empty.unionAll(scattered).unionAll(_baselines(held, groups)).where("at <> peer")
            .groupBy("lang", "at", "peer").agg(F.sum("value").alias("value")))


def _ranked(rows: DataFrame, upto: int | None = None) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if upto is None else ranked.where(F.col("rank") <= upto)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a language is from each other one, and its ``top`` terms.

    Part ``pair`` has a row per other source with their distance; part ``term`` has the kept terms of the source that it
    uses more than its language does, with f of the two shares.
    """
    kept = settled(kept_counts(docs, min_docs))
    groups = settled(group_totals(docs, kept))
    held = settled(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "at", "zero", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")))
    names = groups.select("lang", "at", "source")
    pairs = (divergences(groups, held).join(names, ["lang", "at"])
             .join(names.select("lang", F.col("at").alias("peer"), F.col("source").alias("item")), ["lang", "peer"]))
    terms = held.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    cols = lambda part: ("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return _ranked(pairs).select(*cols("pair")).unionAll(_ranked(terms, top).select(*cols("term")))
