"""SentencePiece encoding and decoding as relations.

Text is cut into units that no piece of the vocabulary reaches across: a unit ends before a blank that follows another
character and, where the vocabulary allows, where letters and other characters meet. The distinct units of all texts form
the lattice: their substrings, as long as a piece may begin so, are exploded and equi-joined to the piece table (a
vocabulary of fixed size, broadcast), the edges are grouped by unit, and a higher-order ``aggregate`` folds them:

* ``bpe``: scores are merge ranks. The fold walks the edges in the order of their scores and joins two neighbouring
  symbols whenever together they are the edge; that is the segmentation the library returns for such a model, which the
  best sum of scores (Viterbi) is not.
* ``unigram``: the fold is Viterbi's, over the edges by their ends.

Characters without a piece become byte pieces. Encoded units meet the documents again in groups of a few megabytes of
text: the most frequent units (a fixed number) are broadcast, the others are requested by the groups that have them.

Nulls: a null text has no ids, as has an empty one; ids that are null or unknown decode to nothing. Repeated rows are
encoded each. An empty table gives no rows. A unit of more than 60 characters is folded with an array instead of a bit
mask, in time that grows with the square of its length.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import settled

SPACE = "▁"
_SPLIT = rf"{SPACE}*(?:[^\W\d_]+|(?:[^\w{SPACE}]|[\d_])+)|{SPACE}+"
_WHOLE = rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
_FREQUENT = 1 << 16
_GROUP = 8 << 20  # bytes of text in a group
_MASKED = 60
_HELD = 1 << 18  # units that a task counts before it hands them on
_LEAD = 4  # characters by which the pieces that may begin at a place are told


@dataclass
class Vocabulary:
    pieces: list[tuple[str, int, float]]  # text, id, score
    texts: list[str]  # hexadecimal bytes of each id's text
    bytes: list[int]  # the id of each byte, or the unknown id
    units: str  # pattern of the units

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file, as the library lists it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = [(model.id_to_piece(i), i, model.get_score(i)) for i in plain]
    own = {i: model.id_to_piece(i).replace(SPACE, " ").encode().hex() for i in plain}
    texts = [f"{int(model.id_to_piece(i)[3:5], 16):02x}" if model.is_byte(i) else own.get(i, "") for i in ids]
    by_byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return vocabulary(pieces, texts, by_byte)


def vocabulary(pieces: list[tuple[str, int, float]], texts: list[str], by_byte: list[int]) -> Vocabulary:
    """Units are cut between letters and other characters only if no piece holds both."""
    apart = re.compile(rf"{SPACE}*(?:[^\W\d_]+|(?:[^\w{SPACE}]|[\d_])+)?")
    inner = [p for p, _, _ in pieces if not apart.fullmatch(p)]
    if any(SPACE in p.lstrip(SPACE) for p in inner):
        raise ValueError("pieces reach across words")
    return Vocabulary(pieces, texts, by_byte, _WHOLE if inner else _SPLIT)


def units_of(text: str | None, pattern: re.Pattern) -> list[str]:
    return pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []


def unit_counts(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``unit, n`` of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, total = re.compile(vocab.units), Counter()
        for batch in batches:
            for text in batch.column("text"):
                total.update(units_of(text.as_py(), pattern))
                if len(total) > _HELD:
                    yield from _counted(total)
                    total = Counter()
        yield from _counted(total)
        total.clear()
        pa.default_memory_pool().release_unused()  # workers stay for the next stage

    # a given number of tasks: a unit's substrings are many times its size, by which adaptive execution would put tasks together
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("text").mapInArrow(count, "unit string, n long").repartition(tasks, "unit").groupBy("unit").agg(F.sum("n").alias("n"))


def _counted(total: Counter) -> Iterator[pa.RecordBatch]:
    pairs = iter(total.items())
    while some := list(itertools.islice(pairs, 1 << 14)):
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["unit", "n"])


def lattice(units: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The units with ``edges``: their substrings that are pieces, each one number of 20 bits each for the place of the
    piece in the order of scores, best first, and for the edge's start and end.

    Substrings that no piece begins with are not made: a start is first joined to the longest piece that begins with its
    characters. The empty substring of each unit meets an empty row of the table, so a unit without any piece stays."""
    spark = units.sparkSession
    table = spark.createDataFrame([("", None), *((p, k) for k, (p, _, _) in enumerate(_by_score(vocab)))], "piece string, place long")
    reach: dict[str, int] = {}
    for p, _, _ in vocab.pieces:
        if len(p) >= _LEAD:
            reach[p[:_LEAD]] = max(len(p), reach.get(p[:_LEAD], 0))
    leads = spark.createDataFrame(list(reach.items()), "lead string, reach int")
    size = F.char_length("unit")
    starts = units.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("start")).join(
        F.broadcast(leads), F.substring("unit", F.col("start") + 1, F.lit(_LEAD)) == F.col("lead"), "left")
    first = F.when(F.col("start") == 0, 0).otherwise(F.col("start") + 1)
    last = F.least(F.col("start") + F.coalesce("reach", F.lit(_LEAD - 1)), size)
    parts = starts.select(*units.columns, "start", F.explode(F.sequence(first, last)).alias("end")).select(
        *units.columns, (F.col("start").cast("long") * _SHIFT + F.col("end")).alias("span"),
        F.substring("unit", F.col("start") + 1, F.col("end") - F.col("start")).alias("piece"))
    edges = parts.join(F.broadcast(table), "piece").select(*units.columns, (F.col("place") * _SHIFT * _SHIFT + F.col("span")).alias("edge"))
    return edges.groupBy(*units.columns).agg(F.collect_list("edge").alias("edges"))  # already dealt by unit


_SHIFT = 1 << 20


def _by_score(vocab: Vocabulary) -> list[tuple[str, int, float]]:
    return sorted(vocab.pieces, key=lambda p: (-p[2], p[1]))


def _parts(edge: Column) -> tuple[Column, Column, Column]:
    """Place of the piece, start and end."""
    return F.shiftright(edge, 40), F.shiftright(edge, 20).bitwiseAND(_SHIFT - 1).cast("int"), edge.bitwiseAND(_SHIFT - 1).cast("int")


def _bytes(piece: Column, vocab: Vocabulary) -> Column:
    code = F.hex(F.encode(piece, "UTF-8"))
    ids = F.split(F.lit(",".join(map(str, vocab.bytes))), ",").cast("array<int>")
    return F.transform(F.sequence(F.lit(1), F.length(code) - 1, F.lit(2)),
                       lambda i: F.element_at(ids, F.conv(code.substr(i, F.lit(2)), 16, 10).cast("int") + 1))


def _right(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x, by)


def _left(x: Column, by: Column) -> Column:
    return F.call_function("shiftleft", x, by)


def _merge_by_mask(edges: Column, size: Column) -> Column:
    """Whether each place of a short unit is a bound between symbols after all merges: a bit mask."""
    one = F.lit(1).cast("long")

    def step(mask: Column, edge: Column) -> Column:
        _, start, end = _parts(edge)
        inner = _right(mask, start + 1).bitwiseAND(_left(one, end - start - 1) - 1)
        ends = _left(one, start).bitwiseOR(_left(one, end))
        joins = (inner != 0) & (inner.bitwiseAND(inner - 1) == 0) & (mask.bitwiseAND(ends) == ends)
        return F.when(joins, mask.bitwiseXOR(_left(inner, start + 1))).otherwise(mask)

    return F.aggregate(edges, _left(one, size + 1) - 1, step)


def _merge_by_array(edges: Column, size: Column) -> Column:
    """As above for any length: the array of the bounds."""

    def step(bounds: Column, edge: Column) -> Column:
        _, start, end = _parts(edge)
        inner = F.filter(bounds, lambda b: (b > start) & (b < end))
        joins = (F.size(inner) == 1) & F.array_contains(bounds, start) & F.array_contains(bounds, end)
        return F.when(joins, F.array_except(bounds, inner)).otherwise(bounds)

    return F.aggregate(edges, F.sequence(F.lit(0), size), step)


def _viterbi(edges: Column, size: Column, scores: Column, unknown: float) -> Column:
    """The bounds of the path with the best sum of scores. ``edges``: by end and start, those without a piece negative."""
    best = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.when(i == 0, F.lit(0.0)).otherwise(F.lit(float("-inf"))).alias("sum"), F.array(F.lit(0)).alias("path")))

    def step(state: Column, edge: Column) -> Column:
        before = F.element_at(state, edge["start"] + 1)
        total = before["sum"] + F.when(edge["place"] < 0, F.lit(unknown)).otherwise(F.element_at(scores, edge["place"] + 1))
        return F.transform(state, lambda x, i: F.when((i == edge["end"]) & (total > x["sum"]), F.struct(
            total.alias("sum"), F.concat(before["path"], F.array(edge["end"])).alias("path"))).otherwise(x))

    return F.element_at(F.aggregate(edges, best, step), -1)["path"]


def encode_units(units: DataFrame, vocab: Vocabulary, kind: str = "bpe") -> DataFrame:
    """The units with their ``ids``."""
    size = F.char_length("unit")
    ordered = _by_score(vocab)
    text = lambda values: F.split(F.lit(",".join(map(str, values))), ",")
    ids_of = text([i for _, i, _ in ordered]).cast("array<int>")
    cut = lattice(units, vocab)
    if kind == "bpe":
        cut = cut.withColumn("edges", F.sort_array("edges"))
        cut = cut.withColumn("mask", F.when(size <= _MASKED, _merge_by_mask(F.col("edges"), size)))
        set_bits = F.filter(F.sequence(F.lit(0), size), lambda b: _right(F.col("mask"), b).bitwiseAND(F.lit(1).cast("long")) == 1)
        bounds = F.when(F.col("mask").isNotNull(), set_bits).otherwise(_merge_by_array(F.col("edges"), size))
    elif kind == "unigram":
        worst = min(s for _, _, s in vocab.pieces) - 10  # of a character without a piece
        edge = lambda place, start, end: F.struct(end.alias("end"), start.alias("start"), place.cast("int").alias("place"))
        known = F.transform("edges", lambda e: edge(*_parts(e)))
        starts = F.transform("edges", lambda e: F.when(_parts(e)[2] == _parts(e)[1] + 1, _parts(e)[1]))
        bare = F.transform(F.array_except(F.sequence(F.lit(0), size - 1), starts), lambda i: edge(F.lit(-1), i, i + 1))
        scores = text([s for _, _, s in ordered]).cast("array<double>")
        bounds = _viterbi(F.array_sort(F.concat(known, bare)), size, scores, worst)
    else:
        raise ValueError(f"no such kind of model: {kind}")
    cut = cut.withColumn("bounds", bounds)
    # the pieces between neighbouring bounds: every span of the path, and the place of its piece where it has one
    spans = F.zip_with(F.slice("bounds", 1, F.size("bounds") - 1), F.slice("bounds", 2, F.size("bounds") - 1),
                       lambda a, b: a.cast("long") * _SHIFT + b)
    cut = cut.withColumn("spans", spans)
    used = F.filter("edges", lambda e: F.array_contains("spans", e.bitwiseAND(_SHIFT * _SHIFT - 1)))
    cut = cut.withColumn("used", F.map_from_entries(F.array_distinct(F.transform(used, lambda e: F.struct(
        e.bitwiseAND(_SHIFT * _SHIFT - 1), F.element_at(ids_of, F.shiftright(e, 40).cast("int") + 1))))))
    own = F.transform("spans", lambda s: F.element_at("used", s))
    cut = cut.withColumn("own", own)
    plain = ~F.exists("own", lambda i: i.isNull())
    whole = F.flatten(F.transform("spans", lambda s: F.when(F.element_at("used", s).isNotNull(), F.array(F.element_at("used", s))).otherwise(
        _bytes(F.substring("unit", F.shiftright(s, 20).cast("int") + 1, F.lit(1)), vocab))))
    return cut.select(*units.columns, F.when(plain, F.col("own")).otherwise(whole).alias("ids"))


_JOINED = "doc_id long, text string, ids array<int>"


def encode(docs: DataFrame, vocab: Vocabulary, kind: str = "bpe", frequent: int = _FREQUENT) -> DataFrame:
    """``doc_id, text, ids`` of every document."""
    spark: SparkSession = docs.sparkSession
    encoded = settled(encode_units(unit_counts(docs, vocab), vocab, kind))
    top = encoded.orderBy(F.desc("n"), "unit").limit(frequent).select("unit", "ids").collect()
    common = spark.sparkContext.broadcast({r.unit: np.array(r.ids, np.int32).tobytes() for r in top})
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // _GROUP))
    table = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("g"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text").repartition(max(1, groups // 2), "g")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, known, asked = re.compile(vocab.units), common.value, defaultdict(set)
        for batch in batches:
            for g, text in zip(batch.column("g").to_pylist(), batch.column("text")):
                asked[g].update(u for u in units_of(text.as_py(), pattern) if u not in known)
        while asked:
            g, units = asked.popitem()
            while units:
                some = [units.pop() for _ in range(min(len(units), 1 << 14))]
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(some), pa.int32()), pa.array(some, pa.string())], names=["g", "unit"])

    rare = table.mapInArrow(ask, "g int, unit string").join(encoded.select("unit", "ids"), "unit").select("g", "unit", "ids")

    def meet(texts: pa.Table, answers: pa.Table) -> pa.Table:
        pattern, known = re.compile(vocab.units), common.value
        ids = answers["ids"].combine_chunks()
        flat, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        own = {u: flat[a:b].tobytes() for u, a, b in zip(answers["unit"].to_pylist(), ends[:-1], ends[1:])}
        found = []
        for text in texts["text"]:
            found.append(b"".join([known.get(u) or own[u] for u in units_of(text.as_py(), pattern)]))
        ends = np.r_[0, np.cumsum([len(f) // 4 for f in found])].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
        return pa.Table.from_arrays([texts["doc_id"], texts["text"], lists], names=["doc_id", "text", "ids"])

    return table.groupBy("g").cogroup(rare.groupBy("g")).applyInArrow(meet, _JOINED)


def decode(ids: str | Column, vocab: Vocabulary) -> Column:
    """The text of an array of ids, without the blank that encoding put before it."""
    texts = F.split(F.lit(",".join(vocab.texts)), ",")
    ids = F.col(ids) if isinstance(ids, str) else ids
    code = F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(texts, i), F.lit(""))), "")
    text = F.decode(F.unhex(code), "UTF-8")
    return F.when(F.size(ids) == 0, F.lit("")).otherwise(F.when(text.startswith(" "), text.substr(F.lit(2), F.length(text))).otherwise(text))
