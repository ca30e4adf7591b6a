"""Near-duplicate embeddings by NN-descent.

Vectors link if their labels are equal and the cosine, in double precision, is at least ``threshold``. Equal vectors of
a label are one node. A first neighbour graph comes from sign tables: in each, nodes are sorted by label, the signs of a
few random projections and one more projection, and every node meets those beside it. NN-descent then refines the graph:
neighbours of a common node are compared, better ones enter the lists, and a list that is full of links is enlarged.
Edges that cannot lead to a link over a common neighbour (below ``2 threshold^2 - 1``) are not followed.

A list is enlarged up to ``widest``; nodes with more links than that are counted exactly, as are all others: inside each
component the vectors are compared in blocks, and only counts leave a block. Components do not hang on the lists: every
link that was ever found counts, also those that no list holds, and components are then compared in blocks, to the last
pair, where nodes of both lie in one crowded bucket of a sign table or a known edge below the threshold joins them; one
link of a pair of components leaves a block. An audit compares drawn vectors with all of their label by brute force; while
too few links were found or the descent was still adding some, more tables are added, and after ``_ATTEMPTS`` it is an error.

Nulls: rows with a null id, label or vector, and vectors that are zero or hold a null or a non-finite component, link
with nothing and are a component of their own. Vectors of different length don't link. Repeated rows link with each other.
An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import sorted_groups
from tidemark.session import settled

_BESIDE = 16  # rows on either side that a node meets in a table
_PART = 64  # members of a neighbourhood that are compared at once
_BLOCK = 512  # nodes of a component that are compared at once
_ATTEMPTS = 6


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    lengths = lambda m: np.sqrt((m * m).sum(1))
    return (x @ y.T) / np.outer(lengths(x), lengths(y))


def distinct_nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, label, dim, v, copies, least`` of the vectors that can link, and all rows with their node or null."""
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"))
    rows = rows.withColumn("node", F.when(good, F.xxhash64("label", "embedding")))

    @F.arrow_udf("binary")
    def raw(arrays: pa.Array) -> pa.Array:
        flat, ends = arrays.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(arrays.value_lengths().to_numpy())]
        # scaled by a power of two, which changes no cosine but keeps squares finite
        parts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return pa.array([np.ldexp(p, -int(np.frexp(np.abs(p).max())[1])).astype("<f8").tobytes() for p in parts], pa.binary())

    nodes = rows.where("node is not null").groupBy("node", "label", "embedding").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return settled(nodes.select("node", "label", F.size("embedding").alias("dim"), raw("embedding").alias("v"), "copies", "least")), rows.select("vec_id", "node")


def _signed(nodes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """The place of each node in each sign table."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                x = _matrix(rows.column("v"), dim)
                for t in range(tables):
                    p = x @ np.random.default_rng([seed, t, int(dim)]).standard_normal((dim, bits + 1))
                    signs = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    along = p[:, bits] / np.sqrt((x * x).sum(1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), rows.column("label"), rows.column("dim"), pa.array(signs),
                         pa.array(along), rows.column("node"), rows.column("v")],
                        names=["t", "label", "dim", "signs", "along", "node", "v"])

    return nodes.select("node", "label", "dim", "v").mapInArrow(
        sign, "t int, label int, dim int, signs long, along double, node long, v binary")


def table_pairs(nodes: DataFrame, tables: int, bits: int, floor: float, seed: int) -> DataFrame:
    """``node, other, sim`` of nodes that lie side by side in sign tables and are at least ``floor`` alike."""

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            whole = (pa.concat_tables([tail, table]) if tail is not None else table).combine_chunks()
            old = tail.num_rows if tail is not None else 0
            tail = whole.slice(max(0, whole.num_rows - _BESIDE))
            key = np.stack([whole[c].to_numpy().astype(np.int64) for c in ("t", "label", "dim")])
            node, dims = whole["node"].to_numpy(), whole["dim"].to_numpy()
            for low in range(max(0, old), whole.num_rows, 256):
                a, b = max(0, low - _BESIDE), min(whole.num_rows, low + 256)
                for dim in np.unique(dims[a:b]):
                    own = a + np.flatnonzero(dims[a:b] == dim)
                    x = _matrix(whole["v"].take(pa.array(own)), dim)
                    sims = _cosines(x, x)
                    near = (np.abs(own[:, None] - own[None, :]) <= _BESIDE) & (own[:, None] < own[None, :]) & (own[None, :] >= low)
                    near &= (key[:, own][:, :, None] == key[:, own][:, None, :]).all(0) & (sims >= floor)
                    i, j = np.nonzero(near)
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(node[own[i]]), pa.array(node[own[j]]), pa.array(sims[i, j])],
                                                         names=["node", "other", "sim"])

    order = ["t", "label", "dim", "signs", "along"]
    pairs = _signed(nodes, tables, bits, seed).repartitionByRange(*order).sortWithinPartitions(*order, "node").mapInArrow(beside, "node long, other long, sim double")
    return pairs.groupBy("node", "other").agg(F.max("sim").alias("sim"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim"))


def _best(candidates: DataFrame, widths: DataFrame, k: int) -> DataFrame:
    """The best neighbours of each node, as many as its list is wide."""
    once = candidates.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(W.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return (once.join(widths, "node", "left").withColumn("place", place)
            .where(F.col("place") <= F.coalesce("width", F.lit(k))).select("node", "other", "sim"))


def descend(nodes: DataFrame, graph: DataFrame, threshold: float, floor: float, k: int, widest: int, rounds: int) -> tuple[DataFrame, DataFrame, bool]:
    """Refine ``node, other, sim`` until a round adds no link and no list that is full of links can grow. Returns the graph,
    ``a, b`` of all links that were ever found, and whether that end was reached within the rounds."""
    spark = nodes.sparkSession
    widths = spark.createDataFrame([], "node long, width int")
    graph, ended = settled(graph), False
    linked = lambda pairs: pairs.where(F.col("sim") >= threshold).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    ever = linked(graph)
    graph = settled(_best(_both_ways(graph), widths, k))
    vectors = nodes.select(F.col("node").alias("member"), "dim", "v")
    links = -1

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["v0", "part"]):
            if group.num_rows < 2:
                continue
            x = _matrix(group["v"].combine_chunks(), group["dim"][0].as_py())
            member, bound = group["member"].to_numpy(), group["bound"].to_numpy()
            sims = _cosines(x, x)
            i, j = np.nonzero(np.triu((sims >= floor) & ((sims > bound[:, None]) | (sims > bound[None, :])), 1))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(member[i]), pa.array(member[j]), pa.array(sims[i, j])],
                                                 names=["node", "other", "sim"])

    for turn in range(rounds):
        state = settled(graph.groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("worst"),
                                                  F.sum((F.col("sim") >= threshold).cast("long")).alias("links"))
                        .join(widths, "node", "left").withColumn("width", F.coalesce("width", F.lit(k))))
        full = (F.col("n") >= F.col("width")) & (F.col("worst") >= threshold) & (F.col("width") < widest)
        now, growing = state.agg(F.sum("links"), F.sum(full.cast("int"))).first()
        if now is None or (now == links and not growing):
            ended = True
            break
        links = now
        widths = settled(state.select("node", F.when(full, F.least(2 * F.col("width"), F.lit(widest))).otherwise(F.col("width")).cast("int").alias("width")))
        bounds = state.join(widths.withColumnRenamed("width", "wide"), "node").select(
            F.col("node").alias("member"), F.when(F.col("n") >= F.col("wide"), F.col("worst")).otherwise(F.lit(-2.0)).alias("bound"))
        around = _both_ways(graph).select(F.col("node").alias("v0"), F.col("other").alias("member")).distinct()
        sizes = around.groupBy("v0").agg(F.ceil(F.count("*") / _PART).alias("parts"))
        around = (around.join(sizes, "v0").withColumn("part", F.pmod(F.xxhash64("member", F.lit(turn)), F.col("parts")).cast("int"))
                  .join(bounds, "member").join(vectors, "member"))
        found = settled(around.select("v0", "part", "member", "dim", "v", "bound").repartition("v0", "part").sortWithinPartitions("v0", "part", "member")
                 .mapInArrow(compare, "node long, other long, sim double").groupBy("node", "other").agg(F.max("sim").alias("sim")))
        ever = ever.unionByName(linked(found))
        graph = settled(_best(graph.unionByName(_both_ways(found)), widths, k))
    return graph, ever.distinct(), ended


def links_across(nodes: DataFrame, member: DataFrame, edges: DataFrame, tables: int, bits: int, threshold: float, seed: int) -> DataFrame:
    """``a, b``: a link of each two components that have one between nodes of one crowded bucket (other buckets are met as
    they are), or at all if one of ``edges`` (``node, other``) is between them."""
    own = settled(nodes.select("node").join(member, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    crowded = (_signed(nodes, tables, bits, seed).select(F.xxhash64("t", "label", "dim", "signs").alias("cell"), "node").join(own, "node"))
    several = crowded.groupBy("cell").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).where(
        (F.col("x") < F.col("y")) & (F.col("n") > _BESIDE + 1))
    cells = crowded.join(several.select("cell"), "cell").select("cell", "node", "component")
    of = lambda c, to: own.select(F.col("node").alias(c), F.col("component").alias(to))
    joined = edges.join(of("node", "cx"), "node").join(of("other", "cy"), "other").where("cx <> cy").select(
        F.least("cx", "cy").alias("x"), F.greatest("cx", "cy").alias("y")).distinct()
    # two single nodes were compared when their edge was found
    sizes = own.groupBy("component").agg(F.count("*").alias("n"))
    size = lambda c, to: sizes.select(F.col("component").alias(c), F.col("n").alias(to))
    joined = joined.join(size("x", "nx"), "x").join(size("y", "ny"), "y").where("nx + ny > 2").select(
        F.xxhash64("x", "y").alias("cell"), F.explode(F.array("x", "y")).alias("component"))
    cells = settled(cells.unionByName(joined.join(own, "component").select("cell", "node", "component")))
    blocks = cells.groupBy("cell").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    placed = cells.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", "node", "component", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
    met = met.join(nodes.select("node", "label", "dim", "v"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["cell", "x", "y", "label", "dim"]):
            vectors = _matrix(g["v"].combine_chunks(), g["dim"][0].as_py())
            component, names = g["component"].to_numpy(), g["node"].to_numpy()
            i, j = np.nonzero(np.triu((_cosines(vectors, vectors) >= threshold) & (component[:, None] != component[None, :]), 1))
            if len(i):
                two = np.sort(np.stack([component[i], component[j]], 1), 1)
                first = np.unique(two, axis=0, return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(names[i[first]]), pa.array(names[j[first]])], names=["a", "b"])

    keys = ["cell", "x", "y"]
    return (met.select(*keys, "label", "dim", "node", "component", "v").repartition(*keys).sortWithinPartitions(*keys, "label", "dim", "node")
            .mapInArrow(compare, "a long, b long").distinct())


def count_links(nodes: DataFrame, member: DataFrame, threshold: float) -> DataFrame:
    """``node, n_links``: exact inside the components of ``node, component``; only counts leave a block."""
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    placed = member.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "node", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"),
        (F.col("block") <= F.col("with")).alias("in_x"), (F.col("block") >= F.col("with")).alias("in_y"))
    met = met.join(nodes.select("node", "dim", "v", "copies"), "node")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["component", "x", "y"]):
            vectors = _matrix(g["v"].combine_chunks(), g["dim"][0].as_py())
            in_x, in_y = (np.flatnonzero(g[c].to_numpy()) for c in ("in_x", "in_y"))
            copies, names = g["copies"].to_numpy(), g["node"].to_numpy()
            linked = _cosines(vectors[in_x], vectors[in_y]) >= threshold
            one = g["x"][0].as_py() == g["y"][0].as_py()
            if one:
                np.fill_diagonal(linked, False)  # both sides are the same nodes in the same order
            yield pa.RecordBatch.from_arrays([pa.array(names[in_x]), pa.array(linked @ copies[in_y])], names=["node", "n"])
            if not one:
                yield pa.RecordBatch.from_arrays([pa.array(names[in_y]), pa.array(copies[in_x] @ linked)], names=["node", "n"])

    keys = ["component", "x", "y"]
    columns = [*keys, "node", "dim", "v", "copies", "in_x", "in_y"]
    return (met.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(count, "node long, n long")
            .groupBy("node").agg(F.sum("n").alias("n_links")))


def audit(nodes: DataFrame, counted: DataFrame, threshold: float, queries: int, seed: int) -> float:
    """Share of the links of at most ``queries`` drawn nodes, by brute force over all nodes, that were counted."""
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(queries).select("node", "label", "dim", "v").collect()
    by: dict[tuple, list] = {}
    for r in drawn:
        by.setdefault((r.label, r.dim), []).append((r.node, np.frombuffer(r.v, np.float64)))
    shared = nodes.sparkSession.sparkContext.broadcast(by)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            label, dims, names, copies = (batch.column(c).to_numpy() for c in ("label", "dim", "node", "copies"))
            for (own, dim), asked in shared.value.items():
                at = np.flatnonzero((label == own) & (dims == dim))
                if len(at):
                    linked = _cosines(np.stack([v for _, v in asked]), _matrix(batch.column("v").take(pa.array(at)), dim)) >= threshold
                    linked &= np.array([n for n, _ in asked])[:, None] != names[at][None, :]
                    for (n, _), c in zip(asked, linked @ copies[at]):
                        total[n] = total.get(n, 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["node", "n"])

    true = nodes.mapInArrow(look, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    both = true.join(counted, "node", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("n_links", F.lit(0))))).first()
    return 1.0 if not both[0] else both[1] / both[0]


def link_vectors(vectors: DataFrame, threshold: float = 0.98, k: int = 10, widest: int = 40, rounds: int = 8, recall: float = 0.999,
                 queries: int = 2000, seed: int = 11) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    nodes, rows = distinct_nodes(vectors)
    floor = 2 * threshold**2 - 1
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = min(40, max(1, math.ceil(math.log2(largest / _BESIDE))))
    together = (1 - math.acos(threshold) / math.pi) ** bits  # chance that the least alike link falls into one bucket
    tables = min(64, max(6, math.ceil(math.log(1 - recall) / math.log(1 - together))))
    pairs = settled(table_pairs(nodes, tables, bits, floor, seed))
    ever = None
    for attempt in range(1, _ATTEMPTS + 1):
        graph, found, ended = descend(nodes, pairs, threshold, floor, k, widest, rounds)
        ever = settled(found if ever is None else ever.unionByName(found).distinct())
        member = settled(components(ever))
        edges = pairs.select("node", "other").unionByName(graph.select("node", "other"))
        more = settled(links_across(nodes, member, edges, tables, bits, threshold, seed + attempt - 1))
        if not more.isEmpty():
            ever = settled(ever.unionByName(more).distinct())
            member = settled(components(ever))
        counted = settled(count_links(nodes, member, threshold))
        found = audit(nodes, counted, threshold, queries, seed)
        if ended and found >= recall:
            break
        pairs = settled(graph.unionByName(table_pairs(nodes, tables, bits, floor, seed + attempt)))
    else:
        raise RuntimeError(f"{found:.4f} of the links found after {_ATTEMPTS} attempts, wanted {recall}, descent ended: {ended}")
    member = nodes.select("node", "copies", "least").join(member, "node", "left").join(counted, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "least",
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    found = member.join(least, "component").select("node", "n_links", "component_id")
    return rows.join(found, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        F.expr("vec_id <=> coalesce(component_id, vec_id)").alias("kept"))
