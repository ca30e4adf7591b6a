"""A random forest for the sign of the event return, grown on all rows.

Trees are grown in groups. Every numeric column is cut into at most 255 steps at its quantiles, every category is a column of
its own; a row is then a few bytes. A tree sees each row as often as a Poisson draw says, a hash of the row and the tree,
so a task that is run again draws the same.

A node with more than ``local_rows`` rows is split across the cluster: tasks add up class weights by node, drawn column and
step, Spark sums them and picks the split of least impurity; only splits travel, two numbers each. Below that size all rows
of a node go to one task, which grows the rest of its tree, a level at a time. So a task holds ``local_rows`` rows at most, and the
driver holds the splits of large nodes, at most 2 x rows x trees / ``local_rows``, and no tree. The nodes of a
group are a written table; rows are scored where the nodes of their part of a tree are, and averaged.

Trees grow until a leaf is pure or its rows are all alike. A null number lies below all others; a category that was not
there in the fit is none of the columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidemark.operators.features import CATEGORICAL_REGRESSORS, FOREST_NUMERICS
from tidemark.operators.positions import with_position
from tidemark.session import release_paths, scratch_path, settled

# Fixed values of the study design.
TREES, SEED, FOLDS, MIN_ROWS = 500, 42, 5, 30
GROUP = 125  # trees that are grown together
LOCAL_ROWS = 1 << 21
_STEPS = 255
_TRAVEL = 3 << 27  # rows, times trees, that are dealt together
_BLOCK = 8  # whole trees, at most, that are grown or score rows together
_ONE = 1 << 26  # draws of label 1 in a packed sum
_RUN = 1 << 16  # rows that are worked on at a time
_FEW, _FIELD = 10_000, 1 << 17  # rows at a time, and more than the draws of so many, at most 12 each
_FLUSH = 1 << 22  # cells of class weights that a task adds up before it passes them on
NODES = "tree int, top long, node int, feature int, cut int, left long, right long, p double, gain double"


def sign_label(df: DataFrame, car: str) -> DataFrame:
    """Rows with a return and ``label`` = 1.0 for a positive one."""
    return df.where(F.col(car).isNotNull()).withColumn("label", (F.col(car) > 0).cast("double"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, weight`` with weight = n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # one row per class
    both = W.partitionBy()
    return counts.select(label, "n", (F.sum("n").over(both) / (F.count("*").over(both) * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(class_weights(df).select("label", "weight")), "label")


def encoder(categorical: Sequence[str] = CATEGORICAL_REGRESSORS) -> Pipeline:
    """One-hot encoding in which a category not seen in training becomes all zeros."""
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_ix" for c in categorical],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical],
                      dropLast=True, handleInvalid="error"),
    ])


# ---- draws: hashes in place of a generator's state

def _hash(*parts, of: np.ndarray | None = None) -> np.ndarray:
    """64 even bits of whole numbers, which are spread over each other's shape; ``of``: the hash of the parts before them."""
    h = np.full(1, 0x9E3779B97F4A7C15, np.uint64) if of is None else of
    for part in parts:
        h = h ^ (np.asarray(part).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


_POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, k + 1))) for k in range(12)])


# by the first 16 bits of a draw; 255 where they don't tell
_BY_BITS = np.searchsorted(_POISSON, np.arange(1 << 16) / float(1 << 16)).astype(np.uint8)
_BY_BITS[_BY_BITS != np.searchsorted(_POISSON, (np.arange(1 << 16) + 1) / float(1 << 16))] = 255


def _drawn(known: np.ndarray, tree: int) -> np.ndarray:
    """``_times`` as bytes of rows whose hash with the seed is known."""
    h = _hash(tree, of=known)
    times = _BY_BITS.take((h >> np.uint64(48)).view(np.int64))
    rest = np.flatnonzero(times == 255)
    times[rest] = np.searchsorted(_POISSON, (h[rest] >> np.uint64(11)) / float(1 << 53))
    return times


def _times(rows: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree sees each row: Poisson with mean 1."""
    return _drawn(_hash(rows, seed), tree).astype(np.float64)


def _order_of_columns(n: int, seed: int, tree: int, top: int, nodes: np.ndarray) -> np.ndarray:
    """For each node the order in which it tries the columns."""
    return np.argsort(_hash(seed, tree, top, nodes[:, None], np.arange(n)[None, :]), axis=1)


# ---- rows as bytes

@dataclass
class Coder:
    """How rows become bytes: steps of numbers, columns of categories."""

    numeric: list[str]
    steps: list[list[float]]
    categorical: list[str]
    levels: list[list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{v}" for c, levels in zip(self.categorical, self.levels) for v in levels]]

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, len(self.names)), np.uint8)
        for k, (name, steps) in enumerate(zip(self.numeric, self.steps)):
            values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            out[:, k] = np.where(np.isnan(values), 0, 1 + np.searchsorted(np.asarray(steps), values))
        at = len(self.numeric)
        for name, levels in zip(self.categorical, self.levels):
            column = batch.column(name)
            place = pc.fill_null(pc.index_in(column, value_set=pa.array(levels, column.type)), -1).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(place >= 0)
            out[rows, at + place[rows]] = 1
            at += len(levels)
        return out

    def select(self, df: DataFrame, *more) -> DataFrame:
        return df.select(*more, *[F.col(c).cast("double").alias(c) for c in self.numeric], *self.categorical)


def fit_coder(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Coder:
    """Steps at quantiles (all distinct values where they are few) and the categories, in alphabetic order."""
    marks = [k / _STEPS for k in range(1, _STEPS)]
    # the categories are a fixed few: the largest fifteen and the stages
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), marks, 1 << 14).alias(c) for c in numeric],
                 *[F.array_sort(F.collect_set(c)).alias(c) for c in categorical]).first()
    return Coder(list(numeric), [sorted(set(row[c] or [])) for c in numeric], list(categorical), [list(row[c]) for c in categorical])


# ---- the part of a tree below a node whose rows fit a task

def _packed(times: np.ndarray, one: np.ndarray) -> np.ndarray:
    """How often rows were drawn, of label 0 and of label 1, as one whole number, so that one exact sum adds up both."""
    return times * np.where(one > 0, float(_ONE), 1.0)


def _weights(packed: np.ndarray, classes: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """The weights of label 0 and of label 1 in sums of ``_packed``."""
    ones = np.floor(packed / _ONE)
    return classes[0] * (packed - ones * _ONE), classes[1] * ones


def _gain(left, total, classes) -> np.ndarray:
    """Impurity that a split takes away, by nine digits, so that equal ones are ties."""
    two = lambda zero, one: (zero ** 2 + one ** 2) / (zero + one)
    (l0, l1), (t0, t1) = _weights(left, classes), _weights(total, classes)
    return np.round(two(l0, l1) + two(t0 - l0, t1 - l1) - two(t0, t1), 9)


def _runs(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive groups that have about ``_RUN`` rows together."""
    of = (np.cumsum(sizes) - sizes) // _RUN
    edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else np.zeros(1, int)
    return list(zip(edges[:-1], edges[1:]))


@dataclass
class _Level:
    """The rows of a tree's open nodes, node by node, ``counts`` of each. A row is ``at``: its place in ``codes``
    times 32, and its place in ``drawn``.

    Rows of a node are in ascending order, so with codes column by column a node's look-ups go through memory in one direction.
    """

    codes: np.ndarray  # flat, column by column
    size: int  # codes of a column
    flags: np.ndarray  # a column of two values: its place in the sums below, or else -1
    low: np.ndarray  # the smaller value of each column
    high: np.ndarray  # for each row the places of the flags that have the larger value
    drawn: np.ndarray
    classes: Sequence[float]
    at: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        self.begin = np.cumsum(self.counts) - self.counts
        self.total = np.add.reduceat(self.drawn.take(self.at & 31), self.begin) if len(self.counts) else np.zeros(0)

    def of(self, nodes: np.ndarray) -> _Level:
        """The same for some of the nodes."""
        if len(nodes) == len(self.counts):
            return self
        mine = np.zeros(len(self.counts), bool)
        mine[nodes] = True
        rows = np.flatnonzero(np.repeat(mine, self.counts))
        return replace(self, at=self.at.take(rows), counts=self.counts[nodes])

    def rows_of(self, nodes: np.ndarray) -> np.ndarray:
        """The places of the rows of some nodes, one node after the other."""
        n = self.counts[nodes]
        return np.arange(n.sum()) + np.repeat(self.begin[nodes] - (np.cumsum(n) - n), n)

    def flag_sums(self, nodes: np.ndarray) -> np.ndarray:
        """``_packed`` sums by node and flag of the rows with the larger value."""
        n = int(self.flags.max()) + 2  # the last one is filled in where a row has fewer
        out = np.empty((len(nodes), n))
        for a, b in _runs(self.counts[nodes]):
            at = self.at.take(self.rows_of(nodes[a:b]))
            node = np.repeat(np.arange(b - a) * n, self.counts[nodes[a:b]])
            row, value = at >> 5, self.drawn.take(at & 31)
            out[a:b] = sum(np.bincount(high.take(row) + node, value, (b - a) * n) for high in self.high).reshape(-1, n)
        return out

    def child_sums(self, above: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """``flag_sums`` of the open nodes from those ``above``: first the left children of all nodes, then the right ones.

        Sums are whole numbers, so of two children the one of fewer rows is added up and the other one is what is left.
        """
        m = len(above)
        wanted = np.zeros(2 * m, bool)
        wanted[open_] = True
        pairs = np.flatnonzero(wanted[:m] | wanted[m:])
        is_left = self.counts[pairs] <= self.counts[m + pairs]
        few, rest = np.where(is_left, pairs, m + pairs), np.where(is_left, m + pairs, pairs)
        out = np.empty((2 * m, above.shape[1]))
        out[few] = self.flag_sums(few)
        out[rest] = above[pairs] - out[few]
        return out[open_]

    def sums_by_code(self, nodes: np.ndarray, columns: np.ndarray) -> Iterator[tuple]:
        """Some pairs of a node and a column at a time, from ``a`` to ``b``: the nodes' totals, the pairs' codes in order (256 times the
        pair are added) and the ``_packed`` sums up to each, of all pairs before it, too.

        Rows are put in order by sorting them, or by adding up each code where a pair has as many rows as there are codes.
        """
        for a, b in _runs(self.counts[nodes]):
            n, total, at = self.counts[nodes[a:b]], self.total[nodes[a:b]], self.at.take(self.rows_of(nodes[a:b]))
            code = self.codes.take((at >> 5) + np.repeat(columns[a:b] * self.size, n))
            if len(at) >= 256 * (b - a):
                sums = np.bincount(code + np.repeat(np.arange(b - a) << 8, n), self.drawn.take(at & 31), (b - a) << 8)
                cell = np.flatnonzero(sums)
                yield a, b, total, cell, np.cumsum(sums.take(cell))
                continue
            # pair, code and kind as one number: sorted by value, it holds all that a sum needs
            key = np.repeat(np.arange(b - a, dtype=np.uint32) << np.uint32(13), n) | (code.astype(np.uint32) << np.uint32(5)) | (at & 31).astype(np.uint32)
            key.sort()
            cell = key >> np.uint32(5)
            last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))
            upto = np.cumsum(self.drawn.take((key & np.uint32(31)).astype(np.intp))).take(last)
            yield a, b, total, cell.take(last).astype(np.int64), upto

    def steps(self, nodes: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best gain (-inf: none) and cut of pairs of a node and a column: rows in order of code, a split wherever it changes."""
        gain, cut = np.full(len(nodes), -np.inf), np.zeros(len(nodes), np.int64)
        for a, b, total, cell, upto in self.sums_by_code(nodes, columns):
            pair = cell >> 8
            edge = np.flatnonzero(pair[1:] == pair[:-1])
            if not len(edge):
                continue
            of = pair.take(edge)
            score = _gain(upto.take(edge) - (np.cumsum(total) - total).take(of), total.take(of), self.classes)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            top = np.maximum.reduceat(score, first)
            hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(first, len(of)))))
            hit = hit[np.append(True, of[hit[1:]] != of[hit[:-1]])]
            gain[a + of[first]], cut[a + of[first]] = top, cell.take(edge[hit]) & 255
        return gain, cut

    def scores(self, sums: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gain and cut of each node by each of its columns."""
        gain, cut = np.full(columns.shape, -np.inf), self.low[columns].astype(np.int64)
        place = self.flags[columns]
        i, k = np.nonzero(place >= 0)
        right, total = sums[i, place[i, k]], self.total[i]
        tells = np.flatnonzero((right > 0) & (right < total))
        gain[i[tells], k[tells]] = _gain((total - right)[tells], total[tells], self.classes)
        i, k = np.nonzero(place < 0)
        gain[i, k], cut[i, k] = self.steps(i, columns[i, k])
        return gain, cut

    def best(self, sums: np.ndarray, order: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best split of each node: column (-1: none), cut (left: up to it) and gain. The first column wins a tie.

        A node tries ``tries`` columns in its order, and the next ones only where none of these tells its rows apart.
        """
        m, now, todo = len(order), self, np.arange(len(order))
        column, cut, gain = np.full(m, -1), np.zeros(m, np.int64), np.zeros(m)
        for a, b in ((0, tries), (tries, 2 * tries), (2 * tries, order.shape[1])):
            columns = order[todo, a:b]
            if not columns.size:
                break
            gains, cuts = now.scores(sums[todo], columns)
            groups = np.pad(gains, ((0, 0), (0, -columns.shape[1] % tries)), constant_values=-np.inf).reshape(len(todo), -1, tries)
            at, first = np.arange(len(todo)), (groups.max(axis=2) > -np.inf).argmax(axis=1)
            k = first * tries + groups[at, first].argmax(axis=1)
            found = gains[at, k] > -np.inf
            where, at, k = todo[found], at[found], k[found]
            column[where], cut[where], gain[where] = columns[at, k], cuts[at, k], gains[at, k]
            todo, now = todo[~found], now.of(np.flatnonzero(~found))
        return column, cut, gain


def _flags(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``flags, low, high`` of a level: columns of two values, smaller values, and the flags that rows have."""
    low, top = columns.min(axis=1), columns.max(axis=1)
    flags = np.full(len(columns), -1)
    held = [np.flatnonzero(c == b) if b > a else np.zeros(0, np.intp) for c, a, b in zip(columns, low, top)]
    mine = [k for k, (c, a, b) in enumerate(zip(columns, low, top)) if a == b or len(held[k]) + np.count_nonzero(c == a) == len(c)]
    flags[mine] = np.arange(len(mine))
    n, size = np.zeros(columns.shape[1], np.int64), columns.shape[1]
    high = np.full((1, size), len(mine), np.int64 if len(mine) > 254 else np.uint8)
    for place, k in enumerate(mine):
        rows = held[k]
        at = n.take(rows)
        if len(rows) and at.max() >= len(high):
            high = np.concatenate([high, np.full_like(high[:1], len(mine))])
        high.reshape(-1)[at * size + rows] = place
        n[rows] = at + 1
    return flags, low, high


def _grow(codes, kind, classes, seed: int, tree: int, top: int, depth: int | None) -> dict[str, np.ndarray]:
    """All nodes of the tree over these rows: feature (-1: a leaf), cut, left, right, p, gain. Node 0 is its root.

    ``kind`` is twice how often a row was drawn, and one more for label 1; ``classes`` are the weights of both labels.
    """
    size, width = codes.shape
    tries = max(1, int(width ** 0.5))
    drawn = _packed(np.arange(32) // 2, np.arange(32) % 2)
    columns = np.ascontiguousarray(codes.T)
    now = _Level(columns.ravel(), size, *_flags(columns), drawn, classes, np.arange(size) << 5 | kind, np.array([size]))
    active, made, level, held, sums = np.array([0]), 1, 0, [], None
    while len(active):
        m = len(active)
        zero, one = _weights(now.total, classes)
        best, cut, gain = np.full(m, -1), np.zeros(m, np.int64), np.zeros(m)
        open_ = np.flatnonzero((zero > 0) & (one > 0) & (depth is None or level < depth))
        sums = now.flag_sums(open_) if sums is None else now.child_sums(sums, open_)
        now = now.of(open_)
        if len(open_):
            best[open_], cut[open_], gain[open_] = now.best(sums, _order_of_columns(width, seed, tree, top, active[open_]), tries)
        found = np.flatnonzero(best[open_] >= 0)
        now, sums = now.of(found), sums[found]
        splits = np.flatnonzero(best >= 0)
        child = np.full(m, -1)
        child[splits[np.argsort(active[splits])]] = made + 2 * np.arange(len(splits))
        held.append((active, best, cut, child, np.where(child >= 0, child + 1, -1), one / (zero + one), gain))
        # the left children of all nodes, then the right ones
        side = now.codes.take((now.at >> 5) + np.repeat(best[splits] * size, now.counts)) > np.repeat(cut[splits], now.counts)
        n_right = np.add.reduceat(side, now.begin, dtype=np.int64) if len(splits) else now.counts
        now = replace(now, at=np.concatenate([now.at[~side], now.at[side]]), counts=np.concatenate([now.counts - n_right, n_right]))
        active = np.concatenate([child[splits], child[splits] + 1])
        made += 2 * len(splits)
        level += 1
    ids, *held = map(np.concatenate, zip(*held))
    order = np.argsort(ids)
    return {name: of[order] for name, of in zip(("feature", "cut", "left", "right", "p", "gain"), held)}


# ---- large nodes, split across the cluster

def _routed(codes: np.ndarray, splits: dict) -> np.ndarray:
    """The node of each row below the splits of one tree: ``{node: (column, cut)}``, root 1, children 2 i and 2 i + 1."""
    at = np.ones(len(codes), np.int64)
    todo = [1] if 1 in splits else []
    while todo:
        i = todo.pop()
        column, cut = splits[i]
        rows = np.flatnonzero(at == i)
        at[rows] = 2 * i + (codes[rows, column] > cut)
        todo += [c for c in (2 * i, 2 * i + 1) if c in splits]
    return at


def _inside(columns: np.ndarray, splits: dict, top: int, known: dict) -> np.ndarray:
    """Which rows are in a node below the splits of one tree; ``known`` holds those of the root, and of all that were asked for."""
    if top not in known:
        column, cut = splits[top >> 1]
        side = columns[column] > cut if top & 1 else columns[column] <= cut
        known[top] = _inside(columns, splits, top >> 1, known) & side
    return known[top]


def _draws_of_steps(coded: DataFrame, width: int, trees: Sequence[int], seed: int, splits: dict, todo: dict) -> DataFrame:
    """``tree, top, feature, code, n, zeros, ones`` over the columns that ``todo[tree][top]`` lists: rows, and draws by label."""

    def add_up(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        seen = 0

        def flush():
            for (tree, top), cells in held.items():
                k, code = np.nonzero(cells[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), tree, np.int32)), pa.array(np.full(len(k), top)), pa.array(np.asarray(todo[tree][top], np.int32)[k]),
                     pa.array(code.astype(np.int32)), *[pa.array(c[k, code]) for c in cells]],
                    ["tree", "top", "feature", "code", "n", "zeros", "ones"])
            held.clear()

        for batch in batches:
            for low in range(0, batch.num_rows, _FEW):
                rows, codes, one, _ = _unpacked(batch.slice(low, _FEW), width)
                known, shift, codes = _hash(rows, seed), np.where(one > 0, _FIELD, 1).astype(np.int64) * _FIELD, np.ascontiguousarray(codes.T)
                most = codes.max(axis=1, initial=0)
                for tree in trees:
                    if not todo.get(tree):
                        continue
                    times = _drawn(known, tree)
                    # the rows, the draws of label 0 and those of label 1 in one number
                    value = (1 + times * shift).astype(np.float64)
                    inside = {1: times > 0}
                    for top, columns in todo[tree].items():
                        mine, m = np.flatnonzero(_inside(codes, splits.get(tree, {}), top, inside)), len(columns)
                        cells, own, sums = held.setdefault((tree, top), np.zeros((3, m, 256), np.int64)), value.take(mine), np.zeros((m, 256))
                        for k, column in enumerate(columns):
                            code = codes[column].take(mine)
                            if most[column] > 1:
                                sums[k] = np.bincount(code, own, 256)
                            else:
                                sums[k, 1] = own @ code.astype(np.float64)
                                sums[k, 0] = own.sum() - sums[k, 1]
                        sums = sums.astype(np.int64)
                        cells += [sums % _FIELD, sums // _FIELD % _FIELD, sums // _FIELD ** 2]
                seen += len(rows)
                if sum(c.size for c in held.values()) > _FLUSH or seen > _FLUSH:
                    yield from flush()
                    seen = 0
        yield from flush()

    sums = coded.mapInArrow(add_up, "tree int, top long, feature int, code int, n long, zeros long, ones long")
    return sums.groupBy("tree", "top", "feature", "code").agg(*[F.sum(c).alias(c) for c in ("n", "zeros", "ones")])


def _best_splits(steps: DataFrame, classes: Sequence[float]) -> DataFrame:
    """Per tree and node: its rows, class weights, and the best of its columns' splits (null where there is none)."""
    column = W.partitionBy("tree", "top", "feature")
    upto = column.orderBy("code").rowsBetween(W.unboundedPreceding, 0)
    run = steps.select("tree", "top", "feature", "code", *[F.sum(c).over(upto).alias(f"l_{c}") for c in ("n", "zeros", "ones")],
                       *[F.sum(c).over(column).alias(c) for c in ("n", "zeros", "ones")])
    run = run.select("tree", "top", "feature", "code", "n", "l_n", *[
        (F.col(f"{side}{c}") * w).alias(f"{side}{c}") for side in ("", "l_") for c, w in zip(("zeros", "ones"), classes)])
    two = lambda zero, one: (zero * zero + one * one) / (zero + one)
    left, left_one = F.col("l_zeros"), F.col("l_ones")
    right, right_one = F.col("zeros") - left, F.col("ones") - left_one
    gain = two(left, left_one) + two(right, right_one) - two(F.col("zeros"), F.col("ones"))
    split = F.when(F.col("l_n") < F.col("n"), F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("code")).alias("c"),
                                                        F.col("l_n").alias("n_left")))
    return run.select("tree", "top", "n", "zeros", "ones", split.alias("split")).groupBy("tree", "top").agg(
        F.max("n").alias("n"), F.max("zeros").alias("zeros"), F.max("ones").alias("ones"), F.max("split").alias("split"))


def _large_nodes(coded: DataFrame, n: int, classes: Sequence[float], width: int, trees: Sequence[int], seed: int, local_rows: int, depth: int | None):
    """Splits ``{tree: {top: (column, cut)}}`` of all nodes with more than ``local_rows`` rows, and their node rows."""
    splits: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in trees}
    rows, tries = [], max(1, int(width ** 0.5))
    order = lambda t, top: _order_of_columns(width, seed, t, top, np.array([0]))[0]
    # a tree sees all rows but those that are drawn no time; a margin keeps what might be more than fits off the tasks
    open_ = {(t, 1): 0 for t in trees} if n * (1 - np.exp(-1.0)) + 6 * n ** 0.5 > local_rows and (depth is None or depth > 0) else {}
    while open_:
        todo: dict[int, dict[int, list[int]]] = {}
        for (t, top), tried in open_.items():
            todo.setdefault(t, {})[top] = [int(c) for c in order(t, top)[tried:tried + tries]]
        found = _best_splits(_draws_of_steps(coded, width, trees, seed, splits, todo), classes).collect()  # a row per large node
        last, open_ = open_, {}
        for r in found:
            t, top, p = r.tree, r.top, r.ones / (r.zeros + r.ones)
            pure = r.ones <= 0 or r.zeros <= 0
            if r.split is None and not pure and last[t, top] + tries < width:
                open_[t, top] = last[t, top] + tries
            elif r.split is None or pure:  # its rows are alike: a leaf, however many they are
                rows.append((t, top, -1, -1, 0, -1, -1, p, 0.0))
            else:
                column, cut = -r.split.f, -r.split.c
                splits[t][top] = (column, cut)
                rows.append((t, top, -1, column, cut, 2 * top, 2 * top + 1, p, r.split.gain))
                for child, size in ((2 * top, r.split.n_left), (2 * top + 1, r.n - r.split.n_left)):
                    if size > local_rows and (depth is None or child.bit_length() <= depth):
                        open_[t, child] = 0
    return splits, rows


# ---- packing rows for the way through Spark

def _unpacked(batch, width: int):
    bytes_of = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.uint8)
    return (np.asarray(batch.column("row").to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64),
            bytes_of(batch.column("codes")).reshape(-1, width), *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("one", "weight")])


def _coded(df: DataFrame, coder: Coder, row: str | None = None) -> DataFrame:
    """``row (a hash, that of all columns or a given one), codes, one, weight`` of labelled rows, written once."""
    width = len(coder.names)

    def pack(batches):
        for batch in batches:
            codes = coder(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("one"), batch.column("weight")],
                ["row", "codes", "one", "weight"])

    known = F.col(row) if row else F.xxhash64(*df.columns)
    rows = coder.select(df, known.alias("row"), F.col("label").alias("one"), "weight")
    return settled(rows.mapInArrow(pack, "row long, codes binary, one double, weight double")) if width else rows


def _blocks(coded: DataFrame, width: int, trees: Sequence[int], seed: int, splits: dict, leaves: set) -> DataFrame:
    """The rows of a batch that a tree sees, by tree and node: ``tree, top, codes, kind``, a blob each; ``kind`` is that of ``_grow``."""

    def deal(batches):
        for batch in batches:
            rows, codes, one, _ = _unpacked(batch, width)
            known = _hash(rows, seed)
            for tree in trees:
                times = _drawn(known, tree)
                seen = np.flatnonzero(times)
                kind, mine = 2 * times[seen] + (one[seen] > 0), codes[seen]
                at = _routed(mine, splits.get(tree, {}))
                tops = [top for top in np.unique(at) if (tree, top) not in leaves]
                out = [(tree, int(top), mine[of].tobytes(), kind[of].tobytes())
                       for top in tops for of in [slice(None) if top == 1 else at == top]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                     ["tree", "top", "codes", "kind"])

    return coded.mapInArrow(deal, "tree int, top long, codes binary, kind binary")


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _spread(blocks: DataFrame, parts: int, *keys: str) -> DataFrame:
    """A fixed number of partitions: the rows are few bytes for the work they cause, and would be put together by size."""
    spark = blocks.sparkSession
    return blocks.repartition(max(parts, 2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


_NODES = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[t]) for c, t in (x.split() for x in NODES.split(", "))])


def _grown(codes, kind, classes: Sequence[float], seed: int, tree: int, top: int, depth: int | None) -> pa.Table:
    """The nodes that ``_grow`` makes, as rows."""
    left = None if depth is None else depth - (int(top).bit_length() - 1)
    n = _grow(codes, kind, classes, seed, tree, top, left)
    m = len(n["p"])
    return pa.table([np.full(m, tree, np.int32), np.full(m, top), np.arange(m, dtype=np.int32), n["feature"].astype(np.int32),
                     n["cut"].astype(np.int32), n["left"], n["right"], n["p"], n["gain"]], schema=_NODES)


def _nodes(blocks: DataFrame, parts: int, classes: Sequence[float], width: int, seed: int, depth: int | None) -> DataFrame:
    def grow(table: pa.Table) -> pa.Table:
        tree, top = table["tree"][0].as_py(), table["top"][0].as_py()
        codes = _joined(table["codes"], np.uint8).reshape(-1, width)
        return _grown(codes, _joined(table["kind"], np.uint8), classes, seed, tree, top, depth)

    return _spread(blocks, parts, "tree", "top").groupBy("tree", "top").applyInArrow(grow, NODES)


def _whole_trees(coded: DataFrame, classes: Sequence[float], width: int, trees: Sequence[int], seed: int, depth: int | None) -> DataFrame:
    """The nodes of trees that are grown whole. A few of them share a task and its rows, which travel once for all of them.

    A tree by itself is sent only the rows that it sees.
    """
    few = min(_BLOCK, max(1, len(trees) // (2 * coded.sparkSession.sparkContext.defaultParallelism)))
    if few == 1:
        return _nodes(_blocks(coded, width, trees, seed, {}, set()), len(trees), classes, width, seed, depth)
    blocks = [trees[i:i + few] for i in range(0, len(trees), few)]

    def deal(batches):
        for batch in batches:
            rows, codes, one, _ = _unpacked(batch, width)
            if len(rows):
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (codes, (one > 0).astype(np.uint8), rows)]
                for b in range(len(blocks)):
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *blobs], ["block", "codes", "one", "rows"])

    def grow(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        columns = np.ascontiguousarray(_joined(table["codes"], np.uint8).reshape(-1, width).T)
        one, known, block = _joined(table["one"], np.uint8), _hash(_joined(table["rows"], np.uint64), seed), blocks[table["block"][0].as_py()]
        del table
        for tree in block:
            times = _drawn(known, tree)
            seen = np.flatnonzero(times)
            if len(seen):
                kind = 2 * times[seen] + one[seen]
                yield from _grown(columns.take(seen, axis=1).T, kind, classes, seed, tree, 1, depth).to_batches(_RUN)

    dealt = coded.mapInArrow(deal, "block int, codes binary, one binary, rows binary")
    # a block, a partition
    return dealt.repartitionById(len(blocks), F.col("block")).mapInArrow(grow, NODES)


# ---- the fitted forest

@dataclass
class Forest:
    """``nodes``: node 0 is the root of the part of a tree below ``top``; node -1 is a large node, its children are tops."""

    coder: Coder
    nodes: DataFrame
    trees: int
    splits: dict = field(default_factory=dict)
    local_rows: int = LOCAL_ROWS

    def probability(self, df: DataFrame) -> DataFrame:
        """``row, probability`` of a positive sign; ``df`` has ``row``, a unique number.

        Rows are coded once and meet some blocks of trees at a time, of which only sums of votes are kept: what lies on disk at
        once doesn't grow with the number of trees.
        """
        n, coder, splits, trees = df.count(), self.coder, self.splits, self.trees
        salts, width = max(1, -(-n // self.local_rows)), len(coder.names)
        # whole trees go together; with large nodes, the part of a tree below a node is a group of its own
        block = 1 if splits else _BLOCK
        fields = [("block", pa.int32()), ("top", pa.int64()), ("salt", pa.int32()), ("codes", pa.binary()), ("rows", pa.binary())]
        kinds = pa.schema([("row", pa.int64()), ("p", pa.float64())])

        def pack(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([c.tobytes() for c in coder(batch)], pa.binary())], ["row", "codes"])

        def dealer(blocks: range):
            def deal(batches):
                for batch in batches:
                    codes, rows = _joined(batch.column("codes"), np.uint8).reshape(-1, width), batch.column("row").to_numpy()
                    salt = int(_hash(rows[:1])[0] % np.uint64(salts)) if len(rows) else 0
                    for b in blocks:
                        at = _routed(codes, splits.get(b, {}) if block == 1 else {})
                        out = [(b, int(top), salt, codes[mine].tobytes(), rows[mine].tobytes())
                               for top in np.unique(at) for mine in [np.flatnonzero(at == top)]]
                        if out:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], [n for n, _ in fields])

            return deal

        def score(rows: pa.Table, nodes: pa.Table) -> pa.Table:
            if not rows.num_rows or not nodes.num_rows:
                return pa.Table.from_pylist([], kinds)
            codes, ids = _joined(rows["codes"], np.uint8).reshape(-1, width), _joined(rows["rows"], np.int64)
            nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
            tree, feature, cut, left, p = (nodes[c].to_numpy() for c in ("tree", "feature", "cut", "left", "p"))
            feature, sums = feature.astype(np.intp), np.zeros(len(ids))
            roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])  # a large node that is a leaf is a root, too
            for low in range(0, len(ids), _RUN):
                part = codes[low:low + _RUN].ravel()
                n = len(part) // width
                for root in roots:
                    at = np.full(n, root)
                    todo = np.arange(n) if feature[root] >= 0 else np.arange(0)
                    while len(todo):
                        now = at.take(todo)
                        now = root + left.take(now) + (part.take(todo * width + feature.take(now)) > cut.take(now))
                        at[todo] = now
                        todo = todo[feature.take(now) >= 0]
                    sums[low:low + n] += p.take(at)
            return pa.table([ids, sums], schema=kinds)

        n_blocks = -(-trees // block)
        some = max(-(-3 * df.sparkSession.sparkContext.defaultParallelism // salts), 8, _TRAVEL // 8 // max(n, 1))
        coded = coder.select(df, F.col("row").cast("long").alias("row")).mapInArrow(pack, "row long, codes binary")
        if some < n_blocks:
            coded = settled(coded)
        local = self.nodes.where("node >= 0 or feature < 0").select(
            F.floor(F.col("tree") / block).cast("int").alias("block"), "top", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
            "tree", "node", "feature", "cut", "left", "p")
        keys, votes, last = ("block", "top", "salt"), None, []
        for start in range(0, n_blocks, some):
            blocks = range(start, min(start + some, n_blocks))
            dealt = coded.mapInArrow(dealer(blocks), "block int, top long, salt int, codes binary, rows binary")
            here, parts = local.where(F.col("tree").between(blocks[0] * block, (blocks[-1] + 1) * block - 1)), len(blocks) * salts
            more = _spread(dealt, parts, *keys).groupBy(*keys).cogroup(_spread(here, parts, *keys).groupBy(*keys)).applyInArrow(score, "row long, p double")
            votes = (more if votes is None else votes.unionAll(more)).groupBy("row").agg(F.sum("p").alias("p"))
            if blocks[-1] + 1 < n_blocks:
                path = scratch_path(df.sparkSession, "votes")
                votes = settled(votes, path)
                release_paths(df.sparkSession, last)
                last = [path]
        return votes.select("row", (F.col("p") / trees).alias("probability"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` of a positive sign and ``prediction``, 1.0 or 0.0."""
        rows = settled(df.withColumn("row", F.monotonically_increasing_id()))
        scored = self.probability(rows)
        return rows.join(scored, "row").drop("row").withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

    def save(self, path: str) -> None:
        """Nodes, and the meaning of their columns, as tables."""
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {"trees": self.trees, "local_rows": self.local_rows, "coder": vars(self.coder)}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first().meta)
        nodes = spark.read.parquet(f"{path}/nodes")
        splits: dict[int, dict] = {}
        for r in nodes.where("node < 0 and feature >= 0").collect():  # a row per large node
            splits.setdefault(r.tree, {})[r.top] = r.feature, r.cut
        return Forest(Coder(**meta["coder"]), nodes, meta["trees"], splits, meta["local_rows"])


def grow_forest(df: DataFrame, numeric: Sequence[str] = FOREST_NUMERICS, categorical: Sequence[str] = CATEGORICAL_REGRESSORS,
                trees: int = TREES, seed: int = SEED, max_depth: int | None = None, group: int = GROUP,
                local_rows: int = LOCAL_ROWS) -> Forest:
    """A forest over all rows of ``df`` (``label``, ``weight`` and the columns).

    The large nodes of ``group`` trees are split together. Their rows go through shuffles of up to ``_TRAVEL`` rows, or those of
    twice as many trees as there are cores.
    ``local_rows`` is the largest node that a task grows by itself. Rows of one label have one weight.
    """
    if not 0 < local_rows <= 1 << 22:  # a packed sum holds 2^26 draws, at most 12 a row
        raise ValueError("local_rows must be between 1 and 2^22")
    # a row is known by a hash of all its columns; what the trees look at is all that is written
    df = settled(df.select(F.xxhash64(*df.columns).alias("row"), "label", "weight", *numeric, *categorical))
    coder = fit_coder(df, numeric, categorical)
    coded, width = _coded(df, coder, "row"), len(coder.names)
    labels = {r.one: r for r in coded.groupBy("one").agg(F.count("*").alias("n"), F.min("weight").alias("w"), F.max("weight").alias("most")).collect()}
    if any(r.w != r.most for r in labels.values()):
        raise ValueError("rows of one label must have one weight")
    n, classes = sum(r.n for r in labels.values()), [labels[y].w if y in labels else 1.0 for y in (0.0, 1.0)]
    splits, nodes = {}, None
    travel = max(2 * df.sparkSession.sparkContext.defaultParallelism, _TRAVEL // max(n, 1))
    for start in range(0, trees, group):
        of = range(start, min(start + group, trees))
        large, rows = _large_nodes(coded, n, classes, width, of, seed, local_rows, max_depth)
        leaves = {(r[0], r[1]) for r in rows if r[3] < 0}
        for some in (of[i:i + travel] for i in range(0, len(of), travel)):
            if rows:
                grown = _nodes(_blocks(coded, width, some, seed, large, leaves), len(some), classes, width, seed, max_depth)
                grown = grown.unionAll(df.sparkSession.createDataFrame([r for r in rows if r[0] in some], NODES))
            else:
                grown = _whole_trees(coded, classes, width, some, seed, max_depth)
            grown = settled(grown)
            nodes = grown if nodes is None else nodes.unionAll(grown)
        splits |= {t: s for t, s in large.items() if s}
    return Forest(coder, nodes, trees, splits, local_rows)


def fit_forest(df: DataFrame, car: str, **options) -> Forest | None:
    """Grown on all labelled rows; ``None`` below 30 rows or with a single class. Options as of ``grow_forest``."""
    labelled = sign_label(df, car)
    size = labelled.agg(F.count("*").alias("n"), F.countDistinct("label").alias("k")).first()
    if size["n"] < MIN_ROWS or size["k"] < 2:
        return None
    return grow_forest(with_weights(labelled), **options)


def stratified_folds(df: DataFrame, order: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """``fold`` 0..k-1: within each label, consecutive blocks in row order.

    Block sizes come from dealing the positions of all labels, one label after the other in the order of their first
    rows, to the folds in turn; so folds differ by one row at most. A label may hold half of all rows, so its rows are
    numbered globally rather than inside one window partition.
    """
    placed = with_position(df, ["label", *order], "__pos")
    spans = placed.groupBy("label").agg(F.min("__pos").alias("__from"), F.count("*").alias("__n"), F.min(F.struct(*order)).alias("__first"))
    # one row per label
    before = W.orderBy("__first", "label").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    start, end = F.col("__start"), F.col("__start") + F.col("__n")
    # positions up to x that fall to fold i
    dealt = lambda x, i: F.floor((x - 1 - i + folds) / folds)
    sizes = [dealt(end, i) - dealt(start, i) for i in range(folds)]
    edges = F.array(*[sum(sizes[:i + 1], F.lit(0)) for i in range(folds - 1)])
    at = F.col("__pos") - F.col("__from")
    return (
        placed.join(F.broadcast(spans.select("label", "__from", edges.alias("__edges"))), "label")
        .withColumn("fold", F.size(F.filter("__edges", lambda e: at >= e)).cast("int")).drop("__pos", "__from", "__edges")
    )


def cross_validate(df: DataFrame, car: str, order: Sequence[str] = ("company_id", "announcement_date", "event_id"),
                   folds: int = FOLDS, **options) -> DataFrame:
    """``fold, n, positives, accuracy, roc_auc``; class weights come from the training part only. Options as of ``grow_forest``."""
    labelled = settled(stratified_folds(sign_label(df, car), order, folds))
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC", rawPredictionCol="votes", numBins=0)

    def score(k: int) -> tuple[int, int, int, float, float]:
        model = grow_forest(with_weights(labelled.where(F.col("fold") != k)), **options)
        scored = settled(model.transform(labelled.where(F.col("fold") == k)).select(
            "label", "prediction", array_to_vector(F.array(1 - F.col("probability"), "probability")).alias("votes")))
        n, positives = scored.agg(F.count("*"), F.count_if(F.col("label") > 0)).first()
        return k, n, positives, accuracy.evaluate(scored), auc.evaluate(scored)

    # the folds are independent jobs; submitting them together keeps the cluster busy
    with ThreadPool(folds) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(score), range(folds))
    return df.sparkSession.createDataFrame(rows, "fold int, n long, positives long, accuracy double, roc_auc double")


def cv_metrics(folds: DataFrame) -> DataFrame:
    """Share of positive labels; mean and population deviation of the fold scores."""
    return folds.agg(
        F.sum("n").alias("n_obs"), (F.sum("positives") / F.sum("n")).alias("pos_rate"),
        F.avg("accuracy").alias("cv_accuracy_mean"), F.stddev_pop("accuracy").alias("cv_accuracy_std"),
        F.avg("roc_auc").alias("cv_roc_auc_mean"), F.stddev_pop("roc_auc").alias("cv_roc_auc_std"),
    )


def feature_importance(model: Forest) -> DataFrame:
    """``feature, importance_mean, importance_std`` over the trees; one row per model feature.

    A tree's importances are its columns' shares of the impurity that its splits take away.
    """
    gains = model.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(W.partitionBy("tree"))  # a row per column
    per = gains.select("feature", share.alias("share")).groupBy("feature").agg(
        F.sum("share").alias("total"), F.sum(F.col("share") * F.col("share")).alias("squares"))
    names = model.nodes.sparkSession.createDataFrame(list(enumerate(model.coder.names)), "feature int, name string")
    mean = F.coalesce("total", F.lit(0.0)) / model.trees
    spread = F.sqrt(F.greatest(F.coalesce("squares", F.lit(0.0)) / model.trees - mean * mean, F.lit(0.0)))
    return names.join(per, "feature", "left").select(F.col("name").alias("feature"), mean.alias("importance_mean"), spread.alias("importance_std"))
