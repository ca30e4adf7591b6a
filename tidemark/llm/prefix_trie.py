"""The trie of all conversations' prefixes, built by cutting sequences at half their depth, again and again.

A node is a distinct sequence of first d turns (role and text). It goes by (name, d), its name being the smallest conversation
that starts with it: at one depth, conversations with different prefixes have different smallest members.

*Build.* A problem is a trie below a named node, 2^j turns deep at most, given by its distinct sequences. It is cut at half its
depth: sequences that reach the cut are grouped by their upper half, and the smallest conversation of a group names the cut
node. The upper trie has one sequence a cut node, and those that end above; the forest of lower tries, one below each
cut node, has what is left of the sequences. All problems of one size are rows of one table, so upper and lower ones are cut in
the same job, and a trie of depth D takes log2 D jobs. A half is compared by one 128-bit digest, made beforehand
for every aligned block of 2^j turns from the digests of its halves. Conversations that are equal from end to end are
one sequence with a weight from the start. So a table of size 2^j has a row per distinct piece, and all tables
together are a small multiple of the turns.

*Graft.* Sums within the tries of size 1 are those of a node's children. A problem's sum below its top is that of its upper trie
and those of the lower tries grafted to the cut nodes: one job a size, from small to large. A node at an odd multiple of 2^j
has below it what lies within 2^j turns, and what lies below the nodes at that depth, which are multiples of 2^(j+1)
and known before: one job a size, from large to small.

Names, weights and sums come from grouped aggregates that combine before the shuffle and from equi-joins, so a first turn
that a third of all conversations share is no hot task; a conversation of any length is rows and never one value.

Turns are ordered by turn (null first); turns with equal numbers by role, then by text, in the order of their bytes. A null role
or text is an empty one. Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their own.
Extra columns are not looked at. An empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import checkpointed, scratch_path, settled

_SPAN = 6  # blocks of up to 2^6 turns are digested in one go
_CHUNK = 12  # ids that agree but for the last 12 bits are joined at a time
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _settled_by(df: DataFrame, column: str) -> DataFrame:
    """As ``settled``, with a folder a value of a column."""
    path = scratch_path(df.sparkSession, "settled-by")
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _token(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``c, at (from 1), size, token, bytes``: every turn at its place; ``size`` is the number of turns of the conversation.

    A conversation may hold most rows: turns are sorted by ranges over all conversations and numbered through, and a
    conversation's first number is taken off.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), role.alias("r"), text.alias("x"))
    in_order = turns.orderBy("c", F.col("t").asc_nulls_first(), "r", "x")
    rows = checkpointed(in_order.select("c", _token(F.col("r"), F.col("x")).alias("token"), F.octet_length("x").cast("long").alias("bytes")))
    rows = rows.withColumn("mid", F.monotonically_increasing_id()).withColumn("part", F.shiftright("mid", 33))
    runs = settled(rows.groupBy("c", "part").agg(F.min("mid").alias("low"), F.count("*").alias("n")))
    # a run of a conversation per partition of the sorted copy: few rows, however long the conversation
    own = W.partitionBy("c")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("c", "part", "low", before.alias("before"), F.sum("n").over(own).alias("size"))
    return rows.join(runs, ["c", "part"]).select(
        "c", (F.col("mid") - F.col("low") + F.col("before") + 1).alias("at"), "size", "token", "bytes")


def rebuilt(turns: DataFrame, blocks: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns ``c, at, token, bytes`` and conversations ``c, size``, each rebuilt on the head of its block's first conversation.

    Conversation c takes the first h = crc32(c) % ``most`` turns of c - c % ``blocks`` and its own turns after its first h.
    """
    # a head is less than ``most`` turns, and is passed on to fewer than 2 * ``blocks`` conversations
    sizes = settled(turns.groupBy("c").agg(F.max("size").alias("own")))
    base = (F.col("c") - F.col("c") % blocks).alias("base")
    asked = (F.crc32(F.col("c").cast("string").cast("binary")) % most).alias("h")
    of_base = sizes.select(F.col("c").alias("base"), F.col("own").alias("base_size"))
    plan = sizes.select("c", "own", base, asked).join(of_base, "base", "left").withColumn(
        "head", F.least("h", F.coalesce("base_size", F.lit(0))))
    plan = settled(plan.withColumn("size", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    tails = turns.select("c", "at", "token", "bytes").join(plan.select("c", "h", "head"), "c").where("at > h").select(
        "c", (F.col("at") - F.col("h") + F.col("head")).alias("at"), "token", "bytes")
    heads = turns.where((F.col("at") < most) & (F.col("c") % blocks == 0)).select(F.col("c").alias("base"), "at", "token", "bytes")
    heads = heads.join(plan.select("base", "c", "head"), "base").where("at <= head").select("c", "at", "token", "bytes")
    return tails.unionAll(heads), plan.select("c", "size")


def _paired(digests: Column) -> Column:
    """The digests of every two neighbours, as far as there are two."""
    return F.when(F.size(digests) >= 2, F.transform(
        F.sequence(F.lit(1), F.floor(F.size(digests) / 2).cast("int")),
        lambda i: F.unhex(F.md5(F.concat(F.element_at(digests, 2 * i - 1), F.element_at(digests, 2 * i)))))).otherwise(
        F.array().cast("array<binary>"))


def block_digests(turns: DataFrame, levels: int) -> DataFrame:
    """``j, c, i, digest`` of every whole block of 2^j turns, j < levels; block i has the turns from i 2^j + 1 on."""
    row = turns.select("c", (F.col("at") - 1).alias("i"), F.col("token").alias("digest"))
    done, low, made = None, 0, []
    while low < levels:
        groups = row.groupBy("c", F.shiftright("i", _SPAN).alias("g")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"]).alias("d0"))
        for j in range(_SPAN):
            groups = groups.withColumn(f"d{j + 1}", _paired(F.col(f"d{j}")))
        up = settled(groups)
        top = min(_SPAN, levels - low)
        for j in range(top):
            made.append(up.select(F.lit(low + j).alias("j"), "c", F.posexplode(f"d{j}").alias("p", "digest"), "g").select(
                "j", "c", (F.shiftleft("g", _SPAN - j) + F.col("p")).alias("i"), "digest"))
        row = up.select("c", F.col("g").alias("i"), F.explode(f"d{_SPAN}").alias("digest"))
        low += _SPAN
    for level in made:
        done = level if done is None else done.unionAll(level)
    return _settled_by(done, "j")


def sequences(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct whole sequences ``c (smallest member), size, n (members)``, and ``member, c`` of every conversation."""
    place = F.xxhash64("at", "token"), F.xxhash64("token", "at", F.lit("other"))
    marks = turns.groupBy("c").agg(F.bit_xor(place[0]).alias("a"), F.bit_xor(place[1]).alias("b"))
    whole = settled(sizes.join(marks, "c", "left").select("c", "size", *[F.coalesce(m, F.lit(0)).alias(m) for m in "ab"]))
    distinct = settled(whole.groupBy("size", "a", "b").agg(F.min("c").alias("first"), F.count("*").alias("n")))
    members = whole.join(distinct, ["size", "a", "b"]).select(F.col("c").alias("member"), F.col("first").alias("c"))
    return distinct.select(F.col("first").alias("c"), "size", "n"), members


def cut_all(pieces: DataFrame, digests: DataFrame, levels: int) -> list[DataFrame]:
    """Tables by j of pieces ``c, k, top, n, size``: turns k 2^j + 1 ... of c, the first of ``n`` conversations, below node ``top``.

    ``size`` is the number of turns of the piece. Size 0 says that the sequence of c ends at ``top``.
    """
    tables = [pieces]
    for j in reversed(range(levels)):
        half = 1 << j
        whole = tables[0].where("size > 0").withColumn("i", 2 * F.col("k"))
        at_cut = digests.where(F.col("j") == j).select("c", "i", "digest")
        passing = whole.where(F.col("size") >= half).join(at_cut, ["c", "i"])
        named = passing.groupBy("top", "i", "digest").agg(F.min("c").alias("name"), F.sum("n").alias("n"))
        upper = named.select(F.col("name").alias("c"), F.col("i").alias("k"), "top", "n", F.lit(half).cast("long").alias("size"))
        above = whole.where(F.col("size") < half).select("c", F.col("i").alias("k"), "top", "n", "size")
        lower = passing.join(named.drop("n"), ["top", "i", "digest"]).select(
            "c", (F.col("i") + 1).alias("k"), F.col("name").alias("top"), "n", (F.col("size") - half).alias("size"))
        tables.insert(0, settled(upper.unionAll(above).unionAll(lower)))
    return tables


_SUMS = ("leaves", "saved")


def _sums(df: DataFrame, *by) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(s).alias(s) for s in _SUMS])


def graft(nodes: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``c, depth, leaves, saved`` summed over what is below each node that has children. ``nodes``: c, depth, parent, leaves, saved."""
    levels = len(tables) - 1
    below = [settled(_sums(nodes.where("depth > 0").select(F.col("parent").alias("c"), (F.col("depth") - 1).alias("k"), *_SUMS), "c", "k"))]
    for j in range(levels):
        cut = tables[j].where((F.col("k") % 2 == 0) & (F.col("size") == 1 << j)).select("c", (F.col("k") + 1).alias("k"), "top")
        joined = below[j].join(cut, ["c", "k"], "left").select(F.coalesce("top", "c").alias("c"), F.shiftright("k", 1).alias("k"), *_SUMS)
        below.append(settled(_sums(joined, "c", "k")))
    known = below[levels].select("c", F.lit(0).cast("long").alias("depth"), *_SUMS)
    for j in reversed(range(levels)):
        reach = tables[j].where((F.col("k") % 2 == 1) & (F.col("size") == 1 << j)).select(
            "c", F.shiftleft(F.col("k") + 1, j).alias("depth"), "top", "k")
        further = known.join(reach, ["c", "depth"]).select(F.col("top").alias("c"), "k", *_SUMS)
        total = _sums(below[j].where(F.col("k") % 2 == 1).unionAll(further), "c", "k")
        known = known.unionAll(settled(total.select("c", F.shiftleft("k", j).alias("depth"), *_SUMS)))
    return known


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``c, ids`` in order of c to the digest of each c's joined ids, of which a row at a time is held."""
    now, state = None, None

    def out(cs, digests):
        return pa.RecordBatch.from_arrays([pa.array(cs, pa.int64()), pa.array(digests, pa.string())], ["c", "ends_sha256"])

    for batch in batches:
        cs, digests = [], []
        for c, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if c == now:
                state.update(b",")
            else:
                if state is not None:
                    cs.append(now), digests.append(state.hexdigest())
                now, state = c, hashlib.sha256()
            state.update(ids.encode())
        yield out(cs, digests)
    yield out([now] if state else [], [state.hexdigest()] if state else [])


def member_digests(members: DataFrame) -> DataFrame:
    """``c, ends_sha256`` of the ids of the members of each sequence: decimal, in numeric order, joined by commas.

    Ids are distinct, so at most 4,096 of them share all but their last bits; these are joined first, and the
    digest runs over the joined rows in order, so a group of any size passes through a task without being held.
    """
    chunk = F.shiftright("member", _CHUNK)
    joined = members.groupBy("c", chunk.alias("g")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    return joined.repartition("c").sortWithinPartitions("c", "g").select("c", "ids").mapInArrow(_hashed, "c long, ends_sha256 string")


def prefix_nodes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given by turns ``c, at, token, bytes`` and sizes ``c, size``.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    turns = settled(turns)
    whole, members = sequences(turns, sizes)
    deepest, = whole.agg(F.max("size")).first()
    levels = max(int(deepest or 0).bit_length(), 1)  # 2^levels is more than any depth
    turns = settled(turns.join(whole.select("c"), "c", "left_semi"))  # of a conversation that occurs twice, once
    root = whole.agg(F.min("c").alias("c"), F.sum("n").alias("n")).where("c is not null")
    start = whole.select("c", F.lit(0).cast("long").alias("k"), root.select("c").scalar().alias("top"), "n", "size")
    tables = cut_all(settled(start), block_digests(turns, levels), levels)

    deep = tables[0].where("size > 0").select("c", (F.col("k") + 1).alias("depth"), F.col("top").alias("parent"), "n")
    children = deep.groupBy(F.col("parent").alias("c"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("children"))
    every = deep.unionAll(root.select("c", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), "n"))
    last = turns.select("c", F.col("at").alias("depth"), "bytes")
    children_of, bytes_of = F.coalesce("children", F.lit(0)), F.coalesce("bytes", F.lit(0))
    nodes = settled(every.join(children, ["c", "depth"], "left").join(last, ["c", "depth"], "left").select(
        "c", "depth", "parent", "n", children_of.alias("children"), (children_of == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * bytes_of).alias("saved")))

    ends = tables[-1].where("size = 0").select("c", F.col("top").alias("node"), F.lit(0).cast("long").alias("depth"))
    for j, table in enumerate(tables[:-1]):
        ends = ends.unionAll(table.where("size = 0").select("c", F.col("top").alias("node"), F.shiftleft("k", j).alias("depth")))
    digests = member_digests(members).join(ends, "c").select(F.col("node").alias("c"), "depth", "ends_sha256")
    sums = graft(nodes, tables).select("c", "depth", *[F.col(s).alias(f"{s}_below") for s in _SUMS])
    n_leaves, saved = (F.col(s) + F.coalesce(f"{s}_below", F.lit(0)) for s in _SUMS)
    return nodes.join(sums, ["c", "depth"], "left").join(digests, ["c", "depth"], "left").select(
        F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), n_leaves.alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, blocks: int = 5, most: int = 9) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text), rebuilt on shared heads as ``rebuilt`` says."""
    return prefix_nodes(*rebuilt(settled(ordered_turns(conversations)), blocks, most))
