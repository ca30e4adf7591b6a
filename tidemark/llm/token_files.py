"""Token ids as flat binary files with 64-bit document offsets, read back through memory maps.

Documents are range-sorted by id; every task encodes its range and writes two files to the shared folder: ``.ids``, the
unsigned token ids one after another (16 bits where the vocabulary allows, else 32), and ``.idx``, for each document its
id and where its ids start, as 64-bit integers. One manifest row per range holds the counts; their prefix sums are the
ranges' places in the whole sequence. A file is written under a name of its own attempt and renamed when complete, so a
task that is run again or twice leaves the same files.

Nulls: a null text is an empty document (its end id only), a null id sorts first and is read back as null. Repeated rows
stay, in the order of id and text. An empty table gives an empty manifest and no documents.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.text import Texts, slices, word_hashes
from tidemark.session import settled

_NULL_ID = np.iinfo(np.int64).min
MANIFEST = "part int, ids_path string, idx_path string, dtype string, n_docs long, n_tokens long"


class WordEncoder:
    """Encodes words separated by white space; a tokenizer that never joins across white space encodes texts so.

    Encodings of words met before are kept, by hash, in tables of a fixed size: what comes later takes the place of what
    was there. The tables live as long as the broadcast object in a Python worker.
    """

    def __init__(self, tokenizer: str, slots: int = 1 << 19, pool: int = 1 << 22):
        self.tokenizer, self.slots, self.room = tokenizer, slots, pool
        self.ready = False

    def __getstate__(self):
        return {"tokenizer": self.tokenizer, "slots": self.slots, "room": self.room, "ready": False}

    def _start(self) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.tokenizer)
        self.library.encode_special_tokens = True
        # words of ASCII letters pass a lower-casing normalizer unchanged but for their case
        self.lowers = "Lowercase" in json.dumps(json.loads(self.tokenizer).get("normalizer"))
        self.simple = re.compile(r"([A-Za-z]+)([.,]?)") if self.lowers else re.compile(r"(?!)()")
        self.known: dict[str, list[int]] = {}
        self.marks = {m: self.library.encode(m, add_special_tokens=False).ids for m in (".", ",", "")}
        self.keys = np.zeros(self.slots, np.uint64)
        self.at, self.n = np.zeros(self.slots, np.int64), np.zeros(self.slots, np.int64)
        self.pool, self.size = np.zeros(self.room, np.uint32), 0
        self.ready = True

    def words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            m = self.simple.fullmatch(w)
            if not m:
                rest.append(i)
                continue
            core = m[1].lower()
            ids = self.known.get(core)
            if ids is None:
                if len(self.known) >= self.slots // 8:
                    self.known.clear()
                ids = self.known[core] = [x.id for x in self.library.model.tokenize(core)]
            out[i] = ids + self.marks[m[2]]
        if rest:
            for i, e in zip(rest, self.library.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts in one array, and how many each text has."""
        if not self.ready:
            self._start()
        h = word_hashes(t)
        h[h == 0] = 1
        slot = (h % np.uint64(self.slots)).astype(np.int64)
        at, n = self.at[slot], self.n[slot]
        missed = np.flatnonzero(self.keys[slot] != h)
        if len(missed):
            new, first, back = np.unique(h[missed], return_index=True, return_inverse=True)
            got = self.words([t.word(i).decode("utf-8", "replace") for i in missed[first]])
            count = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter((x for ids in got for x in ids), np.uint32, int(count.sum()))
            if self.size + len(ids) > len(self.pool):
                # what this slice took from the old pool is copied before the pool starts again
                hit = np.flatnonzero(self.keys[slot] == h)
                old = _gather(self.pool, at[hit], n[hit])
                at[hit] = np.cumsum(n[hit]) - n[hit]
                self.keys[:] = 0
                if len(old) + len(ids) > len(self.pool):
                    self.pool = np.zeros(len(old) + len(ids), np.uint32)
                self.pool[:len(old)], self.size = old, len(old)
            where = self.size + np.cumsum(count) - count
            self.pool[self.size:self.size + len(ids)] = ids
            self.size += len(ids)
            put = (new % np.uint64(self.slots)).astype(np.int64)
            self.keys[put], self.at[put], self.n[put] = new, where, count
            at[missed], n[missed] = where[back], count[back]
        ends = np.r_[0, np.cumsum(n)]
        return _gather(self.pool, at, n), np.diff(ends[t.words])


def _gather(pool: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    ends = np.cumsum(n)
    return pool[np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Encode ``doc_id, text`` and write the files under ``path``, in ascending order of id; returns the manifest.

    ``tokenizer``: the path of a tokenizers JSON file that splits at white space. ``end_id`` follows each document.
    """
    spark = docs.sparkSession
    encoder = WordEncoder(open(tokenizer, encoding="utf-8").read())
    from tokenizers import Tokenizer
    small = max(Tokenizer.from_str(encoder.tokenizer).get_vocab_size(), (end_id or 0) + 1) <= 1 << 16
    shared, dtype = spark.sparkContext.broadcast(encoder), "<u2" if small else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, folder = _store(path)
        store.create_dir(folder, recursive=True)
        own = f"{folder}/.{part}-{uuid.uuid4().hex}"
        names, starts, n_tokens = [], [], 0
        with store.open_output_stream(f"{own}.ids") as out:
            for batch in batches:
                texts = batch.column("text")
                ids_of = batch.column("doc_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
                for t in slices(texts):
                    ids, counts = shared.value.encode(t)
                    if end_id is not None:
                        ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                    out.write(ids.astype(dtype).tobytes())
                    names.append(ids_of[t.first:t.first + t.n].astype("<i8"))
                    starts.append(n_tokens + np.cumsum(counts) - counts)
                    n_tokens += int(counts.sum())
        if not names:
            store.delete_file(f"{own}.ids")
            return
        index = np.stack([np.concatenate(names), np.concatenate(starts).astype("<i8")], axis=1)
        with store.open_output_stream(f"{own}.idx") as out:
            out.write(index.tobytes())
        final = f"range-{part:07d}"
        for kind in ("ids", "idx"):
            store.move(f"{own}.{kind}", f"{folder}/{final}.{kind}")
        yield pa.RecordBatch.from_pylist([{
            "part": part, "ids_path": f"{path}/{final}.ids", "idx_path": f"{path}/{final}.idx", "dtype": dtype,
            "n_docs": len(index), "n_tokens": n_tokens}], schema=_MANIFEST)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).repartitionByRange("doc_id")
    manifest = settled(ordered.sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


_MANIFEST = pa.schema([("part", pa.int32()), ("ids_path", pa.string()), ("idx_path", pa.string()), ("dtype", pa.string()),
                       ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _mapped(path: str, dtype: str) -> np.ndarray:
    store, name = _store(path)
    if not store.get_file_info(name).size:
        return np.zeros(0, dtype)
    source = pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(name)
    return np.frombuffer(source.read_buffer() if hasattr(source, "read_buffer") else source.read(), dtype)


def fold_documents(spark: SparkSession, manifest: DataFrame, fold: Callable[[np.ndarray], object], kind: pa.DataType,
                   name: str, ddl: str) -> DataFrame:
    """Read the files and return ``doc_id, start, n_tokens`` and ``fold(ids)`` of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(row["ids_path"], row["dtype"])
                index = _mapped(row["idx_path"], "<i8").reshape(-1, 2)
                bounds = np.r_[index[:, 1], row["n_tokens"]]
                for low in range(0, len(index), 1000):
                    part = range(low, min(low + 1000, len(index)))
                    names = index[part.start:part.stop, 0]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names, mask=names == _NULL_ID), pa.array(row["base"] + bounds[part.start:part.stop]),
                        pa.array(np.diff(bounds[part.start:part.stop + 1])),
                        pa.array([fold(ids[bounds[i]:bounds[i + 1]]) for i in part], kind)], schema=schema)

    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(read, f"doc_id long, start long, n_tokens long, {name} {ddl}")


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The documents of the files: ``doc_id, start, n_tokens, ids`` (array of int)."""
    return fold_documents(spark, manifest, lambda ids: ids.tolist(), pa.list_(pa.int32()), "ids", "array<int>")
