"""Token files: the ids of many texts one behind the other, with Elias-Fano coded text boundaries.

A file holds a run of rows in ascending ``doc_id`` order: a header, the code of the boundaries, the code of the
``doc_id`` values, then the ids as little-endian integers of two or four bytes. The k-th text is read by two ``select``
calls and one read, without a table of 64-bit offsets. An index frame with one row per file says where its first
id lies among all ids; it is the only thing beside the files.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.llm import elias_fano, files, words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.llm.tokens import Encoder, byte_runs, gathered
from tallywise.session import scratch_path, stored

MAGIC = b"EFTK1\0"
HEAD = "<6sBxQQQQ"  # magic, bytes per id, texts, texts without doc_id, bytes of the boundaries' code, of the doc_ids' code
SIGN = np.uint64(1 << 63)
INDEX = "part long, seq long, path string, n_texts long, n_tokens long"


class Writer:
    """Gathers texts of one file; memory is bounded by the file's size and one text."""

    def __init__(self):
        self.doc_ids: list = []
        self.sizes: list[int] = []
        self.ids: list[np.ndarray] = []
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.ids.append(ids)
        self.tokens += len(ids)

    def write(self, path: str, width: int) -> None:
        ends = np.concatenate(([0], np.cumsum(self.sizes)))
        known = np.array([d for d in self.doc_ids if d is not None], np.int64).view(np.uint64) ^ SIGN
        bounds, docs = elias_fano.encoded(ends), elias_fano.encoded(known)
        kind = "<u2" if width == 2 else "<u4"
        with files.opened(path, "wb") as out:
            out.write(struct.pack(HEAD, MAGIC, width, len(self.sizes), len(self.sizes) - len(known), len(bounds), len(docs)))
            out.write(bounds)
            out.write(docs)
            for ids in self.ids:
                out.write(ids.astype(kind).tobytes())


class Reader:
    """Random access to the texts of one file."""

    def __init__(self, path: str):
        self.file = files.opened(path, "rb")
        magic, self.width, self.n, self.nulls, bounds, docs = struct.unpack(HEAD, self.file.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.bounds = elias_fano.Reader(self.file.read(bounds))
        known = elias_fano.Reader(self.file.read(docs)).all() ^ SIGN
        self.doc_ids = [None] * self.nulls + known.view(np.int64).tolist()
        self.base = struct.calcsize(HEAD) + bounds + docs

    def start(self, k: int) -> int:
        return self.bounds.select(k)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th text."""
        lo, hi = self.bounds.select(k), self.bounds.select(k + 1)
        return self.span(lo, hi)

    def span(self, lo: int, hi: int) -> np.ndarray:
        self.file.seek(self.base + lo * self.width)
        raw = self.file.read((hi - lo) * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype(np.uint32)

    def close(self) -> None:
        self.file.close()


def _write(folder: str, vocabulary: str, end_id: int, file_tokens: int):
    def run(batches):
        encoder = Encoder(vocabulary)
        width = 2 if max(encoder.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        task, seq, open_file = TaskContext.get().partitionId(), 0, Writer()

        def closed():
            path = files.fresh(folder, ".eftk")
            open_file.write(path, width)
            return pa.RecordBatch.from_pydict({"part": [task], "seq": [seq], "path": [path], "n_texts": [len(open_file.sizes)], "n_tokens": [open_file.tokens]})

        for batch in gathered(batches, 2 * words.BLOCK):
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in byte_runs(batch.column(1), 8 * words.BLOCK):
                ids, at = encoder.encode(batch.column(1).slice(lo, hi - lo))
                for i in range(hi - lo):
                    open_file.add(doc_ids[lo + i], np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)))
                    if open_file.tokens >= file_tokens:
                        yield closed()
                        seq, open_file = seq + 1, Writer()
        if open_file.sizes:
            yield closed()

    return run


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, file_tokens: int = 1 << 22) -> DataFrame:
    """Encode ``text`` and write token files in ascending ``doc_id`` order; returns their index.

    ``part``, ``seq``, ``path``, ``n_texts``, ``n_tokens``, ``start`` (ids in all files before). Each text is followed
    by ``end_id``. A null text is empty. Null ``doc_id`` values come first; rows that repeat a ``doc_id`` are ordered by
    a hash of their text and may lie in neighbouring files. Other columns are ignored; an empty table writes no file.
    ``file_tokens`` closes a file once it holds so many ids, so a file is bounded by that and one text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = files.as_uri(scratch_path(spark, "token-files"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    index = stored(rows.mapInArrow(trimmed(_write(folder, vocabulary, end_id, file_tokens)), INDEX), "token-index")
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("t")).orderBy("part").collect()  # one row per task
    before, total = [], 0
    for row in sums:
        before.append((row["part"], total))
        total += row["t"]
    base = spark.createDataFrame(before, "part long, base long")
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return stored(inside.join(base, "part").selectExpr("part", "seq", "path", "n_texts", "n_tokens", "base + inside start"), "token-index")


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = Reader(path)
            rows, lo = [], reader.start(0) if reader.n else 0
            for k in range(reader.n):
                hi = reader.start(k + 1)  # where the next text begins
                rows.append((start + lo, hi - lo, zlib.crc32(reader.span(lo, hi).astype("<u4").tobytes())))
                lo = hi
            reader.close()
            found = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reader.doc_ids, pa.int64()), *[pa.array(found[:, j]) for j in range(3)]], ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_files(index: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every text, from the files of an index."""
    paths = index.select("path", "start").repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return paths.mapInArrow(trimmed(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")
