"""Operator 1: token ids as range-coded binary blocks.

``write_tokens`` sorts documents by doc_id, encodes their whole texts, counts all ids, and writes blocks coded
with one frequency table (``rans``). ``read_tokens`` decodes them. The dataset is a folder with ``blocks`` (Parquet
rows by part, in ascending doc_id order by part and local_start, each with a self-describing payload), ``frequencies``
and ``parts`` (ids of each part). Payloads travel in Parquet so that any store that Spark writes can hold them.

Cases: a null or empty text is its end id alone; null doc_ids come first; rows of equal doc_id are kept, each with its
own start; a text longer than a block is cut into several; an empty table gives empty files; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm import rans
from veloframe.llm.common import byte_column, release, scratch, staged, steps
from veloframe.llm.tokens import STEP_BYTES, default_vocabulary, encoder

#: Blocks that are coded side by side.
GROUP = 128


def token_rows(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (part, local_start, doc_id, n_tokens, ids), with the end id; starts count within the task."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    tool = encoder(vocabulary)
    for batch in batches:
        _, offsets = byte_column(batch.column("text"))
        for lo, hi in steps(offsets, STEP_BYTES):
            ids, cuts = tool.encode_column(batch.column("text").slice(lo, hi - lo), end_id)
            n = np.diff(cuts)
            raw = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((cuts * tool.kind.itemsize).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, part, np.int32)), pa.array(at + np.cumsum(n) - n), batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), pa.array(n), raw],
                ["part", "local_start", "doc_id", "n_tokens", "ids"],
            )
            at += int(n.sum())


TOKEN_SCHEMA = "part int, local_start long, doc_id long, n_tokens long, ids binary"


def id_counts(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    tool = encoder(vocabulary)
    total = np.zeros(tool.size, np.int64)
    for batch in batches:
        data, _ = byte_column(batch.column("ids"))
        total += np.bincount(data.view(tool.kind), minlength=tool.size)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])


def coded(batches: Iterator[pa.RecordBatch], counts: np.ndarray, vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Token rows, in order within a task, to blocks; a block breaks where the rows do not follow one another."""
    table, kind = rans.Table(counts), encoder(vocabulary).kind
    blocks: list[tuple] = []  # (part, local_start, ids, [(doc_id, document's start, offset in it, n)])
    open_ids: list[np.ndarray] = []
    docs: list[tuple] = []
    here, size = (None, 0), 0

    def close() -> None:
        nonlocal open_ids, docs, size, here
        if size:
            blocks.append((here[0], here[1], np.concatenate(open_ids), docs))
        here, open_ids, docs, size = (here[0], here[1] + size), [], [], 0

    def flush() -> pa.RecordBatch:
        payloads = rans.encode([b[2] for b in blocks], table)
        out = pa.RecordBatch.from_pydict({
            "local_start": [b[1] for b in blocks], "n_tokens": [len(b[2]) for b in blocks],
            "documents": [[{"doc_id": d, "start": s, "skipped": k, "n": n} for d, s, k, n in b[3]] for b in blocks],
            "payload": payloads, "part": [b[0] for b in blocks],
        }, schema=BLOCK_ARROW)
        blocks.clear()
        return out

    for batch in batches:
        data, offsets = byte_column(batch.column("ids"))
        data = data.view(kind)
        cuts = offsets // kind.itemsize
        for i, (part, start, doc_id) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "local_start", "doc_id")), strict=True)):
            if (part, start) != (here[0], here[1] + size):
                close()
                here = (part, start)
            ids, skipped = data[cuts[i] : cuts[i + 1]], 0
            while skipped < len(ids):
                piece = ids[skipped : skipped + rans.BLOCK - size]
                open_ids.append(piece)
                docs.append((doc_id, start, skipped, len(piece)))
                size += len(piece)
                skipped += len(piece)
                if size == rans.BLOCK:
                    close()
                    if len(blocks) == GROUP:
                        yield flush()
    close()
    if blocks:
        yield flush()


BLOCK_ARROW = pa.schema([("local_start", pa.int64()), ("n_tokens", pa.int64()), ("documents", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("skipped", pa.int64()), ("n", pa.int64())]))), ("payload", pa.binary()), ("part", pa.int32())])
BLOCK_SCHEMA = "local_start long, n_tokens long, documents array<struct<doc_id:long,start:long,skipped:long,n:long>>, payload binary, part int"


@dataclass(frozen=True)
class TokenFiles:
    path: str
    vocabulary: str


def write_tokens(docs: DataFrame, path: str | None = None, vocabulary: str | None = None, end_id: int = 2) -> TokenFiles:
    """Encode ``docs`` (doc_id, text) into the dataset at ``path`` (default: a scratch folder)."""
    spark = docs.sparkSession
    vocabulary, path = vocabulary or default_vocabulary(), path or scratch(spark, "tokens")
    keys = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = docs.select("doc_id", "text").withColumns({"_a": keys[1], "_b": keys[2]}).repartitionByRange("doc_id", "_a", "_b").sortWithinPartitions("doc_id", "_a", "_b").select("doc_id", "text")
    rows = staged(ordered.mapInArrow(lambda b: token_rows(b, vocabulary, end_id), TOKEN_SCHEMA), "ids")
    release(spark)
    # One row for each id of the vocabulary at most, and one for each part.
    frequencies = rows.select("ids").mapInArrow(lambda b: id_counts(b, vocabulary), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(encoder(vocabulary).size, np.int64)
    for row in frequencies.collect():
        counts[row.id] = row.n
    rows.mapInArrow(lambda b: coded(b, counts, vocabulary), BLOCK_SCHEMA).write.option("compression", "uncompressed").partitionBy("part").parquet(f"{path}/blocks")
    release(spark, rows)
    spark.createDataFrame([(int(i), int(counts[i])) for i in np.flatnonzero(counts)], "id int, n long").coalesce(1).write.parquet(f"{path}/frequencies")
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    blocks.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).coalesce(1).write.parquet(f"{path}/parts")
    return TokenFiles(path, vocabulary)


def decoded(batches: Iterator[pa.RecordBatch], counts: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Blocks to pieces of documents: (part, doc_id, start, skipped, n, crc32 and ids as little-endian u32)."""
    table = rans.Table(counts)
    for batch in batches:
        for lo in range(0, batch.num_rows, GROUP):
            rows = batch.slice(lo, GROUP).to_pylist()
            out = []
            for row, ids in zip(rows, rans.decode([r["payload"] for r in rows], table), strict=True):
                raw, at = ids.astype("<u4").tobytes(), 0
                for d in row["documents"]:
                    own = raw[4 * at : 4 * (at + d["n"])]
                    out.append((row["part"], d["doc_id"], d["start"], d["skipped"], d["n"], zlib.crc32(own), own if with_ids else None))
                    at += d["n"]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["part", "doc_id", "local_start", "skipped", "n", "crc", "ids"])


def read_tokens(spark: SparkSession, files: TokenFiles, with_ids: bool = True) -> DataFrame:
    """Pieces of documents from the blocks: doc_id, start (ids of all documents before its own), skipped (its own ids before the
    piece), n, crc (of the ids as little-endian u32) and ids (null unless ``with_ids``)."""
    counts = np.zeros(encoder(files.vocabulary).size, np.int64)
    for row in spark.read.schema("id int, n long").parquet(f"{files.path}/frequencies").collect():
        counts[row.id] = row.n
    bases, at = [], 0
    for row in sorted(spark.read.schema("part int, n_tokens long").parquet(f"{files.path}/parts").collect()):
        bases.append((row.part, at))
        at += row.n_tokens
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{files.path}/blocks")
    pieces = blocks.mapInArrow(lambda b: decoded(b, counts, with_ids), "part int, doc_id long, local_start long, skipped long, n long, crc long, ids binary")
    first = spark.createDataFrame(bases, "part int, base long")
    return pieces.join(F.broadcast(first), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "skipped", "n", "crc", "ids")


def digests(pieces: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document; a document is known by its start."""
    piece = F.struct("skipped", "crc", "n")
    documents = pieces.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(piece)).alias("pieces"))

    @F.pandas_udf("long")
    def joined(pieces):
        return pieces.map(lambda x: rans.crc_joined([(p["crc"], 4 * p["n"]) for p in x]))

    several = F.size("pieces") > 1
    single = documents.filter(~several).select("doc_id", "start", "n_tokens", F.col("pieces")[0]["crc"].alias("ids_crc32"))
    return single.union(documents.filter(several).select("doc_id", "start", "n_tokens", joined("pieces")))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_tokens(spark, write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet")), with_ids=False))
