"""Operator 2: pack documents into sequences by first-fit decreasing in randomised groups.

A document's ids, with the end id, are cut into pieces of at most ``capacity``. Pieces go to groups by a hash of what they are
(about ``group_pieces`` in each, whatever the size of the corpus; pieces that agree in all are told apart by their number in the task), so a task
that runs again deals them as before, in whatever order its rows come. Each group is packed by itself: pieces by descending
length, each into the first bin with room, which a tournament tree over the bins' free room finds in logarithmic time.

Cases: a null or empty text is its end id alone; equal doc_ids and repeated rows are packed each for itself; a text of any
length is cut; an empty table gives no sequences; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import byte_column, mixed, steps
from veloframe.llm.tokens import STEP_BYTES, default_vocabulary, encoder

PIECE = "struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>"


class Bins:
    """First fit over equal bins; the tree's nodes hold the most free room below them."""

    def __init__(self, n: int, capacity: int):
        self.width = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.width)

    def put(self, size: int) -> int:
        room, i = self.room, 1
        while i < self.width:
            i *= 2
            if room[i] < size:
                i += 1
        out = i - self.width
        room[i] -= size
        i //= 2
        while i:
            room[i] = max(room[2 * i], room[2 * i + 1])
            i //= 2
        return out


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece; bins count from 0."""
    out = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths >= capacity).sum())
    out[order[:full]] = np.arange(full)
    bins = Bins(max(1, len(lengths) - full), capacity)
    for i in order[full:].tolist():
        out[i] = full + bins.put(int(lengths[i]))
    return out


def cut(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int, groups: int, seed: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    salt, met = np.uint64(seed * 0x9E3779B9 + TaskContext.get().partitionId()), {}
    tool = encoder(vocabulary)
    width, end = tool.kind.itemsize, np.array([end_id], tool.kind).tobytes()
    for batch in batches:
        _, offsets = byte_column(batch.column("text"))
        doc_ids = batch.column("doc_id").cast(pa.int64())
        for lo, hi in steps(offsets, STEP_BYTES):
            ids = [x + end for x in tool.encode(batch.column("text").slice(lo, hi - lo).to_pylist())]
            rows = [(i, at // width, len(x) // width, x[at : at + capacity * width]) for i, x in enumerate(ids) for at in range(0, len(x), capacity * width)]
            which, start, total, raw = (list(c) for c in zip(*rows, strict=True))
            length = np.array([len(x) // width for x in raw], np.int64)
            own = doc_ids.slice(lo, hi - lo).take(pa.array(which))
            what = mixed(own.fill_null(-1).to_numpy().view(np.uint64) + mixed(np.array(start, np.uint64)) + mixed(np.array([zlib.crc32(x) for x in raw], np.uint64)))
            nth = []
            for h in what.tolist():
                met[h] = met.get(h, -1) + 1
                nth.append(met[h])
            group = (mixed(what * np.uint64(3) + mixed(np.array(nth, np.uint64) + salt)) % np.uint64(groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), own, pa.array(start, pa.int64()), pa.array(length), pa.array(total, pa.int64()), pa.array(raw, pa.binary())],
                ["group", "doc_id", "start", "length", "doc_tokens", "ids"],
            )


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, capacity: int = 2048, group_pieces: int = 2048, seed: int = 11) -> DataFrame:
    """Sequences of ``docs`` (doc_id, text): sequence_id long, n_tokens long, ids binary (little-endian u32), pieces in order."""
    vocabulary = vocabulary or default_vocabulary()
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    groups = max(1, round((size.n + size.b / 3 / capacity) / group_pieces))
    pieces = docs.select("doc_id", "text").mapInArrow(lambda b: cut(b, vocabulary, end_id, capacity, groups, seed), "group long, doc_id long, start long, length long, doc_tokens long, ids binary")
    kind = encoder(vocabulary).kind

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        bins = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        order = np.argsort(bins, kind="stable")
        table, bins = table.take(pa.array(order)), bins[order]
        data, offsets = byte_column(table.column("ids"))
        wide = data.view(kind).astype("<u4")
        firsts = np.flatnonzero(np.diff(bins, prepend=-1))
        cuts = np.append(firsts, len(bins))
        at = offsets // kind.itemsize
        ends = at[cuts]
        del data
        found = table.select(["doc_id", "start", "length", "doc_tokens"]).combine_chunks()
        del table
        found = found.append_column("offset", pa.array(at[:-1] - np.repeat(at[firsts], np.diff(cuts))))
        structs = pa.StructArray.from_arrays([found.column(c).combine_chunks() for c in found.column_names], names=found.column_names)
        return pa.table({
            "sequence_id": pa.array((group << 32) + bins[firsts]), "n_tokens": pa.array(np.diff(ends)),
            "ids": pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(wide)]),  # the widened ids themselves, without a copy
            "pieces": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), structs),
        })

    return pieces.groupBy("group").applyInArrow(pack, f"sequence_id long, n_tokens long, ids binary, pieces array<{PIECE}>")


def digests(sequences: DataFrame) -> DataFrame:
    """A row for each piece: where it lies and the crc32 of its ids."""
    placed = sequences.select("sequence_id", "ids", F.explode("pieces").alias("piece"))
    own = F.expr("substring(ids, cast(4 * piece.offset + 1 as int), cast(4 * piece.length as int))")
    return placed.select("piece.doc_id", "piece.start", "piece.length", F.crc32(own).alias("ids_crc32"), "piece.doc_tokens", "sequence_id", "piece.offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")))
