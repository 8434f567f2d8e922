"""Operator 3: shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual_nodes`` points on a ring of 64-bit hashes. A document stands at the hash of its text, so copies stand
together, and belongs to the next point clockwise. A shard's room is its equal share of rows (shares differ by one at most).
Documents that stand nearest before a shard's own points keep it; what finds its shard full goes on clockwise to the next
point whose shard has room. Order on the ring is by (hash, doc_id, row), so every document's place is a position in
one global order: two narrow passes count rows for each part and arc, the driver deals intervals of that order to shards
(their number is bounded by points and parts, not by rows), and a last narrow pass looks them up. A text that a third of all rows
share is therefore dealt out like any other interval.

Cases: null texts count 0 bytes and stand together; equal doc_ids and repeated rows are told apart by their place in the input; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import staged


def points(shards: int, virtual_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ring points and the shard that owns each."""
    at = [int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "little", signed=True) for s in range(shards) for v in range(virtual_nodes)]
    owner = np.repeat(np.arange(shards), virtual_nodes)
    order = np.argsort(np.array(at, np.int64), kind="stable")
    return np.array(at, np.int64)[order], owner[order]


def deal(loads: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """Intervals (from, to, shard, slot of the first) of the ring's global order. Arc i's rows belong to owner[i]."""
    total, begins = int(loads.sum()), np.concatenate([[0], np.cumsum(loads)]).astype(np.int64)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slot = [0] * shards
    out: list[tuple[int, int, int, int]] = []

    def give(s: int, lo: int, n: int) -> None:
        out.append((lo, lo + n, s, slot[s]))
        slot[s] += n
        room[s] -= n

    rest: list[tuple[int, int]] = []
    for i, s in enumerate(owner.tolist()):
        if n := min(int(loads[i]), room[s]):
            give(s, int(begins[i]), n)
        rest.append((int(begins[i]) + n, int(begins[i + 1])))
    waiting: deque[tuple[int, int]] = deque()
    for turn in range(2):
        for i, s in enumerate(owner.tolist()):
            if turn == 0 and rest[i][0] < rest[i][1]:
                waiting.append(rest[i])
            while waiting and room[s]:
                lo, hi = waiting.popleft()
                n = min(hi - lo, room[s])
                give(s, lo, n)
                if lo + n < hi:
                    waiting.appendleft((lo + n, hi))
    return sorted(out)


def shard_documents(docs: DataFrame, shards: int = 24, virtual_nodes: int = 128) -> DataFrame:
    """doc_id, size (UTF-8 bytes of text plus 8), text_crc32, shard, slot (gapless from 0 in each shard) of ``docs`` (doc_id, text)."""
    ring, owner = points(shards, virtual_nodes)
    owner = np.append(owner, owner[0])  # behind the last point the ring begins again
    placed = docs.select(
        F.xxhash64("text").alias("at"), "doc_id", F.monotonically_increasing_id().alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = placed.repartitionByRange("at", "doc_id", "row").sortWithinPartitions("at", "doc_id", "row")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            arc = np.searchsorted(ring, b.column("at").to_numpy(), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(n, n + b.num_rows)), pa.array(arc), b.column("doc_id").cast(pa.int64()), b.column("size"), b.column("text_crc32")], ["part", "seq", "arc", "doc_id", "size", "text_crc32"])
            n += b.num_rows

    rows = staged(placed.mapInArrow(number, "part int, seq long, arc int, doc_id long, size long, text_crc32 long"), "ring")
    loads, sizes = np.zeros(len(owner), np.int64), {}
    for x in rows.groupBy("part", "arc").count().collect():
        loads[x["arc"]] += x["count"]
        sizes[x["part"]] = sizes.get(x["part"], 0) + x["count"]
    bases, n = {}, 0
    for part in sorted(sizes):
        bases[part], n = n, n + sizes[part]
    plan = np.array(deal(loads, owner, shards), np.int64).reshape(-1, 4)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = b.column("part").to_numpy()
            place = b.column("seq").to_numpy() + np.array([bases[p] for p in parts.tolist()], np.int64)
            own = plan[np.searchsorted(plan[:, 0], place, "right") - 1]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("size"), b.column("text_crc32"), pa.array(own[:, 2].astype(np.int32)), pa.array(own[:, 3] + place - own[:, 0])], ["doc_id", "size", "text_crc32", "shard", "slot"])

    return rows.mapInArrow(look_up, "doc_id long, size long, text_crc32 long, shard int, slot long")


def write_shards(docs: DataFrame, path: str, shards: int = 24, virtual_nodes: int = 128) -> None:
    """Write ``docs`` (with its columns) as Parquet, one folder a shard, rows by (doc_id, text checksum)."""
    plan = shard_documents(docs, shards, virtual_nodes)
    # Rows that agree in both keys are equal for the ring; the k-th of them takes the k-th place.
    k = "row_number() over (partition by doc_id, text_crc32 order by {})"
    mine = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).withColumn("_row", F.monotonically_increasing_id())
    left = mine.withColumn("_k", F.expr(k.format("_row"))).drop("_row").alias("l")
    right = plan.withColumn("_k", F.expr(k.format("shard, slot"))).select("doc_id", "text_crc32", "_k", "shard", "slot").alias("r")
    same = F.expr("l.doc_id <=> r.doc_id and l.text_crc32 = r.text_crc32 and l._k = r._k")
    left.join(right, same).select("l.*", "r.shard", "r.slot").drop("_k", "text_crc32").write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
