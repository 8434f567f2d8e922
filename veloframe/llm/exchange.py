"""Which 64-bit values more than one document has: exact, by shuffles of packed lists whose memory does not depend on the input.

Documents are dealt to blocks by hash, values to ranges by their high bits. A task collects values in a buffer of ``BUFFER`` entries; when it
is full it is sorted in place by (range, block, value) and goes out as one row for each range, or, beyond ``FAN`` ranges, for each of
``FAN`` groups of neighbouring ranges. Such groups are dealt out once more by the same step, so a row always holds some hundred entries, however
many ranges and blocks there are. A range finds the values that occur more than once and answers to each block that has them (by the same
routing, the other way round), so only shared values travel back.

A value is compared by its range and the next 32 bits; values that agree in both count as shared, which only lets more through. A buffer sends a
value twice for a block at most. A value that a third of all documents have costs its range one entry of some bytes for each block and buffer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import release, staged

#: Entries of a buffer; groups that one step deals to; bytes of text for each range and block.
BUFFER, FAN, RANGE_BYTES, BLOCK_BYTES = 1 << 19, 1 << 10, 4e6, 8e6
ROW = "place long, raw binary"


def power(n: float) -> int:
    """The least power of two that is no less than n."""
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _planes(x: np.ndarray) -> bytes:
    """u32 as a plane for each byte, so that the shuffle's compression finds the empty ones."""
    return np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def ordered(place: np.ndarray, mark: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (u32 each) by place, mark and value; each at most twice."""
    if not len(place):
        return place, mark, value
    bits = int(mark.max()).bit_length()
    if int(place.max()).bit_length() + bits <= 32:
        key = (place.astype(np.uint64) << np.uint64(32 + bits)) | (mark.astype(np.uint64) << np.uint64(32))
        key |= value
        key.sort()
        key = key[np.append([True, True], key[2:] != key[:-2])[: len(key)]]
        value = key.astype(np.uint32)
        key >>= np.uint64(32)
        return (key >> np.uint64(bits)).astype(np.uint32), (key & np.uint64((1 << bits) - 1)).astype(np.uint32), value
    order = np.lexsort((value, mark, place))
    place, mark, value = place[order], mark[order], value[order]
    keep = np.ones(len(place), bool)
    keep[2:] = (place[2:] != place[:-2]) | (mark[2:] != mark[:-2]) | (value[2:] != value[:-2])
    return place[keep], mark[keep], value[keep]


def packed_rows(place: np.ndarray, mark: np.ndarray, value: np.ndarray, shift: int) -> pa.Table:
    """Ordered entries as one row for each group of 2**shift places: its cells (place, mark, size), then differences of values within each cell."""
    cell = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (mark[1:] != mark[:-1]))) if len(place) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(cell, len(place))).astype(np.uint32)
    steps = np.diff(value, prepend=np.uint32(0))
    steps[cell] = value[cell]
    place, mark = place[cell], mark[cell]
    group = place >> np.uint32(shift)
    edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(cell)) if len(cell) else np.zeros(1, np.int64)
    at = np.append(cell, len(steps))[edges]
    raws = [np.array([b - a, d - c], "<u4").tobytes() + _planes(place[a:b]) + _planes(mark[a:b]) + _planes(sizes[a:b]) + _planes(steps[c:d]) for a, b, c, d in zip(edges[:-1].tolist(), edges[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pa.table({"place": pa.array(group[edges[:-1]].astype(np.int64)), "raw": pa.array(raws, pa.binary())})


def unpacked(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of packed rows: place, mark, value."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for raw in map(memoryview, raws):
        cells, entries = np.frombuffer(raw, "<u4", 2).tolist()
        at = 8
        for part, n in zip(parts, (cells, cells, cells, entries), strict=True):
            part.append(_unplaned(raw[at : at + 4 * n]))
            at += 4 * n
    place, mark, sizes, steps = (np.concatenate([np.zeros(0, np.uint32), *p]) for p in parts)
    del parts
    value = np.cumsum(steps, dtype=np.uint32)
    first = np.cumsum(sizes, dtype=np.int64) - sizes
    value -= np.repeat(np.where(first > 0, value[np.maximum(first, 1) - 1], np.uint32(0)) if len(value) else sizes, sizes)
    return np.repeat(place, sizes), np.repeat(mark, sizes), value


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of groups, group after group, as rows of single places."""
    held, size = [], 0

    def sent() -> Iterator[pa.RecordBatch]:
        yield from packed_rows(*ordered(*unpacked(held)), 0).to_batches()

    for batch in batches:
        for raw in batch.column("raw").to_pylist():
            held.append(raw)
            size += int(np.frombuffer(raw, "<u4", 2)[1])
            if size >= BUFFER:
                yield from sent()
                held, size = [], 0
    if held:
        yield from sent()


def routed(rows: DataFrame, places: int) -> DataFrame:
    """Rows that ``packed_rows`` made with ``shift_of(places)`` as rows of single places."""
    if not shift_of(places):
        return rows
    return rows.repartition("place").sortWithinPartitions("place").mapInArrow(_again, ROW)


def shift_of(places: int) -> int:
    """How many low bits of a place one step leaves open, so that it deals to ``FAN`` groups at most."""
    return max(0, (places // FAN).bit_length() - 1) if places > FAN else 0


@dataclass(frozen=True)
class Places:
    """Where values belong: ``bits`` of them tell the range."""

    bits: int

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range and next 32 bits of values."""
        high = (h >> np.uint64(64 - self.bits)) if self.bits else np.zeros(len(h), np.uint64)
        return high.astype(np.uint32), (h >> np.uint64(32 - self.bits)).astype(np.uint32)

    def shared(self, h: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Which values are among a block's answers."""
        if not len(known):
            return np.zeros(len(h), bool)
        wanted = h >> np.uint64(32 - self.bits)
        return known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] == wanted


@dataclass
class Exchange:
    """What ``shared_values`` found."""

    size: int  # bytes of text
    rows: DataFrame  # doc_id, text, key (their hash) and block
    answers: DataFrame  # block, raw
    places: Places


def shared_values(docs: DataFrame, values: Callable[[pa.Array], Iterator[np.ndarray]]) -> Exchange:
    """Blocks of ``docs`` (doc_id, text) and the values in each that some other document has too.

    ``values`` gives the sorted distinct values of each text of a column.
    """
    size = text_bytes(docs)
    ranges, blocks = min(1 << 32, power(size / RANGE_BYTES)), min(1 << 32, power(size / BLOCK_BYTES))
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).withColumn("block", F.pmod("key", F.lit(blocks)))
    places = Places(ranges.bit_length() - 1)
    to_range, to_block = shift_of(ranges), shift_of(blocks)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own, n = np.empty(BUFFER, np.uint64), np.empty(BUFFER, np.uint32), 0
        for batch in batches:
            for block, found in zip(batch.column("block").to_numpy(), values(batch.column("text")), strict=True):
                while len(found):
                    k = min(len(found), BUFFER - n)
                    held[n : n + k], own[n : n + k] = found[:k], block
                    n, found = n + k, found[k:]
                    if n == BUFFER:
                        yield from packed_rows(*_by_place(held, own), to_range).to_batches()
                        n = 0
        if n:
            yield from packed_rows(*_by_place(held[:n], own[:n]), to_range).to_batches()

    def _by_place(h: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        high, rest = places.of(h)
        return ordered(high, block, rest)

    def answered(table: pa.Table) -> pa.Table:
        raws = table.column("raw").to_pylist()
        del table
        which, block, value = unpacked(raws)
        order = np.argsort(value, kind="stable")
        value, block = value[order], block[order]
        same = np.append(value[1:] == value[:-1], False)
        same[1:] |= same[:-1]
        block, value = block[same], value[same]
        return packed_rows(*ordered(block, np.full(len(block), which[0], np.uint32), value), to_block)

    asked = routed(rows.mapInArrow(sent, ROW), ranges).groupBy("place").applyInArrow(answered, ROW)
    answers = staged(routed(asked, blocks).withColumnRenamed("place", "block"), "shared")
    release(docs.sparkSession)
    return Exchange(size, rows, answers, places)


def answered_values(answers: pa.Table) -> np.ndarray:
    """All of a block's answers, as range and next 32 bits, sorted."""
    _, which, value = unpacked(answers.column("raw").to_pylist())
    return np.unique((which.astype(np.uint64) << np.uint64(32)) | value)
