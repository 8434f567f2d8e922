"""Operator 4: passages that an earlier document has, removed by suffix automata of reference shards.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A window is ``window`` consecutive words of a document. Words in windows that also stand in a
document with a smaller doc_id go; all windows are judged on the input.

Every document is a reference for all later ones, so automata of all references, broadcast to all documents, would mean documents times
references. Only what can match is put together instead, without loss:

1. Windows that one document alone has are set aside (``exchange``); they are most of the text.
2. What is left of a document falls into stretches of consecutive windows with the same minimizer (the ``ANCHOR``-word gram of least hash in the
   window). The minimizer names the reference shard, so equal windows meet in one shard, whatever stands around them. A block
   of documents sends each distinct stretch once, with its least doc_id.
3. A shard builds the suffix automaton of its stretches by ascending doc_id; each state remembers the first document that led to it. All
   stretches stream through it: where the match reaches ``window`` words, the state of the last ``window`` words tells the first
   document that has them. Blocks get these back and remove, in each document, the maximal spans of windows with an earlier first document.

Shards hold some ``SHARD_BYTES`` of corpus text each, before step 1. Words are compared by 32 bits of hash within windows that agree
by 64 bits elsewhere.

Cases: null or empty texts have no words and are left alone; texts of fewer words than a window lose nothing; rows of equal doc_id (and null
doc_ids, which count as the largest) do not remove each other's words; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.automaton import Automaton
from veloframe.llm.common import SPACED, Words, mixed, release, spread, staged, word_steps
from veloframe.llm.exchange import answered_values, power, shared_values

ANCHOR = 3
SHARD_BYTES = 1.5e6
NO_ID = np.iinfo(np.int64).max


def window_sets(column: pa.Array, window: int) -> Iterator[np.ndarray]:
    """The sorted distinct window hashes of each text."""
    for lo, hi, words in word_steps(column, SPACED, False):
        full, _ = words.grams(window)
        for i in range(hi - lo):
            a, b = int(words.first[i]), int(words.first[i + 1])
            yield np.unique(full[a : max(a, b - window + 1)])


class Stretches:
    """Stretches of consecutive windows with one minimizer: shard, first word, number of windows, and a hash of their words."""

    def __init__(self, words: Words, starts: np.ndarray, window: int, shards: int):
        """``starts``: ascending first words of windows."""
        grams, _ = words.grams(ANCHOR)
        width = window - ANCHOR + 1
        if not len(starts):
            self.shard = self.start = self.count = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        view = np.lib.stride_tricks.sliding_window_view(grams, width)
        at = starts + np.concatenate([view[starts[lo : lo + 65536]].argmin(axis=1) for lo in range(0, len(starts), 65536)])
        text = np.searchsorted(words.first, starts, "right")
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        self.start, self.count = starts[first], np.diff(np.append(first, len(starts)))
        self.shard = (mixed(grams[at[first]]) % np.uint64(shards)).astype(np.int64)
        h = self.count.astype(np.uint64)
        for k in range(int(self.count.max()) + window - 1):
            live = np.flatnonzero(k < self.count + window - 1)
            h[live] = mixed(h[live] * np.uint64(0x9E3779B97F4A7C15) + words.hash[self.start[live] + k])
        self.hash = h


def _ordered(shard: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index for each distinct (shard, hash), in that order, and the place of every entry among them."""
    order = np.lexsort((hashes, shard))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (shard[order][1:] != shard[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


class Dated(Automaton):
    """An automaton whose states remember the first sequence that led to them; sequences come by ascending date."""

    def __init__(self) -> None:
        super().__init__()
        self.first, self.date = [NO_ID], NO_ID

    def _state(self, length: int, link: int, nexts: dict[int, int]) -> int:
        self.first.append(self.date)
        return super()._state(length, link, nexts)

    def _clone(self, p: int, q: int, c: int) -> int:
        copy = super()._clone(p, q, c)
        self.first[copy] = self.first[q]
        return copy


def first_documents(sequences: list[np.ndarray], doc_ids: np.ndarray, window: int) -> np.ndarray:
    """For the windows of each sequence, in turn, the least doc_id of a sequence that holds the window."""
    auto, lists = Dated(), [x.tolist() for x in sequences]
    for i in np.argsort(doc_ids, kind="stable").tolist():
        auto.date = int(doc_ids[i])
        auto.add(lists[i])
    out = []
    for sequence in lists:
        state = matched = 0
        for c in sequence:
            state, matched = auto.step(state, matched, c)
            if matched >= window:
                out.append(auto.first[auto.holder(state, window)])
    return np.array(out, np.int64)


def _blob(words: Words, found: Stretches, chosen: np.ndarray, ids: np.ndarray, window: int) -> bytes:
    """Stretches of one shard: how many, windows of each, least doc_ids, then words as u32."""
    count = found.count[chosen]
    at = np.repeat(found.start[chosen], count + window - 1) + spread(count + window - 1)
    return np.array([len(chosen)], "<u4").tobytes() + count.astype("<u4").tobytes() + ids.astype("<i8").tobytes() + (words.hash[at] >> np.uint64(32)).astype("<u4").tobytes()


def _unblob(raw: bytes, window: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    count = np.frombuffer(raw, "<u4", n, 4).astype(np.int64)
    ids = np.frombuffer(raw, "<i8", n, 4 + 4 * n)
    words = np.frombuffer(raw, "<u4", -1, 4 + 12 * n)
    return np.split(words, np.cumsum(count + window - 1)[:-1]), ids, count


def _block(texts: pa.Array, doc_ids: np.ndarray, flags: list[bytes], window: int, shards: int) -> tuple[Words, Stretches, np.ndarray, np.ndarray, np.ndarray]:
    """A block's words, stretches, the text of each stretch, and the distinct stretches in order with each one's place among them."""
    from veloframe.llm.common import byte_column

    words = Words(*byte_column(texts), SPACED, False)
    counts = words.counts()
    marked = [np.flatnonzero(np.unpackbits(np.frombuffer(f, np.uint8), count=n)) + a for f, n, a in zip(flags, counts.tolist(), words.first.tolist(), strict=False)]
    found = Stretches(words, np.concatenate([np.zeros(0, np.int64), *marked]).astype(np.int64), window, shards)
    owner = np.searchsorted(words.first, found.start, "right") - 1
    # Ties and empty texts: the last text that begins at a word is the one that holds it.
    order, place = _ordered(found.shard, found.hash)
    return words, found, owner, order, place


def remove_repeats(docs: DataFrame, window: int = 13, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, spans (ranges of removed words, ascending, apart), kept_sha256 and, with ``texts``, kept (the kept words joined by a space) of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    exchange = shared_values(docs.select("doc_id", "text"), lambda column: window_sets(column, window))
    rows, answers, places, shards = exchange.rows, exchange.answers, exchange.places, power(exchange.size / SHARD_BYTES)

    def kept_row(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
        words, out, at = raw.split(), [], 0
        for a, b in spans:
            out += words[at:a]
            at = b
        out += words[at:]
        return len(words), len(words) - len(out), b" ".join(out)

    def finished(doc_ids: list, raws: list[bytes], spans: list[list[tuple[int, int]]]) -> dict[str, pa.Array]:
        made = [kept_row(r, s) for r, s in zip(raws, spans, strict=True)]
        return {
            "doc_id": pa.array(doc_ids, pa.int64()), "n_words": pa.array([m[0] for m in made], pa.int64()), "n_removed": pa.array([m[1] for m in made], pa.int64()),
            "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "kept_sha256": pa.array([hashlib.sha256(m[2]).hexdigest() for m in made]), "kept": pa.array([m[2].decode() if texts else None for m in made], pa.string()),
        }

    done = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_sha256 string, kept string"
    fields = ["kind", "block", "shard", "raw", "flags", *(x.split()[0] for x in done.split(", "))]

    def judged(left: pa.Table, right: pa.Table) -> pa.Table:
        """Documents with nothing shared are done; others go on with their shared windows, and their stretches to the shards."""
        known, block = answered_values(right), left.column("block")[0].as_py() if left.num_rows else 0
        out: dict[str, list] = {f: [] for f in fields}

        def put(n: int, **columns) -> None:
            for f in fields:
                out[f].append(columns.get(f, [None] * n))

        for ids, chunk in zip(left.column("doc_id").chunks, left.column("text").chunks, strict=True):
            for lo, hi, words in word_steps(chunk, SPACED, False):
                full, valid = words.grams(window)
                hit = places.shared(full, known) & valid
                where = np.flatnonzero(hit)
                text_of = np.searchsorted(words.first, where, "right") - 1
                some = np.unique(text_of)
                none = np.setdiff1d(np.arange(hi - lo), some)
                raws = [words.data[words.offsets[i] : words.offsets[i + 1]].tobytes() for i in range(hi - lo)]
                own_ids = ids.slice(lo, hi - lo).to_pylist()
                if len(none):
                    plain = finished([own_ids[i] for i in none], [raws[i] for i in none], [[]] * len(none))
                    put(len(none), kind=[0] * len(none), **{k: v.to_pylist() for k, v in plain.items()})
                if not len(some):
                    continue
                padded = np.zeros(len(words.hash) + 1, bool)
                padded[where] = True
                flags = [np.packbits(padded[words.first[i] : words.first[i + 1]]).tobytes() for i in some]
                put(len(some), kind=[1] * len(some), block=[block] * len(some), doc_id=[own_ids[i] for i in some], raw=[raws[i] for i in some], flags=flags)
        flagged = {f: [x for part, kinds in zip(out[f], out["kind"], strict=True) if kinds[0] == 1 for x in part] for f in ("doc_id", "raw", "flags")}
        if flagged["doc_id"]:
            ids = np.array([NO_ID if x is None else x for x in flagged["doc_id"]], np.int64)
            words, found, owner, order, place = _block(pa.array(flagged["raw"], pa.binary()), ids, flagged["flags"], window, shards)
            least = np.full(len(order), NO_ID)
            np.minimum.at(least, place, ids[owner])
            cuts = np.append(np.flatnonzero(np.diff(found.shard[order], prepend=-1)), len(order))
            names = found.shard[order][cuts[:-1]].tolist()
            put(len(names), kind=[2] * len(names), block=[block] * len(names), shard=names, raw=[_blob(words, found, order[a:b], least[a:b], window) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        flat = {f: [x for part in out[f] for x in part] for f in fields}
        return pa.table({f: pa.array(flat[f], t) for f, t in zip(fields, types, strict=True)})

    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string(), pa.string()]
    first = staged(rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judged, "kind int, block long, shard long, raw binary, flags binary, " + done), "windows", partition_by=("kind",))
    release(spark, answers)

    def in_shard(table: pa.Table) -> pa.Table:
        found = [_unblob(x, window) for x in table.column("raw").to_pylist()]
        sequences, ids, counts = [x for f in found for x in f[0]], np.concatenate([f[1] for f in found]), [int(f[2].sum()) for f in found]
        # Stretches of equal words stand in several blocks; the automaton needs each once.
        least: dict[bytes, int] = {}
        for x, d in zip(sequences, ids.tolist(), strict=True):
            key = x.tobytes()
            least[key] = min(d, least.get(key, NO_ID))
        keys = list(least)
        firsts = first_documents([np.frombuffer(k, "<u4") for k in keys], np.array([least[k] for k in keys], np.int64), window)
        sizes = np.array([len(k) // 4 - window + 1 for k in keys])
        begin = dict(zip(keys, (np.cumsum(sizes) - sizes).tolist(), strict=True))
        every = [firsts[(b := begin[x.tobytes()]) : b + len(x) - window + 1] for x in sequences]
        joined = np.split(np.concatenate(every), np.cumsum(counts)[:-1])
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "raw": pa.array([x.astype("<i8").tobytes() for x in joined], pa.binary())})

    firsts = staged(first.filter("kind = 2").select("block", "shard", "raw").groupBy("shard").applyInArrow(in_shard, "block long, shard long, raw binary"), "firsts")

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        raws = left.column("raw").to_pylist()
        given = left.column("doc_id").to_pylist()
        ids = np.array([NO_ID if x is None else x for x in given], np.int64)
        words, found, owner, order, place = _block(pa.array(raws, pa.binary()), ids, left.column("flags").to_pylist(), window, shards)
        parts = dict(zip(right.column("shard").to_pylist(), right.column("raw").to_pylist(), strict=True))
        known = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(parts[k], "<i8") for k in sorted(parts))])
        begin = np.cumsum(found.count[order]) - found.count[order]
        at = np.repeat(begin[place], found.count) + spread(found.count)
        window_at = np.repeat(found.start, found.count) + spread(found.count)
        hit = window_at[known[at] < np.repeat(ids[owner], found.count)]
        covered = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(covered, hit, 1)
        np.add.at(covered, np.minimum(hit + window, len(words.hash)), -1)
        gone = np.cumsum(covered[:-1]) > 0
        spans = []
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
            spans.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
        return pa.table(finished(given, raws, spans))

    names = [x.split()[0] for x in done.split(", ")]
    later = first.filter("kind = 1").select("block", "doc_id", "raw", "flags").groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(removed, done)
    out = first.filter("kind = 0").select(*names).union(later)
    return out if texts else out.drop("kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False).drop("spans")
