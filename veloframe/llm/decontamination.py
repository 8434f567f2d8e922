"""Operator 5: benchmark passages in training documents, by a generalised suffix automaton of the items.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z has been lower-cased. A window is ``window`` consecutive words of an item;
an item of fewer words is one window. Items are put into automata of at most ``shard_words`` words, each
broadcast to the tasks, and the documents stream through them one after the other: beyond a bitmap of the items' word pairs, which
skips text that cannot hold a window, each word moves the longest match, and a match as long as a window marks its words and
names the items that hold it. Words are compared by 64-bit hashes.

Cases: null or empty texts have no words; items without words are ignored; items of equal id count once; null ids count as
the empty string; an empty benchmark hits nothing; an empty table gives no rows; input columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.automaton import Automaton
from veloframe.llm.common import PLAIN, Words, byte_column, extended, mixed, set_aside, word_steps

SPAN = "struct<start:int,end:int,byte_start:int,byte_end:int>"
_PAIR_BITS = 22


class Items:
    """An automaton of items (id, word hashes)."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window, self.shortest = window, min([window, *(len(w) for _, w in items)])
        self.auto = Automaton()
        for _, words in items:
            self.auto.add(words.tolist())
        self.inside: dict[int, set[str]] = {}  # by the state of a window of full length
        self.short: dict[int, list[tuple[int, str]]] = {}  # by the state of an item shorter than a window
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        auto = self.auto
        for item, words in items:
            state = 0
            for i, c in enumerate(words.tolist()):
                state = auto.nexts[state][c]
                if i + 1 >= window:
                    self.inside.setdefault(auto.holder(state, window), set()).add(item)
            if len(words) < window:
                self.short.setdefault(auto.holder(state, len(words)), []).append((len(words), item))
            self.pairs[self._keys(words)] = True

    def _keys(self, words: np.ndarray) -> np.ndarray:
        """Bitmap places of single words if an item has one word alone, else of word pairs."""
        h = words if self.shortest == 1 else mixed(words[:-1] * np.uint64(3) + words[1:])
        return (h >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)

    def runs(self, words: Words) -> list[tuple[int, int]]:
        """Ranges of words, each within one text, outside of which nothing can match."""
        if len(words.hash) < self.shortest:
            return []
        joint = self.shortest > 1
        there = self.pairs[self._keys(words.hash)]
        if joint:
            cuts = words.first[1:-1]
            there[cuts[(cuts > 0) & (cuts <= len(there))] - 1] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], there, [False]]).astype(np.int8)))
        lo, hi = edges[::2], edges[1::2] + joint
        if not joint:  # a run of single words may go over the end of a text
            cuts = words.first[1:-1]
            inner = cuts[there[np.clip(cuts, 1, len(there)) - 1] & there[np.clip(cuts, 0, len(there) - 1)] & (cuts > 0) & (cuts < len(there))]
            lo, hi = np.union1d(lo, inner), np.union1d(hi, inner)
        long = hi - lo >= self.shortest
        return list(zip(lo[long].tolist(), hi[long].tolist(), strict=True))

    def match(self, hashes: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of the words inside occurrences, and the items that occur."""
        auto, window, found, spans = self.auto, self.window, set(), []
        state = matched = 0

        def mark(lo: int, hi: int) -> None:
            while spans and lo <= spans[-1][1]:
                lo = min(lo, spans.pop()[0])
            spans.append((lo, hi))

        for i, c in enumerate(hashes, 1):
            state, matched = auto.step(state, matched, c)
            if matched >= window:
                found |= self.inside[auto.holder(state, window)]
                mark(i - window, i)
            if self.short:
                s = state
                while s > 0:
                    for n, item in self.short.get(s, ()):
                        if n <= matched:
                            found.add(item)
                            mark(i - n, i)
                    s = auto.link[s]
        return spans, found


def _shards(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items (id, word hashes) in shards of about ``limit`` words; one shard at a time is on the driver. The last may be empty."""
    out, size = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").toLocalIterator():
        words = Words(*byte_column(pa.array([row.text], pa.string())), PLAIN, True).hash
        if out and size + len(words) > limit:
            yield out
            out, size = [], 0
        if len(words):
            out.append((row.item_id, words))
            size += len(words)
    yield out


def _built(key: str, shard: list, window: int, made: dict = {}) -> Items:  # noqa: B006  few for each process
    if key not in made:
        if len(made) > 1:
            made.clear()
        made[key] = Items(shard, window)
    return made[key]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 100_000) -> DataFrame:
    """``docs`` (text and others) with n_words, hit_spans (ranges of words and of bytes, ascending, apart) and hit_items (sorted ids)."""
    out = docs.drop("n_words", "hit_spans", "hit_items")
    context = docs.sparkSession.sparkContext
    for k, shard in enumerate(_shards(benchmark, shard_words)):
        key = hashlib.sha1(repr([(i, w.tobytes()) for i, w in shard]).encode()).hexdigest() + f"/{window}"
        sent = context.broadcast(shard)

        def compute(batch: pa.RecordBatch, sent=sent, key=key, k=k) -> list[pa.Array]:
            automaton = _built(key, sent.value, window)
            counts, spans, found = [], [[] for _ in range(batch.num_rows)], [set() for _ in range(batch.num_rows)]
            if k:
                spans = [[tuple(s.values()) for s in x] for x in batch.column("hit_spans").to_pylist()]
                found = [set(x) for x in batch.column("hit_items").to_pylist()]
            for lo, _, words in word_steps(batch.column("text"), PLAIN, True):
                counts.append(words.counts())
                for a, b in automaton.runs(words):
                    hit, ids = automaton.match(words.hash[a:b].tolist())
                    if hit:
                        i = int(np.searchsorted(words.first, a, "right")) - 1
                        base, byte = int(words.first[i]), int(words.offsets[i])
                        found[lo + i] |= ids
                        spans[lo + i] += [(a + s - base, a + e - base, int(words.start[a + s]) - byte, int(words.end[a + e - 1]) - byte) for s, e in hit]
            names = ("start", "end", "byte_start", "byte_end")
            kind = pa.list_(pa.struct([(n, pa.int32()) for n in names]))
            return [
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array([[dict(zip(names, s, strict=True)) for s in _joined(x)] for x in spans], kind),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
            ]

        if k:
            out = out.withColumnsRenamed({"hit_spans": "_s", "hit_items": "_i"}).withColumns({"hit_spans": F.col("_s"), "hit_items": F.col("_i")}).drop("_s", "_i")
            out = _extended_in_place(out, compute)
        else:
            out = extended(out, f"n_words long, hit_spans array<{SPAN}>, hit_items array<string>", compute)
    return out


def _extended_in_place(docs: DataFrame, compute) -> DataFrame:
    """The three result columns, at the end of ``docs``, are made anew from their old values."""
    names = [c for c in docs.columns if c not in ("n_words", "hit_spans", "hit_items")]
    docs = docs.select(*names, "n_words", "hit_spans", "hit_items")
    columns = docs.columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *compute(batch)], columns)

    return docs.mapInArrow(run, docs.schema)


def _joined(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping ranges become one."""
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            last = out.pop()
            s = (last[0], max(last[1], s[1]), last[2], max(last[3], s[3]))
        out.append(s)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_span: int = 200, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages, with its own columns: the passages' words and what stands between them are cut from
    the text. A document goes whole if a passage has over ``max_span`` words or passages are over ``max_coverage`` of its words."""
    own, back = set_aside(docs, "text")
    found = find_benchmark(own, benchmark, window)
    hit = F.expr("aggregate(hit_spans, 0, (a, s) -> a + s.end - s.start)")
    keep = (F.size("hit_spans") == 0) | (F.expr("forall(hit_spans, s -> s.end - s.start <= {})".format(max_span)) & (hit <= max_coverage * F.col("n_words")))
    cut = F.expr(
        "cast(aggregate(hit_spans, named_struct('at', 0, 'out', cast('' as binary)),"
        " (a, s) -> named_struct('at', s.byte_end, 'out', concat(a.out, substring(cast(text as binary), a.at + 1, s.byte_start - a.at))),"
        " a -> concat(a.out, substring(cast(text as binary), a.at + 1, octet_length(text) - a.at))) as string)"
    )
    return back(found.filter(keep).withColumn("text", F.when(F.size("hit_spans") > 0, cut).otherwise(F.col("text"))))


def digests(found: DataFrame) -> DataFrame:
    hit = F.expr("aggregate(hit_spans, 0L, (a, s) -> a + s.end - s.start)")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return digests(find_benchmark(docs.select("doc_id", "text"), benchmark))
