"""Operator 9: links between documents by Jaccard similarity of word shingles, by T-occurrence search.

Words are `[^\\x20\\x09-\\x0D]+` after A-Z has been lower-cased; a document's set holds its distinct shingles of ``size`` words, as 64-bit
hashes. Documents of equal sets are one class. The work is exact at every step:

1. Shared shingles. Each batch sends, for each range of hash values and each block of documents, a packed list of 32-bit
   remainders; a range finds those that more than one document has and answers to each block. (Two shingles that meet in
   range and remainder count as shared; that only lets more through.) A document with fewer shared shingles than the least
   overlap, ``similarity`` of its size, links with nothing and is done: this is nearly all of them.
2. The same again, exactly, between the classes that are left, with frequencies. A class's rarest shared shingles, as many as leave less than the
   least overlap, are its prefix; classes that link share a prefix shingle. Buckets are chained to their least member,
   never paired, and components of these chains are clusters outside of which no link can be.
3. All classes are queries against all classes of their cluster whose size lets them link. Small clusters share a block (no link leads from one
   to another); large ones fall into bands of size, of which only neighbours can link, and bands are dealt into blocks of bounded weight; each pair of
   blocks that can hold links meets once. A block indexes its members in inverted lists and finds those that occur in at least T lists of the query's shingles by
   DivideSkip: the short lists are merged by a heap that skips ahead where too few heads agree, and the long ones, fewer than T, are probed by
   binary search for what came out. Sizes decide the exact overlap that is required. Every link is
   counted for both its classes by the rows that the other stands for; a spanning forest of a block's links is what components are found from.

Cases: null or empty texts have empty sets and link with nothing; fewer words than ``size`` are one shingle; repeated rows and
equal doc_ids are documents of their own (they meet in one class if their sets agree); an empty table gives no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import SPACED, mixed, release, staged, unused, word_steps
from veloframe.llm.components import Forest, connected
from veloframe.llm.exchange import answered_values, shared_values

#: Classes in a block of a large cluster, and of small clusters that share a block; and shared shingles of all their sets.
BLOCK, SMALL, BLOCK_ENTRIES, SMALL_ENTRIES = 1024, 128, 1 << 19, 1 << 17


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for lo, hi, words in word_steps(column, SPACED, True):
        full, _ = words.grams(size)
        for i in range(hi - lo):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a >= size:
                yield np.unique(full[a : b - size + 1])
            elif b > a:
                h = b - a
                for w in words.hash[a:b].tolist():
                    h = (h * 0x9E3779B97F4A7C15 + w) & 0xFFFFFFFFFFFFFFFF
                yield mixed(np.array([h], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def class_id(shingles: np.ndarray) -> int:
    """Equal for equal sets: a 64-bit hash of size, sum and exclusive or."""
    parts = np.array([len(shingles), shingles.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(shingles)) if len(shingles) else 0], np.uint64)
    return int(mixed((mixed(parts) * np.array([3, 5, 7], np.uint64)).sum(dtype=np.uint64)[None]).view(np.int64)[0])


def least_overlap(n: np.ndarray | int, percent: int):
    """No set of n shingles is that similar to any other with a smaller intersection."""
    return -(-(n * percent) // 100)


def overlap(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """Least intersection of sets of a and b shingles with 100 * intersection >= percent * union."""
    return -(-(percent * (a + b)) // (100 + percent))


def shared_shingles(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Step 1: doc_id, key, n, class, and shared (the shared shingles; null for what links with nothing) of each row."""
    exchange = shared_values(docs, lambda column: shingle_sets(column, size))
    places = exchange.places

    def judged(left: pa.Table, right: pa.Table) -> pa.Table:
        known = answered_values(right)
        n, classes, shared = [], [], []
        for chunk in left.column("text").chunks:
            for own in shingle_sets(chunk, size):
                n.append(len(own))
                classes.append(class_id(own))
                kept = own[places.shared(own, known)]
                shared.append(kept.tobytes() if len(own) and len(kept) >= least_overlap(len(own), percent) else None)
        return pa.table({"doc_id": left.column("doc_id").cast(pa.int64()), "key": left.column("key"), "n": pa.array(n, pa.int64()), "class": pa.array(classes, pa.int64()), "shared": pa.array(shared, pa.binary())})

    out = staged(exchange.rows.groupBy("block").cogroup(exchange.answers.groupBy("block")).applyInArrow(judged, "doc_id long, key long, n long, class long, shared binary"), "sets")
    release(docs.sparkSession, exchange.answers)
    return out


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("shared").to_pylist()]
        lengths = [len(x) for x in sets]
        if sum(lengths):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), pa.array(np.repeat(batch.column("class").to_numpy(), lengths)), pa.array(np.repeat(batch.column("n").to_numpy(), lengths))], ["h", "class", "n"])


def clusters(classes: DataFrame, percent: int) -> DataFrame:
    """Step 2: class, n, h (shared shingles, rarest first), cluster and rows (documents of the class)."""
    exploded = classes.mapInArrow(_exploded, "h long, class long, n long")
    counts = exploded.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    need = F.ceil(F.col("n") * percent / F.lit(100)).cast("long")
    kept = exploded.join(counts, "h").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    kept = staged(kept.filter(F.size("s") >= need).select("class", "n", F.col("s.h").alias("h")), "classes")
    prefix = kept.select("class", F.explode(F.slice("h", F.lit(1), (F.size("h") - need + 1).cast("int"))).alias("p"))
    chained = prefix.join(prefix.groupBy("p").agg(F.min("class").alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"), "p")
    found = connected(chained.select(F.col("class").alias("a"), "b"))
    out = staged(kept.join(found.withColumnRenamed("node", "class").withColumnRenamed("root", "cluster"), "class").join(classes.select("class", "rows"), "class"), "clusters")
    release(classes.sparkSession, kept, found)
    return out


class Lists:
    """Inverted lists over sets, and T-occurrence search by DivideSkip."""

    #: Weight of a probe against a merge step, as the method's authors fitted it.
    MU = 0.0085

    def __init__(self, values: np.ndarray, own: np.ndarray, sizes: np.ndarray, percent: int):
        """``values[i]`` is a shingle of member ``own[i]``; members ascend. ``sizes``: the members' whole sets."""
        self.sizes, self.percent = sizes, percent
        order = np.argsort(values, kind="stable")
        self.own, values = own[order], values[order]
        self.listed = self.own.tolist()
        self.begin = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
        self.keys = values[self.begin]
        self.end = np.append(self.begin[1:], len(values))

    def _merged(self, lists: np.ndarray, least: int) -> tuple[list[int], list[int]]:
        """Members on at least ``least`` of the lists, and on how many: a heap of the lists' heads; lists that can't make up a count skip ahead."""
        own, members, counts = self.listed, [], []
        heap = [(own[a], a, b) for a, b in zip(self.begin[lists].tolist(), self.end[lists].tolist(), strict=True)]
        heapify(heap)
        while len(heap) >= least:
            member, out = heap[0][0], []
            while heap and heap[0][0] == member:
                out.append(heappop(heap))
            if len(out) >= least:
                members.append(member)
                counts.append(len(out))
                ahead = member + 1
            else:
                out += [heappop(heap) for _ in range(min(len(heap), least - 1 - len(out)))]
                if not heap:
                    break
                ahead = heap[0][0]
            for _, a, b in out:
                a = bisect_left(own, ahead, a, b)
                if a < b:
                    heappush(heap, (own[a], a, b))
        return members, counts

    def search(self, query: np.ndarray, size: int) -> np.ndarray:
        """Members whose set is similar to the query's (its shared shingles and whole size)."""
        at = np.searchsorted(self.keys, query)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == query)] if len(self.keys) else at[:0]
        least = int(least_overlap(size, self.percent))
        if len(at) < least:
            return np.zeros(0, np.int64)
        at = at[np.argsort(self.end[at] - self.begin[at], kind="stable")]
        longest = int(self.end[at[-1]] - self.begin[at[-1]])
        n_long = min(least - 1, int(least / (self.MU * np.log2(longest + 1) + 1)))
        long = at[len(at) - n_long :]
        members, counts = (np.array(x, np.int64) for x in self._merged(at[: len(at) - n_long], least - n_long))
        need = overlap(self.sizes[members], size, self.percent)
        for left, i in zip(range(n_long, 0, -1), long, strict=True):
            live = counts + left >= need
            if not live.all():
                members, counts, need = members[live], counts[live], need[live]
            if not len(members):
                return members
            row = self.own[self.begin[i] : self.end[i]]
            counts = counts + (row[np.minimum(np.searchsorted(row, members), len(row) - 1)] == members)
        return members[counts >= need]


def _links_in_block(table: pa.Table, percent: int) -> pa.Table:
    """Links from queries (half 0) to members (half 1), or within one block: rows that each class links with (a, null, n), and a spanning forest of the links (a, b, 0)."""
    classes, sizes, rows, half = (table.column(c).to_numpy() for c in ("class", "n", "rows", "half"))
    sets = table.column("h").combine_chunks()
    values, lengths = sets.flatten().to_numpy(), sets.value_lengths().to_numpy()
    ends = np.cumsum(lengths)
    within = table.column("p")[0].as_py() == table.column("q")[0].as_py() and not table.column("across")[0].as_py()
    members = np.arange(len(classes)) if within else np.flatnonzero(half == 1)
    queries = members if within else np.flatnonzero(half == 0)
    linked, forest, out = np.zeros(len(classes), np.int64), Forest(len(classes)), []
    if len(queries) and len(members):
        own = np.repeat(np.arange(len(classes)), lengths)
        inside = np.isin(own, members)
        lists = Lists(values[inside], own[inside], sizes, percent)
        del own, inside
        for i in queries.tolist():
            near = lists.search(values[ends[i] - lengths[i] : ends[i]], int(sizes[i]))
            near = near[near != i]
            linked[i] += rows[near].sum()
            if not within:
                linked[near] += rows[i]
            out += [(classes[i], classes[m]) for m in near.tolist() if forest.join(i, m)]
    some = np.flatnonzero(linked)
    a, b = (np.array(x, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2
    b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b)])
    return pa.table({"a": np.concatenate([classes[some], a]), "b": b, "n": np.concatenate([linked[some], np.zeros(len(a), np.int64)])})


def links(found: DataFrame, percent: int) -> DataFrame:
    """Step 3, from ``clusters``: as blocks give them, counts (a, null, n) and forests (a, b, 0)."""
    width = math.log(100 / percent) + 1e-6 if percent < 100 else 1e-6
    found = found.withColumns({"band": F.floor(F.log(F.col("n").cast("double")) / width), "entries": F.size("h").cast("long")})
    total = found.agg(F.count(F.lit(1)).alias("m"), F.coalesce(F.sum("entries"), F.lit(0)).alias("e")).first()
    units = max(1, total.m // SMALL, total.e // SMALL_ENTRIES)
    sized = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("entries").alias("e"))
    alone = sized.filter((F.col("m") > SMALL) | (F.col("e") > SMALL_ENTRIES)).select("cluster")
    fields = ["unit", "band", "across", "p", "q", "half", "class", "n", "h", "rows"]
    few = found.join(alone, "cluster", "left_anti").withColumns({
        "unit": F.pmod(F.xxhash64("cluster"), F.lit(units)), "band": F.lit(-1).cast("long"), "across": F.lit(False), "p": F.lit(0).cast("long"), "q": F.lit(0).cast("long"), "half": F.lit(0),
    })
    many = found.join(alone, "cluster")
    bands = many.groupBy("cluster", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("entries") / BLOCK_ENTRIES)).cast("long").alias("parts"))
    for name, step in (("above", -1), ("below", 1)):
        bands = bands.join(bands.select("cluster", (F.col("band") + step).alias("band"), F.col("parts").alias(name)), ["cluster", "band"], "left")
    many = many.join(bands.select("cluster", "band", "parts", "above", "below"), ["cluster", "band"]).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")))
    meets = """concat(
        transform(sequence(0L, parts - 1), j -> struct(band as band, false as across, least(part, j) as p, greatest(part, j) as q, if(part <= j, 0, 1) as half)),
        if(above is null, array(), transform(sequence(0L, above - 1), j -> struct(band as band, true as across, part as p, j as q, 0 as half))),
        if(below is null, array(), transform(sequence(0L, below - 1), j -> struct(band - 1 as band, true as across, j as p, part as q, 1 as half))))"""
    many = many.select(F.col("cluster").alias("unit"), F.explode(F.expr(meets)).alias("x"), "class", "n", "h", "rows").select("unit", "x.*", "class", "n", "h", "rows")
    dealt = few.select(F.lit(False).alias("alone"), *fields).union(many.select(F.lit(True).alias("alone"), *fields))
    return staged(dealt.groupBy("alone", "unit", "band", "across", "p", "q").applyInArrow(lambda t: _links_in_block(t, percent), "a long, b long, n long"), "links")


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, key (hash of doc_id and text), n_shingles, class, root (one for each component; null for an empty set), component_id (least doc_id
    that links lead to) and n_links (other rows that it links with) of each row of ``docs`` (doc_id, text)."""
    sets = shared_shingles(docs, size, percent)
    classes = staged(sets.filter(F.col("shared").isNotNull()).groupBy("class").agg(F.first("n").alias("n"), F.first("shared").alias("shared"), F.count(F.lit(1)).alias("rows")), "candidates")
    dealt = clusters(classes, percent)
    near = links(dealt, percent)
    found = connected(near.filter("b is not null").select("a", "b"))
    linked = near.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
    own = sets.select("doc_id", "key", F.col("n").alias("n_shingles"), "class")
    filled = own.filter("n_shingles > 0")
    least = filled.groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")).join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    roots = least.groupBy("root").agg(F.min("least").alias("component_id"))
    links_of = (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    named = least.join(roots, "root").join(linked, "class", "left").select("class", "root", "component_id", links_of)
    alone = own.filter("n_shingles = 0").select("doc_id", "key", "n_shingles", "class", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    out = staged(filled.join(named, "class").select("doc_id", "key", "n_shingles", "class", "root", "component_id", "n_links").union(alone), "similar")
    release(docs.sparkSession, sets, classes, dealt, near, found)
    return out


def drop_similar(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component, its own columns: of the least doc_id (a null one only where there is no other) and, among several
    rows of that doc_id, of the least hash of the text. Rows without a word all stay, since they link with nothing."""
    found = similar_documents(docs.select("doc_id", "text"), size, percent)
    grouped = found.filter("root is not null")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key"))).alias("first"))
    others = grouped.join(first, "root").filter(F.col("key") != F.col("first.key")).select("key").distinct()
    name = unused(docs, "key")
    kept = docs.withColumn(name, F.xxhash64("doc_id", "text")).join(others.withColumnRenamed("key", name), name, "left_anti")
    twice = grouped.groupBy("key").count().filter("count > 1").select(F.col("key").alias(name))
    if twice.limit(1).count():  # rows that agree in doc_id and text
        kept = kept.join(twice, name, "left_anti").unionByName(kept.join(twice, name, "left_semi").dropDuplicates([name]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")
