"""Operator 10: near-duplicate vectors by small-world graphs.

Equal vectors become one class with a count. Classes are dealt to shards by hash (``shards``, more only beyond ``SHARD_BYTES`` in
each), every shard gets a graph (``hnsw``), and every class is a query to every shard. A beam starts ``width`` wide. Where even its
last point is similar, it is widened fourfold, in the end to the whole shard, all of which the graph leads to, so that no cluster is too large for it. Each task audits
one query in ``audit_every`` (and at least ``audited``; half of them among queries that found links) against all of its shard; while the recall of links is
under ``recall``, all its beams are doubled. Links of a vector with itself don't count there. Links
are verified by the cosine in double precision. A task gives each query's count of links and a spanning forest of the links;
components of the forests are the groups. Whole vectors and counts never leave the tasks.

Queries times shards is what the method asks for: the work grows as rows times shards, so shards are as large as a bounded memory allows. Queries come to a
shard in slices of ``SLICE_BYTES``, and a graph is sent once for each slice; vectors are sent in the precision that they came in.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of different lengths don't
link; copies link with each other; equal vec_ids and repeated rows are vectors of their own; null vec_ids are grouped like others (a group's
id is its least non-null id); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import release, staged
from veloframe.llm.components import Forest, connected
from veloframe.llm.hnsw import Graph

#: A link's similarity in single precision may be lower by so much than in double precision.
SLACK = 1e-4
#: Bytes of a shard's vectors and of a slice of queries, in double precision.
SHARD_BYTES, SLICE_BYTES = 1 << 27, 1 << 26


def unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def scaled(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def similar(graph: Graph, exact: np.ndarray, q: np.ndarray, least: float, width: int) -> list[np.ndarray]:
    """Points of the shard with a cosine of at least ``least`` to each query."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    block = max(16, min(512, (1 << 26) // max(1, graph.n)))
    todo = np.arange(len(q))
    while len(todo):
        wide = []
        for lo in range(0, len(todo), block):
            own = todo[lo : lo + block]
            ids, sims = graph.search(q[own].astype(np.float32), width)
            if width < graph.n:
                wide += own[sims[:, -1] >= least - SLACK].tolist()
            r, c = np.nonzero((sims >= least - SLACK) & (ids >= 0))
            found = ids[r, c]
            good = np.einsum("ij,ij->i", exact[found], q[own[r]]) >= least
            r, found = r[good], found[good]
            cuts = np.searchsorted(r, np.arange(len(own) + 1))
            for i, j in enumerate(own.tolist()):
                out[j] = found[cuts[i] : cuts[i + 1]]
        todo, width = np.array(wide, np.int64), width * 4
    return out


def audited_links(graph: Graph, exact: np.ndarray, q: np.ndarray, itself: np.ndarray, least: float, width: int, audited: int, audit_every: int, recall: float) -> list[np.ndarray]:
    """``similar``, with beams doubled until an audit against the whole shard passes. ``itself``: each query's own place in the shard, or -1."""
    n = min(len(q), max(audited, len(q) // audit_every))
    truth: dict[int, np.ndarray] = {}
    while True:
        found = similar(graph, exact, q, least, width)
        linked = np.array([i for i, ids in enumerate(found) if (ids != itself[i]).any()], np.int64)
        for pool in (np.arange(len(q)), linked):
            for lo in range(0, len(some := pool[np.unique(np.linspace(0, len(pool) - 1, min(-(-n // 2), len(pool))).astype(np.int64))]), 64):
                own = np.array([i for i in some[lo : lo + 64].tolist() if i not in truth], np.int64)
                for i, row in zip(own.tolist(), (q[own] @ exact.T) >= least, strict=True):
                    row[itself[i]] &= itself[i] < 0
                    truth[i] = np.flatnonzero(row)
        hit = sum(len(np.intersect1d(found[i], t)) for i, t in truth.items())
        if hit >= recall * sum(map(len, truth.values())) or width >= graph.n:
            return found
        width *= 2


def near_vectors(vectors: DataFrame, least: float = 0.95, shards: int = 6, width: int = 48, audited: int = 64, audit_every: int = 50, recall: float = 0.99) -> DataFrame:
    """vec_id, n_links and component_id of each row of ``vectors`` (vec_id, embedding)."""
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("v"))
    sound = F.expr("v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("class", F.when(F.col("sound"), F.xxhash64("v")))
    classes = rows.filter("sound").groupBy("class", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = staged(classes.withColumn("dim", F.size("v")), "vectors")
    size = classes.agg(F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()[0] * 8
    parts, slices = max(shards, -(-size // SHARD_BYTES)), max(1, -(-size // SLICE_BYTES))
    points = classes.withColumn("shard", F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int"))

    def built(table: pa.Table) -> pa.Table:
        column = table.column("v").combine_chunks()
        return pa.table({
            "dim": table.column("dim").slice(0, 1), "shard": table.column("shard").slice(0, 1), "graph": pa.array([Graph(unit(column)).dumped()], pa.binary()), "v": pa.array([column.flatten().to_numpy().tobytes()], pa.binary()),
            "classes": pa.array([table.column("class").to_numpy().tobytes()], pa.binary()), "copies": pa.array([table.column("copies").to_numpy().tobytes()], pa.binary()),
        })

    graphs = staged(points.groupBy("dim", "shard").applyInArrow(built, "dim int, shard int, graph binary, v binary, classes binary, copies binary"), "graphs")
    sent = graphs.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    queries = classes.select("dim", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("shard"), F.pmod(F.xxhash64("class", F.lit(1)), F.lit(slices)).cast("int").alias("slice"), "class", "copies", "v")

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        if not left.num_rows or not right.num_rows:
            return pa.table({"class": empty, "n": empty, "a": empty, "b": empty})
        names, copies = (np.frombuffer(left.column(c)[0].as_py(), np.int64) for c in ("classes", "copies"))
        exact = scaled(np.frombuffer(left.column("v")[0].as_py(), kind + "32" * (kind == "float")).reshape(len(names), -1))
        graph = Graph.loaded(left.column("graph")[0].as_py(), exact)
        own = right.column("class").to_numpy()
        order = np.argsort(names)
        at = order[np.minimum(np.searchsorted(names, own, sorter=order), len(names) - 1)]
        found = audited_links(graph, exact, unit(right.column("v").combine_chunks()), np.where(names[at] == own, at, -1), least, width, audited, audit_every, recall)
        every, place = np.unique(np.concatenate([names, own]), return_inverse=True)
        forest, counts, edges = Forest(len(every)), [], []
        for i, ids in enumerate(found):
            ids = ids[names[ids] != own[i]]
            counts.append(int(copies[ids].sum()))
            edges += [(own[i], names[j]) for j in ids.tolist() if forest.join(int(place[len(names) + i]), int(place[j]))]
        a, b = (np.array(x, np.int64) for x in zip(*edges, strict=True)) if edges else (empty, empty)
        pad = [None] * len(a)
        return pa.table({"class": pa.array([*own.tolist(), *pad], pa.int64()), "n": pa.array([*counts, *pad], pa.int64()), "a": pa.array([*[None] * len(own), *a.tolist()], pa.int64()), "b": pa.array([*[None] * len(own), *b.tolist()], pa.int64())})

    keys = ("dim", "shard", "slice")
    found = staged(sent.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(answered, "class long, n long, a long, b long"), "links")
    forest = connected(found.filter("a is not null").select("a", "b"))
    roots = forest.select(F.col("node").alias("class"), "root")
    counted = found.filter("class is not null").groupBy("class").agg(F.sum("n").alias("n"))
    judged = classes.select("class", "copies", "least").join(counted, "class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    groups = judged.groupBy("root").agg(F.min("least").alias("component_id"))
    judged = judged.join(groups, "root").select("class", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.filter("sound").select("vec_id", "class").join(judged, "class").select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"))
    out = staged(linked.union(rows.filter("not sound").select("vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id"))), "near")
    release(vectors.sparkSession, classes, graphs, found, forest)
    return out


def op10_vector_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
