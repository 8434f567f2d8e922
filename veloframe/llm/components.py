"""Connected components of an edge table: least label over neighbours, then over labels' labels, until nothing changes.

Every round is joins and partial minima over tables in the shared folder; nothing grows on the driver. Hot labels only meet in joins,
which Spark can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import release, staged


def connected(edges: DataFrame) -> DataFrame:
    """node, root (least node reachable) for every node of ``edges`` (a, b: long), as a scratch table."""
    spark = edges.sparkSession
    both = staged(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least"))
        hooked = staged(labels.join(near, "node").select("node", F.least("root", "least").alias("root"), F.col("root").alias("old")), "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        new = staged(hooked.join(up, "root").select("node", F.least("root", "upper").alias("root"), "old"), "labels")
        changed = new.filter("root <> old").limit(1).count()
        release(spark, labels, hooked)
        labels = new
        if not changed:
            release(spark, both)
            out = labels.select("node", "root")
            out._scratch_path = labels._scratch_path
            return out


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = int(up[i])
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether they were apart."""
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True
