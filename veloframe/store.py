"""A versioned table store on plain Parquet: every change adds a log entry, and nothing is ever overwritten.

``root/table/_v=<name>/`` holds the files of one write, ``root/table/_log/N`` (one line of JSON, through Spark's file system) says which of them
make up version N, with schema and partitioning. The last whole entry of the log is the current one: there is no pointer to replace, so a reader sees
the version before or the one after, and holds on to what it opened. An entry is created only if there is none of its number; a writer that comes second gets an
error, except that an append tries again on top of the other. An entry without its end of line was cut off by a crash and does not count.

An append writes the new rows alone; other changes rewrite the table. With a table format on the class path the same calls map to its MERGE, DELETE and rollback.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(ValueError):
    """Another writer changed the table meanwhile."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _log(self, table: str) -> tuple[dict[int, dict], int]:
        """The whole entries by number, and the highest number taken."""
        fs, p = self._fs(f"{self.root}/{table}/_log")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        numbers = sorted(int(x) for x in names if x.isdigit())
        lines = {n: self._read(f"{self.root}/{table}/_log/{n}") for n in numbers}
        return {n: json.loads(x) for n, x in lines.items() if x.endswith("\n")}, max(numbers, default=0)

    def _read(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _commit(self, table: str, n: int, entry: dict) -> int:
        """Entry ``n``, unless another writer has taken the number."""
        fs, p = self._fs(f"{self.root}/{table}/_log/{n}")
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if fs.exists(p):
                raise Conflict(f"{table}: version {n} was written by another writer") from e
            raise
        out.write(bytearray((json.dumps(entry) + "\n").encode()))
        out.close()
        return n

    @staticmethod
    def _current(log: dict[int, dict]) -> int | None:
        if not log:
            return None
        last = max(log)
        return log[last]["parent"] if log[last]["what"] == "rollback" else last

    def version(self, table: str) -> int | None:
        """The current version; None if there is no such table."""
        return self._current(self._log(table)[0])

    def _entry(self, table: str, version: int | None) -> dict:
        log, _ = self._log(table)
        found = log.get(version or self._current(log))
        if found is None or found["what"] == "rollback":
            raise ValueError(f"no table {table}" if version is None else f"{table} has no version {version}")
        return found

    def _open(self, table: str, entry: dict) -> DataFrame:
        base = f"{self.root}/{table}"
        found = self.spark.read.schema(StructType.fromJson(entry["schema"])).option("basePath", base).parquet(*[f"{base}/{d}" for d in entry["dirs"]])
        return found.drop("_v")

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self._open(table, self._entry(table, version))

    def _written(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> str:
        name = f"_v=w{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/{table}/{name}")
        return name

    def _replace(self, table: str, df: DataFrame, partition_by: Sequence[str], what: str, seen: tuple[dict[int, dict], int]) -> int:
        """``seen``: the log that ``df`` was made from."""
        log, taken = seen
        entry = {"what": what, "parent": self._current(log), "by": list(partition_by), "schema": df.schema.jsonValue(), "dirs": [self._written(table, df, partition_by)]}
        return self._commit(table, taken + 1, entry)

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), what: str = "replace") -> int:
        return self._replace(table, df, partition_by, what, self._log(table))

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """New columns are NULL in old rows. Where types, spelling or partitioning differ from the table's, it is rewritten."""
        written = None
        while True:
            seen = log, taken = self._log(table)
            now = self._current(log)
            if now is None:
                return self._replace(table, df, partition_by, "append", seen)
            old = StructType.fromJson(log[now]["schema"])
            types = {f.name: f.dataType for f in old}
            spelt = {name.lower(): name for name in types}
            if list(partition_by) != log[now]["by"] or any(types.get(spelt.get(f.name.lower(), f.name), f.dataType) != f.dataType or spelt.get(f.name.lower(), f.name) != f.name for f in df.schema):
                return self._replace(table, self._open(table, log[now]).unionByName(df, allowMissingColumns=True), partition_by, "append", seen)
            schema = StructType([*old.fields, *[f for f in df.schema if f.name not in types]])
            written = written or self._written(table, df, partition_by)
            try:
                return self._commit(table, taken + 1, {"what": "append", "parent": now, "by": list(partition_by), "schema": schema.jsonValue(), "dirs": [*log[now]["dirs"], written]})
            except Conflict:
                continue

    def upsert(self, table: str, df: DataFrame, keys: Sequence[str], newest: str | None = None, partition_by: Sequence[str] = ()) -> int:
        """Rows of ``df`` replace those of equal keys. Of source rows with equal keys the ``newest`` counts; without it, equal keys are an error."""
        if newest:
            rank = Window.partitionBy(*keys).orderBy(F.desc(newest))
            df = df.withColumn("_rn", F.row_number().over(rank)).filter("_rn = 1").drop("_rn")
        else:
            n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
            df = df.withColumn("_n", n).withColumn(keys[0], F.when(F.col("_n") > 1, F.raise_error(F.lit("two source rows have one key"))).otherwise(F.col(keys[0]))).drop("_n")
        seen = log, _ = self._log(table)
        now = self._current(log)
        if now is None:
            return self._replace(table, df, partition_by, "upsert", seen)
        kept = self._open(table, log[now]).join(df.select(*keys), list(keys), "left_anti")
        return self._replace(table, kept.unionByName(df, allowMissingColumns=True), partition_by, "upsert", seen)

    def delete(self, table: str, keys: DataFrame, partition_by: Sequence[str] = ()) -> int:
        seen = log, _ = self._log(table)
        now = self._current(log)
        if now is None:
            raise ValueError(f"no table {table}")
        return self._replace(table, self._open(table, log[now]).join(keys, keys.columns, "left_anti"), partition_by, "delete", seen)

    def rollback(self, table: str, version: int) -> None:
        log, taken = self._log(table)
        if log.get(version, {"what": "rollback"})["what"] == "rollback":
            raise ValueError(f"{table} has no version {version}")
        self._commit(table, taken + 1, {"what": "rollback", "parent": version})

    def history(self, table: str) -> DataFrame:
        """version, operation, parent, is_current."""
        log, _ = self._log(table)
        now = self._current(log)
        rows = [(n, e["what"], e["parent"], n == now) for n, e in sorted(log.items()) if e["what"] != "rollback"]
        return self.spark.createDataFrame(rows, "version int, operation string, parent int, is_current boolean")

    def files(self, table: str) -> DataFrame:
        """path, bytes and time of the current version's files."""
        dirs = [f"{self.root}/{table}/{d}" for d in self._entry(table, None)["dirs"]]
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(dirs)
        return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))

    def drop(self, table: str) -> None:
        fs, p = self._fs(f"{self.root}/{table}")
        fs.delete(p, True)

    def audit(self, table: str, kind: str, source: DataFrame, loaded: DataFrame, run_ts: str, note: str = "") -> int:
        """Append (run_ts, layer, table_name, source_kind, source_count, loaded_count, note) to audit/ingest_runs."""
        one = source.agg(F.count(F.lit(1)).alias("source_count")).crossJoin(loaded.agg(F.count(F.lit(1)).alias("loaded_count")))
        layer, _, name = table.partition("/")
        named = one.select(F.to_timestamp(F.lit(run_ts)).alias("run_ts"), F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.lit(kind).alias("source_kind"), "source_count", "loaded_count", F.lit(note).alias("note"))
        return self.append("audit/ingest_runs", named)
