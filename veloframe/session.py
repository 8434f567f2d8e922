"""Sessions, and getting this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


#: Bytes of an Arrow batch between the JVM and a Python worker, where the session sets none (then it is 64 MB): both sides hold several at a time.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, unless their PYTHONPATH already has it (once for each context), and keep Arrow batches small."""
    name, size = BATCH
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(size))
    paths = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    context = spark.sparkContext
    if str(ROOT) in paths or getattr(context, "_veloframe_shipped", False):
        return
    to = Path(tempfile.mkdtemp()) / "veloframe.zip"
    with zipfile.ZipFile(to, "w") as out:
        for p in sorted(Path(__file__).parent.rglob("*.py")):
            out.write(p, p.relative_to(ROOT))
        for p in ROOT.glob("corpus_pipeline.py"):
            out.write(p, p.name)
    context.addPyFile(str(to))
    context._veloframe_shipped = True


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench. Memory counts only before the JVM starts."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("veloframe")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
