"""Sessions, and making this package importable on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

HOME = Path(__file__).resolve().parent
_shipped: set[str] = set()


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "lodestone") -> SparkSession:
    """A single-machine session, for tests and benchmarks; on a cluster, pass the engine a session of your own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once for each application, unless their PYTHONPATH has it."""
    if any(os.path.isdir(os.path.join(p, HOME.name)) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p):
        return spark
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = os.path.join(tempfile.mkdtemp(prefix="lodestone-ship-"), f"{HOME.name}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(HOME.rglob("*.py")):
                z.write(file, file.relative_to(HOME.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that a job writes and reads again, below spark.checkpoint.dir, which the driver and all
    executors share. Only a local session may leave that unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
