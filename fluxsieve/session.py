"""Session defaults, and getting this package to the Python workers."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings the engine is written for. It doesn't rely on them: times are without zone, and arithmetic that
#: may overflow or divide by zero is written out.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, name: str = "fluxsieve", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=DEFAULTS | conf)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. On one machine, and there only, one of our own where it is unset."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="fluxsieve-")
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named.rstrip("/")


#: Bytes of a batch that goes to a Python worker, at most: texts are long, and workers stay alive with what they once needed.
BATCH = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable on the Python workers, once an application, and bound the batches that they get."""
    sc = spark.sparkContext
    size = spark.conf.get(_BATCH).rstrip("bB")
    if not size.isdigit() or int(size) > BATCH:
        spark.conf.set(_BATCH, str(BATCH))
    if getattr(sc, "_fluxsieve_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="fluxsieve-")) / "fluxsieve.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(archive))
    sc._fluxsieve_shipped = True
