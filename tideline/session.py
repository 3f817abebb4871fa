"""Session defaults: UTC, adaptive execution, and no reading of types that differ between engines."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("tideline")
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


#: Applications whose workers have the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python workers import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="tideline-")) / "tideline_package.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(out))
    _SHIPPED.add(app)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or a temporary one where that is unset in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tideline-")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Operators that join a table with something made from it double the plan; a
    chain of them must be cut, and a written table also survives lost executors.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
