"""Session settings and the shared scratch area.

Nothing in the package pins executor counts or partition sizes: those belong to
the cluster. ``build_session`` only sets what the operators rely on.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Spark broadcasts a join side only when its own statistics put it below this size;
    # anything larger falls back to a shuffled join with skew splitting.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.showConsoleProgress": "false",
}

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "chartloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    Lets functions that run in tasks import it without a cluster-wide install.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="chartloom-code-")) / package.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder; on a cluster a
    missing setting is an error, because executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="chartloom-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root, dropped when the driver JVM ends."""
    path = f"{scratch_root(spark)}/chartloom/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch area before the driver ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch area and read it back.

    Cuts lineage the way ``checkpoint()`` does, but columnar and computed a single
    time; the result survives the loss of any executor. ``compression`` is the session's unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
