"""Session helpers: building a session and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quire") -> SparkSession:
    """A session with AQE on and the UI off; local defaults only when unset."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        # see tune(): wide decode expressions make constraint inference slow
        "spark.sql.constraintPropagation.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the curation plans rely on.

    The model-answer decode builds wide CASE expressions (one per field and
    JSON kind). With constraint propagation on, the optimizer's
    InferFiltersFromConstraints rule expands every projection alias into the
    join constraints and spends seconds per plan (measured: 10 s of a 10.4 s
    optimization at sf0.01, independent of data size). The plans have no
    filters that benefit from inferred constraints, so it is turned off.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    A deployment sets it to a shared file system. Where it is unset, a local
    session gets a temporary folder; on a cluster that would be each machine's
    own disk, so there it is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="quire-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() or path).rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), *[p.strip("/") for p in parts]])


def path_done(spark: SparkSession, path: str) -> bool:
    """True if a completed Spark write (``_SUCCESS`` marker) is at ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
