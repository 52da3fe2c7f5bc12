"""Session construction and the shared lineage-cut folder.

On a cluster the deployment sets ``spark.checkpoint.dir`` to a shared,
fault-tolerant folder; every job here reads it from the session.  Only
when it is unset (local tests) do we create one under ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle-partition count is left to the
# deployment (AQE coalesces small partitions at runtime); local runs pass
# their own value.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "emberlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and staged tables.

    Reads ``spark.checkpoint.dir``.  Only a local-mode session without one
    (tests) gets a fresh folder under /tmp; on a cluster a machine-local
    folder would not be shared by the executors, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="emberlake-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``emberlake`` importable by the Python workers (as ``--py-files``).

    Operators that run pandas functions in tasks call this; the package is
    zipped once per application and distributed with ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="emberlake-pyfiles-", dir="/tmp"), "emberlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
