"""Session defaults and the shared scratch location.

Everything that must survive an executor loss (derived fixture files,
written tables that cut lineage, stream checkpoints) lives under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that is
unset (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.  Timestamps are formatted
# in UTC; AQE re-plans joins (broadcast only after a runtime size check)
# and coalesces/splits skewed shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Applied only while the setting still has Spark's own default: documents
# reach 1,000,000 characters, so Arrow batches for the Python-worker jobs
# (extraction, tokenization, range reads) are kept to a few hundred rows.
SOFT_DEFAULTS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "256"),
}


# Suggested settings for a large cluster (e.g. ~1000 executors reading
# ~100 TB).  Shuffle partitions follow the data (about 256 MB each after
# AQE), input splits stay at 256 MB, AQE splits skewed join partitions, and
# speculative copies are off because the fixture writers own their files.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.task.maxFailures": "8",
    "spark.speculation": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", app: str = "crawlsieve",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """A session with the package defaults.  ``profile='cluster'`` applies
    ``CLUSTER_SETTINGS`` (then ``shuffle_partitions`` is ignored)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if profile == "cluster":
        for k, v in CLUSTER_SETTINGS.items():
            builder = builder.config(k, v)
    else:
        builder = (builder.config("spark.driver.memory", "16g")
                          .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    extra = dict(extra or {})
    if master.startswith("local") and "spark.sql.warehouse.dir" not in extra:
        # local runs only: keep catalog tables out of the working directory
        extra["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="crawlsieve-warehouse-")
    for k, v in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per context)."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: ship the package with the deployment instead
        return
    if id(sc) in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="crawlsieve-pkg-")
    archive = shutil.make_archive(os.path.join(out, "crawlsieve"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="crawlsieve")
    sc.addPyFile(archive)
    _SHIPPED.add(id(sc))


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings our expressions depend on (UTC formatting)
    and ship the package to the Python workers."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session: leave it
                pass
    for k, (spark_default, ours) in SOFT_DEFAULTS.items():
        if spark.conf.get(k, spark_default) == spark_default:
            spark.conf.set(k, ours)
    ship_package(spark)
    return spark


def _strip_file_scheme(path: str) -> str:
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and fixture files.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    If neither is set and we run in local mode, create one in /tmp and
    register it; on a cluster an unset value is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="crawlsieve-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return _strip_file_scheme(root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root."""
    return f"{shared_root(spark)}/crawlsieve/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str = "table"):
    """`df` written below the shared root and read back: computed once, and its
    lineage is files that survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
