"""Session helpers.

The library never creates a session inside an operator.  These helpers are
for callers (tests, bench, the driver entry) and for operators that must cut
lineage: they read ``spark.checkpoint.dir`` from the session and never fall
back to a machine-local folder on their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session used with this library should carry.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their plans are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "textrail", checkpoint_dir: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the recommended settings.

    ``checkpoint_dir`` is only applied when the session does not name one
    already (a cluster sets ``spark.checkpoint.dir`` to a shared folder).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not _conf(spark, "spark.checkpoint.dir") and not spark.sparkContext.getCheckpointDir():
        # spark.checkpoint.dir is a core setting that cannot be changed at
        # runtime; register the folder with the context instead
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf lookups never fail in practice
        v = None
    if not v:
        v = spark.sparkContext.getConf().get(key, None)
    return v or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Register the session's ``spark.checkpoint.dir`` with the context.

    Raises when no checkpoint folder is configured: reliable checkpoints
    must go to the shared folder the cluster names, never to a local temp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    wanted = _conf(spark, "spark.checkpoint.dir")
    if not wanted:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for "
            "reliable checkpoints (tests set a scratch folder themselves)")
    sc.setCheckpointDir(wanted)
    return sc.getCheckpointDir() or wanted


def stored(df):
    """Cut the lineage with a Parquet table in the checkpoint folder; the
    table is deleted when the session ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per session,
    so that functions that refer to its modules can be unpickled there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="textrail-ship-"), "textrail.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_SCANS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one driver table ``{sf_dir}/{name}.parquet``.

    The scan DataFrame is memoised per session and path (DataFrames are
    immutable plans), so building a plan does not re-read parquet footers
    for every reference to the same table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df


def spread(df, min_tasks: int | None = None):
    """Make sure CPU-heavy per-row work gets at least one task per core.

    A scan already split into at least ``min_tasks`` partitions (any large
    input on a cluster) is returned unchanged; a scan of a few big row
    groups is spread round-robin so text rules and folds run in parallel.
    """
    sc = df.sparkSession.sparkContext
    want = min_tasks or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def compute_once(df, name: str, expr):
    """Add column ``name`` = ``expr`` evaluated exactly once per row.

    Catalyst inlines a projected expression into every later reference and
    pushes filters below the projection, which re-runs costly regex chains.
    A one-element ``explode`` is a plan barrier for both, at the cost of a
    trivial generator inside the same code-generated stage.
    """
    from pyspark.sql import functions as F
    return df.select("*", F.explode(F.array(expr)).alias(name))


def join_small(big, small, on, how: str = "inner", max_rows: int = 100_000):
    """Join with ``small`` broadcast only when its row count is proven to
    be at most ``max_rows`` (checked with a bounded count); otherwise the
    planner's shuffle join (with AQE skew handling) is used."""
    from pyspark.sql import functions as F
    n = small.limit(max_rows + 1).count()
    return big.join(F.broadcast(small) if n <= max_rows else small, on, how)
