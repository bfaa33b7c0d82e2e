"""Spark session helpers.

The session settings that matter at scale (AQE, skew-join splitting, UTC time
zone) are set here for local runs and tests; on a cluster the submitting job's
configuration wins because ``getOrCreate`` returns the existing session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "lodestar",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that
    functions run in tasks can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    import shutil
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="lodestar-pkg-"), "lodestar"), "zip",
                                  os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python functions in Arrow batches of about BATCH_BYTES.  A task holds several
    copies of a batch outside the heap and in its Python worker; by Spark's own limits one has 10,000 whole
    texts or 64 MB.  A limit that the session has set stays."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it this raises, since executors cannot read the driver's own
    folders.  Only a local master gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table under the checkpoint folder and read back: the lineage is
    cut, lost executors cost nothing, and every reader sees the same rows."""
    where = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
