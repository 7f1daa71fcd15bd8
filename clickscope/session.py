"""Session helpers for tests, the bench and local runs.

On a cluster the session is built by the launcher; the library only reads
settings from it (for example ``spark.checkpoint.dir``) and never assumes a
machine-local folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans are designed around.  All are Spark defaults in 4.x
# except the UI (a server; kept off) and the time zone (pinned so string
# formatting of timestamps is reproducible).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "clickscope",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Only when the session names none (a local test run) is a scratch folder
    created and registered; a cluster must configure a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder for it"
            )
        configured = tempfile.mkdtemp(prefix="clickscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
