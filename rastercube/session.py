"""Spark session helper (argument -> defaults; Arrow on, AQE on, UTC)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only where the session has no explicit value (so settings
# from spark-submit or the cluster win).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}
# Fixed at start-up: no web UI and no console progress bars.
STARTUP_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app: str = "rastercube",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or attach to a session.

    ``master`` falls back to ``$SPARK_MASTER`` and then ``local[*]``.  On a
    cluster the master, executor sizing and ``spark.checkpoint.dir`` come from
    the submit configuration.  ``conf`` is applied as given; ``SQL_DEFAULTS``
    only where nothing is set yet.
    """
    master = master or os.environ.get("SPARK_MASTER") or "local[*]"
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**STARTUP_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SQL_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The folder named by ``spark.checkpoint.dir`` is used as given.  Only when
    it is unset *and* Spark runs in local mode (tests) is a private temporary
    folder created; on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="rastercube-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
