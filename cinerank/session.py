"""Session builder for tests, the bench and command-line runs.

Cluster deployments pass their own settings through spark-submit; nothing
here fixes a master unless asked.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "cinerank",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local["):      # one machine: a private folder serves
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="cinerank-ckpt-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 -- no SparkContext under Spark Connect
        pass
    return spark
