"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants. AQE re-plans joins at runtime from
# measured sizes (the size check behind every broadcast we do not hint) and
# splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "starpipe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is whatever ``spark.checkpoint.dir`` names, a file system that the
    driver and all executors share. Without one a session of one machine
    (master ``local`` or ``local[...]``, as in tests) gets a temporary
    folder; any other session is an error, since a folder on one machine
    would be missing on the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
        conf_dir = tempfile.mkdtemp(prefix="starpipe-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
