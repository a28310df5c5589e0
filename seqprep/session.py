"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "seqprep") -> SparkSession:
    """Session for tests and the bench. A cluster job builds its own session;
    the library only reads settings from whatever session it is given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it the job fails here, since a machine-local folder would
    lose what executors write. Only a ``local[...]`` master gets a scratch
    folder of its own (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: with master {sc.master} it must name a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="seqprep-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()
