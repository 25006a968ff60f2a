"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold from a laptop to a large cluster: the size-dependent ones
# (shuffle partitions, memory) stay with the caller.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "tarmac", master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session for tests and benches; a cluster job brings its own.

    Without ``shuffle_partitions`` Spark's own setting holds.
    """
    builder = SparkSession.builder.master(master).appName(app)
    sized = {} if shuffle_partitions is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions)}
    settings = {**BASE_CONF, **sized, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    A local folder is used only where that setting is absent and the executors are
    threads of this process; on a cluster they would not see it, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all of {master} shares")
        base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
