"""A local session for tests and the bench; on a cluster, use the session it gives you."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "hearthline"):
    tasks = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(tasks))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hearthline-"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ui.retainedExecutions", "5")
        .getOrCreate()
    )
