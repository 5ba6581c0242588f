"""A local session for tests and the benchmark. On a cluster the cluster's own is used."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8, memory: str = "8g", **conf) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="refinery-")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("refinery")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
