"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "drydock", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` wins over the defaults.

    ``master`` and partition counts are left to spark-submit unless given, so the same code
    runs on a laptop and on a cluster. AQE coalesces small shuffles, so a high partition count
    on a cluster costs nothing on small stages.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.enabled": "false",
        # Without call-site capture a plan of a few hundred expressions builds several times faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for streaming checkpoints and sinks.

    It lies below the folder the cluster names in ``spark.checkpoint.dir`` (shared storage). Without that
    setting a local session gets a temporary folder, and any other is an error: executors would each
    write to their own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="drydock-")
    return f"{shared.rstrip('/')}/drydock-{label}-{uuid.uuid4().hex[:12]}"
