"""Where the bridge writes tables of its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from isthmus.sources.names import BridgeError


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path: in the one that the session's spark.checkpoint.dir names, which all executors share; where none is set, in a
    folder of this machine if all of Spark runs on it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise BridgeError("spark.checkpoint.dir: set a folder that the driver and all executors share")
        root = getattr(spark, "_isthmus_bridge", None)
        if not root:
            root = spark._isthmus_bridge = f"file://{tempfile.mkdtemp(prefix='isthmus-bridge-')}"
    return f"{root.rstrip('/')}/isthmus-bridge/{name}-{uuid.uuid4().hex[:12]}"
