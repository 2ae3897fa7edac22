"""A folder that every executor can see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; a
    cluster session is refused, as its executors do not share one.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="fundflow-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
