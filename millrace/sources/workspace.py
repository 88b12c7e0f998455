"""Where jobs keep staged tables, stream checkpoints and sink output."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a temporary folder of its own.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):  # one process; not local-cluster
            raise ValueError(f"set {SETTING} to a folder shared by all executors")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
