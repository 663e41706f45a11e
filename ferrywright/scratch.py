"""Cutting lineage with reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's checkpoint folder, for files that are written and read again."""
    return f"{_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base or _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-checkpoints-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the session's checkpoint folder, which all executors share.

    Where ``spark.checkpoint.dir`` is unset a temporary folder takes its place in local sessions, as in tests; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(_root(df.sparkSession))
    return df.checkpoint()
