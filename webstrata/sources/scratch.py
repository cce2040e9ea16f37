"""Where jobs may put intermediate data: the shared folder named by the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the context's checkpoint folder.

    Only a local session without either gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="webstrata-")
    return _own[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder name in the shared folder that nothing has been written to."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there.

    The plan starts anew at the written table, which outlives executors; unlike a
    checkpoint of the rows, the result is computed only once."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
