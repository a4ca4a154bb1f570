"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Pages and documents are large rows: small Arrow batches keep a Python worker's memory bounded.
BATCH_ROWS = "1000"
_made: ContextVar[list[str] | None] = ContextVar("made_folders", default=None)
# What results and memory depend on; set on every session that runs a query.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
}


def build_session(app_name: str = "pressloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tuned for.

    ``master`` is only given for local runs; on a cluster ``spark-submit`` sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        local = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
        builder = builder.master(master)
        for key, value in local.items():
            builder = builder.config(key, value)
    for key, value in {**PINNED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Give a session the pinned settings."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, empty path below the folder the cluster shares between executors.

    The folder is ``spark.checkpoint.dir``.  Only a local master may run without
    it; there a temporary folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder below the shared one and read back.

    Cuts the lineage: what follows sees one fixed set of rows, plans above start from
    plain columns, and a lost executor costs a read of the table, not the work before it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def made_folders() -> Iterator[list[str]]:
    """The shared folders that are made inside the ``with`` block, in order."""
    outer, made = _made.get(), []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        if outer is not None:
            outer += made


def drop_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    for name in paths:
        path = hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
