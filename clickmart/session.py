"""Session helpers.

Library code never creates or reconfigures a session: it receives one.  These
helpers are for tests, the bench and command-line use on a single machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .sources.commits import Folder

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    # delete checkpoint files once the DataFrame reading them is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickmart") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Tests and the bench run without a cluster: give them a private folder.
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickmart-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the one the
    context already checkpoints to.

    A local session without either gets a private temporary folder.  On a cluster there is no
    folder that could be guessed, so a missing setting is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickmart-shared-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


#: Folder of the run's intermediate tables, where a caller opened one.
_RUN: ContextVar[str | None] = ContextVar("clickmart_run", default=None)


@contextmanager
def intermediate_tables(spark: SparkSession, name: str | None = None, keep: bool = False) -> Iterator[str]:
    """Collect the intermediate tables that are written inside the block in one folder of the
    shared folder, and delete it at the end, also after a failure.

    Results that are still lazy read those tables, so write or collect them inside.  With
    ``keep`` the folder (which is yielded) stays, for the caller to ``drop_tables`` later.
    """
    path = f"{shared_dir(spark)}/run-{name or uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        if not keep:
            drop_tables(spark, path)


def drop_tables(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``intermediate_tables`` kept."""
    folder, _, name = path.rstrip("/").rpartition("/")
    if not name.startswith("run-"):
        raise ValueError(f"not a folder of intermediate tables: {path}")
    Folder(spark, folder).delete(name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    The lineage ends there: operators that read their input several times don't derive it
    again (see ``intermediate_tables`` for clearing them), column pruning and filter pushdown still reach the files, and a lost executor
    re-reads them.
    """
    path = f"{_RUN.get() or shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
