"""Tables that an operator writes in the shared checkpoint folder to cut lineage.

The folder is the session's ``spark.checkpoint.dir``. Where that is unset, as
in tests on one machine, a new local folder is taken; a cluster is refused. Every table is
written whole before it is read, so executors that are lost later cost a read
and not a recomputation. Folders go when the interpreter ends, and earlier when
the operator says that nothing reads them any more.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

KEY = "spark.checkpoint.dir"
#: Spark's setting to remove a query's shuffle files at its end; otherwise they stay until the driver's garbage collector meets them.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_roots: list[tuple[SparkSession, str]] = []
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"{KEY} must name a folder that the driver and all executors share")
        # One folder per application; the setting itself can't be changed in a running session.
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="docmill-checkpoint-")
        base = _own[app]
    return base.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, root in _roots:
        with contextlib.suppress(Exception):  # the session may have ended
            _delete(spark, root)


class Workspace:
    """A folder of one run of one operator. With ``tidy`` what was shuffled for a table goes once the table is written."""

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        ship(spark)
        self.spark, self.tidy = spark, tidy
        self.root = f"{shared_dir(spark)}/docmill-{name}-{uuid.uuid4().hex}"
        _roots.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and return the table."""
        before = self.spark.conf.get(TIDY, "false")
        self.spark.conf.set(TIDY, str(self.tidy or before == "true").lower())
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.set(TIDY, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        _delete(self.spark, self.path(name))


#: Texts reach Python in batches of about so many bytes, whatever their number of rows.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


#: Rows of ids that are broadcast at most (some tens of MB); a table with more is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


#: A key with more than one in so many of all rows is hot; there are fewer hot keys than this.
HOT_KEYS = 4096


def hot_join(rows: DataFrame, facts: DataFrame, key: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with facts, which has each key once and in ``count`` how many of the ``total`` rows have it.

    Rows of hot keys never meet in a task: the facts of hot keys, HOT_KEYS at
    most whatever the total, are broadcast, and only rows of other keys are
    shuffled. Null keys match nothing.
    """
    least = total // HOT_KEYS
    hot = F.broadcast(facts.where(F.col(count) > least))
    rest = rows.join(F.broadcast(facts.where(F.col(count) > least).select(*key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(facts.where(F.col(count) <= least), key, how))


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, with a broadcast hint if it has at most ``rows`` rows. df should be a written table, as it is counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
