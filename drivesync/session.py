"""Session settings the library relies on, and the shared checkpoint folder."""

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The Parquet writer looks at its buffer after 100 rows at first; of payloads
# of many megabytes that would be gigabytes. It also bounds what a reader of
# whole row groups has to hold.
PAYLOAD_PARQUET = {"parquet.page.size.row.check.min": "1"}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="drivesync-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever store it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def move_dir(spark: SparkSession, path: str, target: str) -> None:
    """Put a folder in the place of another one of the same store."""
    remove_dir(spark, target)
    folder, place = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).rename(folder, place):
        raise OSError(f"{path} could not be moved to {target}")


def task_count(spark: SparkSession) -> int:
    """Tasks for work whose input rows are tiny and whose effort is not.

    Passed to ``repartition`` as a number: without one, adaptive execution
    would merge a plan of a few megabytes into one task, whatever it makes
    that task read or write.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, 2 * spark.sparkContext.defaultParallelism)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Set session options for a block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
