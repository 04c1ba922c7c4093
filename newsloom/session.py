"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session setting: partitions that rows are dealt out to before long row work; unset, rows stay where they were read.
DEAL = "newsloom.deal"


def local_session(cores: str = "*", partitions: int = 8, app: str = "newsloom") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config(DEAL, str(partitions))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session may do without the setting, as its
    one process reads what it writes; it gets a temporary folder. Elsewhere a missing setting is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not at:
        jvm_dir = context._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            at = jvm_dir.get()
        elif context.master == "local" or context.master.startswith("local["):
            at = tempfile.mkdtemp(prefix="newsloom-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", at)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(at)
    return at


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses. What is written there is deleted with the session."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, (spark, []))[1].append(path)
    return path


_written: dict[str, tuple[SparkSession, list[str]]] = {}


def drop_stored(spark: SparkSession) -> int:
    """Deletes what this session's operators wrote to the shared folder, and gives how many paths. Frames that
    read from there can no longer be used, so this is for when results have been written or collected."""
    paths = _written.pop(spark.sparkContext.applicationId, (spark, []))[1]
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _drop_all() -> None:
    for spark, _ in list(_written.values()):
        try:
            if spark.sparkContext._jsc is not None:
                drop_stored(spark)
        except Exception:  # noqa: BLE001 - the session may have ended before the interpreter
            pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read again: the lineage is cut there,
    and a lost executor costs no recomputation beyond that table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """The frame as a side of a join of which neither side is broadcast.

    Spark takes a stored table to be as large as its compressed files, and rows spread over salts to be one copy of
    them. What it sends for such a side can be many times its limit and fill the driver, so these joins are sorted.
    """
    return df.hint("merge")


def dealt(df: DataFrame) -> DataFrame:
    """The frame dealt out to as many partitions as the session setting ``newsloom.deal`` says, or as it is.

    For sessions on files of one row group, which is one task however many cores there are. The plan depends
    on the setting alone, never on the data; tables of many row groups need no setting and no shuffle.
    """
    parts = int(df.sparkSession.conf.get(DEAL, "0"))
    return df.repartition(parts) if parts else df
