"""Session helpers: a local builder for tests and tables in the shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lotlens", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    b = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # wide projections: methods the JIT would refuse are generated per expression instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees: spark.checkpoint.dir, or the one given to SparkContext.setCheckpointDir.

    A local session may have neither; it gets a temporary folder, removed when the program ends. On
    a cluster such a folder would be another one on every machine, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        folder = tempfile.TemporaryDirectory(prefix="lotlens-", ignore_cleanup_errors=True)
        atexit.register(folder.cleanup)
        _OWN_FOLDERS[app] = folder.name
    return _OWN_FOLDERS[app]


_TABLES: list[str] = []


def written(df: DataFrame, *by: str) -> DataFrame:
    """Write an intermediate result to the shared folder, in folders of the columns `by`, and read it back.

    Cuts the lineage durably (a lost executor replays nothing) and gives
    Catalyst the true size, so a join with the result is broadcast only when it
    really is below spark.sql.autoBroadcastJoinThreshold.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    _TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[Callable[..., DataFrame]]:
    """A `written` whose tables are deleted at the end of the block; what reads them must be stored by then."""
    made: list[tuple[SparkSession, str]] = []

    def keep(df: DataFrame, *by: str) -> DataFrame:
        path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
        made.append((df.sparkSession, path))
        df.write.partitionBy(*by).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        for spark, name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(spark: SparkSession) -> int:
    """Delete the intermediate tables made so far, once the results that read them are stored; gives their number."""
    n = 0
    while _TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n
