"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on; sizes and parallelism stay the cluster's own."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_prepared: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names in ``spark.checkpoint.dir``, else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tidemark"


def _own_dir(spark: SparkSession) -> str:
    """The application's folder in the shared one; it goes when the application ends in order."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if path not in _prepared:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _prepared.add(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, below one folder per application."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that :func:`materialise` writes inside are removed at the end, but for those it was asked to keep.

    Nothing that reads them may be used after, so the result is written inside, with ``kept``.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For inputs that are scanned several times (model fitting, stream sources). The lineage ends at the
    written files, so a lost executor costs a re-read and not a recomputation. Inside :func:`scratch` the files go with it;
    ``kept`` ones belong to the scope around it, or to the application.
    """
    path = scratch_path(df.sparkSession, name)
    owner = _scopes[:-1] if kept else _scopes
    if owner:
        owner[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
