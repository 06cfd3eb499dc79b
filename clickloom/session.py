"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyarrow import ArrowException, fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on. The fourth lets a join on (_chunk, key) reuse rows
# that are already hashed on _chunk, so that only the small carry side is shuffled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

_LOCAL_FOLDERS: dict[str, str] = {}
_WRITTEN: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def prepared(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings for the jobs inside only, and no intermediate table left behind."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    first = len(_WRITTEN)
    try:
        yield prepare(spark)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        for path in _WRITTEN[first:]:
            discard(path)
        del _WRITTEN[first:]


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Add the intermediate tables that are written inside to ``paths``."""
    first = len(_WRITTEN)
    yield
    paths.extend(_WRITTEN[first:])


def discard_unread(paths: list[str], df: DataFrame) -> None:
    """Delete the tables of ``paths`` that ``df`` does not read, and take them off the list."""
    files = df.inputFiles()
    read = [p for p in paths if any(p.rsplit("/", 1)[-1] in f for f in files)]
    for path in paths:
        if path not in read:
            discard(path)
    paths[:] = read


def discard(path: str) -> None:
    """Delete a table that ``materialize`` wrote; in a store that cannot be reached from here it stays."""
    try:
        store, root = fs.FileSystem.from_uri(path if ":" in path else "file://" + path)
        if store.get_file_info(root).type == fs.FileType.Directory:
            store.delete_dir(root)
    except (ArrowException, OSError) as e:
        warnings.warn(f"{path} was not deleted: {e}", stacklevel=2)


def local_session(cores: str = "8", name: str = "clickloom") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickloom-"))
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="clickloom-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    The table also has a size Spark knows, so that joins with it are planned by that size.
    """
    path = new_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def materialize_parts(df: DataFrame, part: str, values: Sequence[str], name: str) -> dict[str, DataFrame]:
    """The same for a table with a part column: one write, one table per part value."""
    spark = df.sparkSession
    path = new_path(spark, name)
    _WRITTEN.append(path)
    df.write.partitionBy(part).parquet(path)
    schema = df.drop(part).schema

    def table(value: str) -> DataFrame:
        folder = f"{path}/{part}={value}"
        return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)

    return {v: table(v) for v in values}
