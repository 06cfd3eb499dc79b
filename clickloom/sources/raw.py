"""Landing of raw files: CSV logs, zipped dimension files, day-partitioned parquet."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickloom.session import materialize

EVENT_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in [
        ("userid", T.LongType()), ("adgroup_id", T.LongType()), ("time_stamp", T.TimestampType()), ("pid", T.StringType()),
        ("click", T.IntegerType()), ("cate_id", T.LongType()), ("campaign_id", T.LongType()), ("customer", T.LongType()),
        ("brand", T.DoubleType()), ("price", T.DoubleType()), ("date", T.StringType()), ("hour", T.IntegerType()),
        ("weekday", T.IntegerType()),
    ]
])
AD_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in [
        ("adgroup_id", T.LongType()), ("cate_id", T.LongType()), ("campaign_id", T.LongType()), ("customer", T.LongType()),
        ("brand", T.DoubleType()), ("price", T.DoubleType()),
    ]
])
USER_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in [
        ("userid", T.LongType()), ("cms_segid", T.LongType()), ("cms_group_id", T.LongType()),
        ("final_gender_code", T.LongType()), ("age_level", T.LongType()), ("pvalue_level", T.DoubleType()),
        ("shopping_level", T.LongType()), ("occupation", T.LongType()), ("new_user_class_level", T.DoubleType()),
    ]
])
IN_MEMORY = 1 << 30     # bytes of a zip archive that a task takes into memory
MOST_TASKS = 10_000     # that read members of archives; beyond it each reads several
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def trimmed(df: DataFrame) -> DataFrame:
    """Column names without surrounding spaces."""
    return df.toDF(*[c.strip() for c in df.columns])


def tagged(df: DataFrame, split: str | None, ingested_at: Column) -> DataFrame:
    """Lineage columns: split, source file and the one instant of the run."""
    out = df.withColumns({"_source_file": F.col("_metadata.file_name"), "_ingested_at": ingested_at})
    return out if split is None else out.withColumn("_split", F.lit(split))


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; columns are matched by trimmed name, unknown ones stay text."""
    types = {f.name: f.dataType for f in schema}
    names = [c.strip() for c in _header(spark, path)]
    actual = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    reader = spark.read.schema(actual).option("header", True).option("enforceSchema", True)
    return reader.option("timestampFormat", TIMESTAMP_FORMAT).option("mode", "FAILFAST").csv(path)


def landed(df: DataFrame, split: str | None, ingested_at: Column) -> DataFrame:
    """Add lineage and the position of each row in its source."""
    place = {"_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
    return tagged(df.withColumns(place), split, ingested_at)


def _opened(path: str, content: bytes | None):
    """An archive as a file that can be sought: from memory, or from its store if it is too large for that."""
    if content is not None:
        return io.BytesIO(content)
    store, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return store.open_input_file(inner)


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The CSV members of archives in order of name, with their columns; reads directories and first lines."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with _opened(path, content) as file, zipfile.ZipFile(file) as archive:
                members = sorted(m for m in archive.namelist() if m.endswith(".csv"))
                for place, name in enumerate(members):
                    with archive.open(name) as raw:
                        columns = [c.strip() for c in pd.read_csv(raw, dtype=str, nrows=0).columns]
                    yield pd.DataFrame({"path": [path], "member": [name], "place": [place], "members": [len(members)], "columns": [columns]})


def whole_number(text: Column) -> Column:
    """Text as bigint without a detour over floats; "3.0" is 3, any other fraction or text is an error."""
    plain = F.regexp_replace(F.trim(text), r"\.0*$", "")
    return F.when(F.trim(text) == "", F.lit(None)).otherwise(plain).cast("bigint")


def read_zipped_csv(spark: SparkSession, path: str, schema: T.StructType, rows_per_batch: int = 50_000) -> DataFrame:
    """CSV members of zip files, streamed out of each archive in batches.

    Columns are matched by trimmed name, unknown ones stay text. Every member is a task of its own,
    which seeks it in the archive's store; ``_block`` is its place among the members, ``_row`` the row
    within. A member cannot be split: lay large inputs out as many members or archives, or as plain, gz or
    bz2 files, which ``read_csv`` takes directly. Archives of one member are taken into memory as a
    whole up to ``IN_MEMORY``.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= IN_MEMORY).select("path", "content")
    large = files.where(F.col("length") > IN_MEMORY).select("path", F.lit(None).cast("binary").alias("content"))
    listing = small.unionByName(large).mapInPandas(_listed, "path string, member string, place bigint, members bigint, columns array<string>")
    listing = materialize(listing, "members")
    found = {r[0] for r in listing.select(F.explode("columns")).distinct().collect()}
    types = {f.name: f.dataType for f in schema}
    names = [*types, *sorted(found - set(types))]
    out = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_block", T.LongType()), T.StructField("_row", T.LongType())] + [
        T.StructField(n, T.StringType()) for n in names
    ])
    place = ["path", "member", "place"]
    whole = small.join(listing.where("members = 1").select(*place), "path")
    apart = listing.select(*place).join(whole.select("path"), "path", "left_anti")
    apart = apart.coalesce(1).repartition(max(1, min(apart.count(), MOST_TASKS)))
    archives = whole.unionByName(apart.withColumn("content", F.lit(None).cast("binary")))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content, member, block in zip(batch["path"], batch["content"], batch["member"], batch["place"]):
                number = 0
                with _opened(path, content) as file, zipfile.ZipFile(file) as archive, archive.open(member) as raw:
                    for chunk in pd.read_csv(raw, dtype=str, chunksize=rows_per_batch, skipinitialspace=True):
                        chunk.columns = [c.strip() for c in chunk.columns]
                        chunk = chunk.reindex(columns=names)
                        chunk.insert(0, "_row", range(number, number + len(chunk)))
                        chunk.insert(0, "_block", block)
                        chunk.insert(0, "_file", path.rsplit("/", 1)[-1])
                        number += len(chunk)
                        yield chunk.astype(object).where(chunk.notna(), None)

    text = archives.mapInPandas(rows, out)
    typed = [
        (whole_number(F.col(f"`{n}`")) if isinstance(types.get(n), T.LongType) else F.col(f"`{n}`").cast(types.get(n, T.StringType()))).alias(n)
        for n in names
    ]
    return text.select(*typed, F.col("_file").alias("_source_file"), "_block", "_row")


def read_dimension(spark: SparkSession, path: str, schema: T.StructType, ingested_at: Column) -> DataFrame:
    """A dimension file, zipped or not, with trimmed names and lineage."""
    if path.endswith(".zip"):
        return read_zipped_csv(spark, path, schema).withColumn("_ingested_at", ingested_at)
    return landed(read_csv(spark, path, schema), None, ingested_at)


def read_events(spark: SparkSession, folder: str, ingested_at: Column, splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """The split files of the log, stacked by column name; ``_source_no`` is the file's place in ``splits``."""
    frames = [
        landed(read_csv(spark, f"{folder}/{s}.csv", EVENT_SCHEMA), s, ingested_at).withColumn("_source_no", F.lit(n))
        for n, s in enumerate(splits)
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def write_days(df: DataFrame, path: str, day: str = "date") -> None:
    """One ``dt=YYYY-MM-DD`` folder per day; the day column also stays inside the files.

    Rows are spread by day and a hash, so that a full day is written by several tasks.
    """
    spark = df.sparkSession
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    rows = df.withColumn("dt", F.col(day).cast("string"))
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    rows.repartition("dt", slot).write.partitionBy("dt").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def now() -> Column:
    return F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
