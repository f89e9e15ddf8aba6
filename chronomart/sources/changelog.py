"""Reading and writing change logs and source tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.times import utc_now
from chronomart.operators.envelope import FIELDS, with_capture_date
from chronomart.schemas import CORRUPT, ENVELOPE, SOURCE_TABLES, extend

STORED = extend(ENVELOPE, event_date=T.DateType())
PARTITIONS = ["table", "event_date"]
#: Batch id of what ``write_bronze`` appends; micro-batches count from 0.
APPENDED = -1


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.getFileStatus(where).isDirectory()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes one partition folder of a table; nothing happens when there is none."""
    files, where = _folder(spark, path)
    files.delete(where, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when there is no folder."""
    files, where = _folder(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all. An existing one is an error."""
    files, where = _folder(spark, path)
    part = where.suffix(".part")
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(where) or not files.rename(part, where):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _folder(spark, path)
    jvm = spark.sparkContext._jvm
    into = files.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(into, "UTF-8")
    finally:
        into.close()


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned Parquet table with a declared schema; empty when there is no folder."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.fieldNames())


def read_changes(
    spark: SparkSession, path: str, table: str | None = None, fmt: str = "parquet", malformed: str = "fail"
) -> DataFrame:
    """Change events below ``path``; a missing folder is an empty log.

    ``parquet``  the layout of ``write_bronze``: ``table=`` reads one folder.
    ``json``     one folder per table with ``.json`` or ``.jsonl`` files, one event per line,
    blank lines skipped.
    ``malformed`` ``fail`` stops the read at a bad line; ``keep`` adds the line as
    ``_corrupt_record`` for ``validate_envelope``.
    """
    if fmt == "parquet":
        log = read_stored(spark, path, STORED)
        return log if table is None else log.filter(F.col("table") == table)
    if fmt != "json":
        raise ValueError(f"fmt must be parquet or json, not {fmt!r}")
    folder = path if table is None else f"{path.rstrip('/')}/{table}"
    schema = ENVELOPE if malformed == "fail" else extend(ENVELOPE, **{CORRUPT: T.StringType()})
    if not _exists(spark, folder):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    if malformed == "fail":
        reader = reader.option("mode", "FAILFAST")
    else:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(folder)


def read_changes_since(log: DataFrame, high_water_mark: int) -> DataFrame:
    """Events after the mark. Apply ``orderBy("change_id")`` where order matters.

    For logs of one id sequence that arrive in its order. ``read_unprocessed`` does
    without that: ids may come late, be counted per table, or be absent.
    """
    return log.filter(F.col("change_id") > F.lit(high_water_mark))


def _digest() -> Column:
    """Digest of the content of an event without an id; null for all others."""
    images = [F.array_sort(F.map_entries(F.col(c))).alias(c) if c in ("before", "after") else F.col(c) for c in FIELDS]
    content = F.to_json(F.struct(*images), {"ignoreNullFields": "false"})
    return F.when(F.col("change_id").isNull(), F.sha2(content, 256))


def processed_marks(log: DataFrame) -> DataFrame:
    """(table, change_id, digest) of events, to be kept by the reader."""
    return log.select("table", "change_id", _digest().alias("digest"))


def read_unprocessed(log: DataFrame, marks: DataFrame) -> DataFrame:
    """Events of ``log`` that ``marks`` (from ``processed_marks``) doesn't hold, late and small ids included.

    An event is known by table and id, or by its content where it has no id: equal
    events without an id count as one delivery.
    """
    names = ("table", "change_id", "digest")
    seen = marks.select(*[F.col(c).alias(f"_m_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in names]
    return log.withColumn("digest", _digest()).join(seen, same, "left_anti").select(*log.columns)


def high_water_mark(log: DataFrame) -> int:
    """Largest ``change_id`` of a log, 0 when it is empty."""
    return log.agg(F.max("change_id")).first()[0] or 0


def read_source(
    spark: SparkSession,
    table: str,
    path: str | None = None,
    url: str | None = None,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    options: dict | None = None,
) -> DataFrame:
    """A source table from Parquet or JDBC. JDBC reads are split on ``key`` over ``bounds``, so both are needed."""
    if path is not None:
        reader = spark.read
        if table in SOURCE_TABLES:
            reader = reader.schema(SOURCE_TABLES[table])
        return reader.parquet(path)
    if key is None or bounds is None:
        raise ValueError("a JDBC read needs key and bounds, else one task reads the whole table")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    return (
        reader.option("partitionColumn", key)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


def read_change_topic(spark: SparkSession, options: dict) -> DataFrame:
    """Message values of a change topic as a text stream for the envelope parsers."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A warehouse table, or None when there is none (``row_counts`` shows it as 0)."""
    try:
        return spark.table(name)
    except AnalysisException:
        return None


def write_bronze(log: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append events by table and capture date.

    The rebalance hint lets AQE join small partitions into one file and cut a hot
    (table, date) into several.
    """
    rows = with_capture_date(log.select(*FIELDS)).hint("rebalance", *[F.col(c) for c in PARTITIONS])
    rows = rows.withColumn("batch_id", F.lit(APPENDED).cast("bigint"))
    rows.write.partitionBy(*PARTITIONS, "batch_id").mode("append").format(fmt).save(path)


def bronze_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("table").agg(F.count(F.lit(1)).alias("events"))


def raw_events(log: DataFrame) -> DataFrame:
    """The log as a raw table: images as JSON text, with load time."""
    return log.select(
        "change_id", F.col("table").alias("table_name"), "operation",
        F.to_json("before").alias("before_state"), F.to_json("after").alias("after_state"),
        "captured_at", utc_now().alias("loaded_at"),
    )


def write_raw_events(log: DataFrame, path: str) -> None:
    raw_events(log).write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Full refresh: the table holds the rows of ``df`` and nothing else, however often it runs."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """A catalog table cut by ``keys`` into ``buckets``, one sorted file each: joins and groups by these keys don't shuffle.

    Tables that meet in a join take the same number of buckets. A bucket is one task,
    which no runtime plan splits, so the keys should be those of entities, not hot ones.
    """
    placed = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    placed.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """A model as a temp view, a catalog table, or a Parquet table at ``path``."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"kind must be table or view, not {kind!r}")
    if path is None:
        df.write.mode("overwrite").saveAsTable(name)
        return spark.table(name)
    stored = refresh(df, path)
    stored.createOrReplaceTempView(name)
    return spark.table(name)
