"""Trusted tables bucketed by customer and invoice.

Rows lie in as many buckets as the table was made with, by the hash a shuffle would use, so that what
matches or counts by customer and invoice works where the rows lie. Spark knows buckets only of tables in a catalog;
a table is declared there over its folder, under a name made from its place. A key with more rows
than a bucket should hold would fill its bucket, so the rows of such hot keys lie apart, spread evenly.
"""

from __future__ import annotations

from hashlib import md5
from math import ceil
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario.operators.joins import KEYS
from mensario.schemas import TRUSTED
from mensario.sources import runs
from mensario.sources.tables import APPEND, REPLACE_MONTHS

#: Partition folder that tells rows of hot keys from the others.
HOT = "quente"
#: Rows a task of a write is to hold, for it sorts them by month and bucket.
TASK_ROWS = 1_000_000
#: Rows of a bucket over all months that ``buckets_for`` allows, for a join sorts a bucket of the months it reads.
BUCKET_ROWS = 4_000_000
_PARTITIONS = ("ref", "dt_proc", runs.TRY, HOT)


def _columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.name not in _PARTITIONS]


def _declared(spark: SparkSession, schema: T.StructType, path: str, buckets: int) -> str:
    """The name of the table over ``path``; its folders are listed when it is read, not kept in the catalog."""
    name = f"mensario_{md5(path.encode()).hexdigest()[:16]}_{buckets}"
    columns = ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in _columns(schema))
    kept = spark.conf.get("spark.sql.hive.manageFilesourcePartitions")
    spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    try:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, ref STRING, dt_proc STRING, {runs.TRY} STRING, {HOT} INT) USING parquet "
            f"PARTITIONED BY ({', '.join(_PARTITIONS)}) CLUSTERED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    finally:
        spark.conf.set("spark.sql.hive.manageFilesourcePartitions", kept)
    spark.catalog.refreshTable(name)
    return name


def buckets_for(rows: int, least: int) -> int:
    """``least`` doubled until no average bucket holds more than ``BUCKET_ROWS`` rows."""
    buckets = least
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def hot_keys(rows: DataFrame, buckets: int, total: int | None = None) -> DataFrame:
    """The keys that hold more rows than an average bucket: fewer than ``buckets``, whatever the rows. ``total`` is their number, if known."""
    counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where(" and ".join(f"{k} is not null" for k in KEYS))
    if total is not None:
        return counts.where(F.col("n") * buckets > total).select(*KEYS)
    most = rows.agg((F.count(F.lit(1)) / buckets).alias("most"))
    return counts.join(F.broadcast(most), F.col("n") > F.col("most")).select(*KEYS)


def bucket_of(buckets: int) -> Column:
    """The bucket of a row, as the table has it."""
    return F.pmod(F.hash(*KEYS), F.lit(buckets))


def write_trusted_bucketed(rows: DataFrame, subject: str, path: str, dt_proc: str, buckets: int, mode: str = APPEND) -> int:
    """As ``write_trusted``, into buckets, for rows in any order. All runs of a table need the same number of them.

    A task writes a bucket in some of the months, the fewer the more rows there are, and a part of the hot rows; so a month has about as
    many files as buckets, and tasks grow with the rows. ``buckets`` should leave a few hundred MB of a month in each. One job counts the rows.
    """
    spark, attempt = rows.sparkSession, uuid4().hex
    earlier = {run["baldes"] for run in runs.records(spark, path)}
    if earlier - {buckets}:
        raise ValueError(f"{path} has runs of {sorted(earlier, key=str)} buckets, not {buckets}")
    runs.remove_hidden(spark, path, dt_proc)
    total = rows.count()
    hot = F.broadcast(hot_keys(rows.select(*KEYS), buckets, total).withColumn(HOT, F.lit(1)))
    marked = rows.join(hot, list(KEYS), "left").withColumn(HOT, F.coalesce(HOT, F.lit(0)))
    shares = max(1, ceil(total / (buckets * TASK_ROWS)))
    own = bucket_of(buckets) * shares + F.pmod(F.hash("ref"), F.lit(shares))
    spread = F.pmod(F.xxhash64(*_columns(TRUSTED[subject])), F.lit(buckets * shares))
    placed = marked.withColumn("_task", F.when(F.col(HOT) == 0, own).otherwise(spread.cast("int")))
    columns = [*_columns(TRUSTED[subject]), "ref", "dt_proc"]
    stored = placed.repartitionById(buckets * shares, "_task").select(*columns, F.lit(attempt).alias(runs.TRY), HOT)
    name = _declared(spark, TRUSTED[subject], path, buckets)
    written = Observation()
    stored = stored.observe(written, F.count(F.lit(1)).alias("rows"))
    stored.write.format("parquet").partitionBy(*_PARTITIONS).bucketBy(buckets, *KEYS).mode("append").saveAsTable(name)
    runs.record(spark, path, dt_proc, attempt, mode == REPLACE_MONTHS, buckets)
    return written.get["rows"]


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a table, None if it has none."""
    return next((run["baldes"] for run in runs.records(spark, path)), None)


def scan_trusted_bucketed(spark: SparkSession, subject: str, path: str) -> DataFrame:
    """The rows of the runs that count, with ``HOT``."""
    buckets = buckets_of(spark, path)
    if buckets is None:
        raise ValueError(f"{path} is not bucketed")
    name = _declared(spark, TRUSTED[subject], path, buckets)
    return spark.table(name).where(runs.counting(spark, path)).select(*TRUSTED[subject].fieldNames(), HOT)


def hot_column(spark: SparkSession, *paths: str) -> str | None:
    """``HOT`` if any of the tables has rows of hot keys, from the names of their folders alone."""
    return HOT if any(runs.folders(spark, f"{path}/ref=*/dt_proc=*/{runs.TRY}=*/{HOT}=1") for path in paths) else None
