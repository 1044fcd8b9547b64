"""What several operators share: tables, written intermediate results, bounded samples."""

from __future__ import annotations

import gc
import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local: tempfile.TemporaryDirectory | None = None

#: Held-out share: rows whose crc32 of the id leaves 0 are never learnt from.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    _local = _local or tempfile.TemporaryDirectory(prefix="mensario-llm-")
    return _local.name


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, no lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/mensario-llm/{uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove the files of tables that ``cut`` wrote and nothing reads any more, and those of shuffles nothing refers to.

    Spark removes a shuffle's files once the driver's JVM has collected what stood for it; so have it collect.
    """
    for table in tables:
        for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
            location = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(location, True)
    gc.collect()
    for spark in {SparkSession.getActiveSession()} - {None}:
        spark._jvm.java.lang.System.gc()


def fold(doc_id: Column) -> Column:
    """0 for held-out rows, NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def stratified(df: DataFrame, stratum: str, key: str, per_stratum: int, max_strata: int = 4096) -> DataFrame:
    """About ``per_stratum`` rows of each value of ``stratum``, all rows of smaller ones; of the values beyond the
    ``max_strata`` commonest so many of all together. Rows without a value are left out.

    Chosen by a hash of ``key``, so repeated calls agree. Counts of the commonest values alone come to the driver.
    """
    df = df.where(F.col(stratum).isNotNull())
    rows = df.count()
    counts = df.groupBy(stratum).count().orderBy(F.desc("count"), stratum).limit(max_strata).collect()
    if not counts:
        return df.limit(0)
    rates = df.sparkSession.createDataFrame(
        [(row[0], min(1.0, per_stratum / row[1])) for row in counts], f"`{stratum}` {df.schema[stratum].dataType.simpleString()}, _rate double"
    )
    others = min(1.0, per_stratum / max(1, rows - sum(row[1] for row in counts)))
    share = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.join(F.broadcast(rates), stratum, "left").where(share < F.coalesce("_rate", F.lit(others))).select(*df.columns)


def slices(n_rows: int, rows_each: int, least: int, most: int) -> int:
    """A power of two: how many slices ``n_rows`` are dealt into."""
    n = least
    while n < most and n * rows_each < n_rows:
        n *= 2
    return n
