"""Source files to the raw zone, each version exactly once, with a control row per file.

A file is known by its full path, modification time and length. A version not landed
before comes with the next batch; under a path landed before it supersedes the earlier
rows. A batch writes data first and control after it, to folders named after its
number, so folders are as many as batches, not files; every row carries its file's id. A batch that
failed is not in the control table, so the next one takes its number and replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario.schemas import LANDED_FILE, PROCESSED_FILE, RAW
from mensario.sources.files import Delivery, list_files, read_by_header, to_files
from mensario.sources.lake import Lake
from mensario.sources.tables import scan_parquet_or_empty

_VERSION = ["arquivo", "modificado", "tamanho"]
LANDED_FILE_VERSION = T.StructType([LANDED_FILE[c] for c in _VERSION])


class NothingToProcess(Exception):
    """No landed file is waiting for this subject."""


def _prepare(spark: SparkSession, lake: Lake, subject: str) -> None:
    """Empty control tables where there are none, so that a gate can read them."""
    for schema, partition, path in (
        (LANDED_FILE, "lote", lake.raw_control(subject)),
        (PROCESSED_FILE, "consumidor", lake.processed_files),
    ):
        spark.createDataFrame([], schema).write.mode("ignore").partitionBy(partition).parquet(path)


def file_id(arquivo: str = "arquivo") -> F.Column:
    return F.md5(F.col(arquivo).cast("binary"))


def _write_batch(rows: DataFrame, files: DataFrame, lake: Lake, subject: str, lote: str) -> None:
    """``files`` has a row for each file of the batch, ``rows`` what they hold.

    A task writes the rows of its source files one file after another, so files of rows are as many as
    tasks and a source file's rows stand together. Control rows count them from their ids as written.
    """
    spark, path = rows.sparkSession, f"{lake.raw_data(subject)}/lote={lote}"
    rows.select(*RAW[subject].fieldNames(), file_id().alias("arquivo_id")).write.mode("overwrite").parquet(path)
    ids = spark.read.schema("arquivo_id string").parquet(path)
    counts = ids.groupBy("arquivo_id").agg(F.count(F.lit(1)).alias("n"))
    control = files.withColumn("arquivo_id", file_id()).join(counts, "arquivo_id", "left").select(
        F.lit(subject).alias("tb_name"), *_VERSION, F.coalesce("n", F.lit(0)).cast("long").alias("qtd_registros")
    )
    control.coalesce(1).write.mode("overwrite").parquet(f"{lake.raw_control(subject)}/lote={lote}")


def land_files(spark: SparkSession, lake: Lake, subject: str, source: str | Delivery) -> None:
    """Land what ``source`` holds in versions not landed before; a second run adds nothing."""
    source = source if isinstance(source, Delivery) else Delivery(source)
    _prepare(spark, lake, subject)
    landed = landed_files(spark, lake, subject)
    fresh = list_files(spark, source.folder, name=source.name).join(landed.select(*_VERSION), _VERSION, "left_anti")
    files = to_files(fresh)
    if not files:
        return
    last = landed.agg(F.max("lote")).first()[0]
    lote = f"s{int(last[1:]) + 1 if last else 0:09d}"
    # as listed just now: a file that arrives meanwhile waits for the next batch
    manifest = spark.createDataFrame([(f.arquivo, f.modificado, f.tamanho) for f in files], LANDED_FILE_VERSION)
    _write_batch(read_by_header(spark, subject, files), manifest, lake, subject, lote)


def landed_files(spark: SparkSession, lake: Lake, subject: str) -> DataFrame:
    return scan_parquet_or_empty(spark, LANDED_FILE, lake.raw_control(subject))


def _by_age(spark: SparkSession, lake: Lake, subject: str) -> DataFrame:
    """Landed files with ``_n``, 1 for the version of its path that landed last."""
    newest = Window.partitionBy("arquivo").orderBy(F.col("lote").desc(), F.col("modificado").desc())
    return landed_files(spark, lake, subject).withColumn("_n", F.row_number().over(newest))


def current_files(spark: SparkSession, lake: Lake, subject: str) -> DataFrame:
    """Of each path the version landed last."""
    return _by_age(spark, lake, subject).where("_n = 1").drop("_n")


def scan_raw(spark: SparkSession, lake: Lake, subject: str, lotes: list[str] | None = None) -> DataFrame:
    """The landed rows, without those of superseded files; of all batches or of ``lotes`` alone.

    Rows of a batch without control rows do not count. Superseded files are few, the others are not joined.
    """
    finished_lotes = pending_batches(landed_files(spark, lake, subject))
    lotes = finished_lotes if lotes is None else [n for n in finished_lotes if n in set(lotes)]
    superseded = _by_age(spark, lake, subject).where("_n > 1").select("lote", file_id().alias("arquivo_id"))
    schema = T.StructType([*RAW[subject].fields, T.StructField("arquivo_id", T.StringType()), T.StructField("lote", T.StringType())])
    rows = scan_parquet_or_empty(spark, schema, lake.raw_data(subject)).where(F.col("lote").isin(lotes))
    return rows.join(superseded, ["lote", "arquivo_id"], "left_anti").select(*RAW[subject].fieldNames())


def pending_files(spark: SparkSession, lake: Lake, subject: str, consumer: str | None = None) -> DataFrame:
    """Landed files of ``subject`` that ``consumer`` (by default the trusted run) has not used."""
    done = scan_parquet_or_empty(spark, PROCESSED_FILE, lake.processed_files).where(
        (F.col("consumidor") == (consumer or subject)) & (F.col("tb_name") == subject)
    )
    return landed_files(spark, lake, subject).join(done, ["lote", "arquivo"], "left_anti").select(
        *LANDED_FILE.fieldNames()
    )


def pending_batches(pending: DataFrame) -> list[str]:
    """Names of the batches the files came in: one per landing run, not per file or row."""
    return [row["lote"] for row in pending.select("lote").distinct().orderBy("lote").collect()]


def waiting_files(spark: SparkSession, lake: Lake, subject: str, consumer: str | None = None) -> DataFrame:
    """The pending files of the batches there now; a batch landed later is not among them. Runs one job."""
    pending = pending_files(spark, lake, subject, consumer)
    return pending.where(F.col("lote").isin(pending_batches(pending)))


def require_pending(spark: SparkSession, lake: Lake, subject: str, consumer: str | None = None) -> DataFrame:
    """The gate of a run: its waiting files, or ``NothingToProcess``."""
    waiting = waiting_files(spark, lake, subject, consumer)
    if waiting.isEmpty():
        raise NothingToProcess(f"no landed file of {subject} is waiting for {consumer or subject}")
    return waiting


def finished(spark: SparkSession, lake: Lake, consumer: str, dt_proc: str) -> bool:
    """Whether ``consumer`` has recorded a run under this stamp."""
    done = scan_parquet_or_empty(spark, PROCESSED_FILE, lake.processed_files)
    return not done.where((F.col("consumidor") == consumer) & (F.col("dt_proc") == dt_proc)).isEmpty()


def mark_processed(pending: DataFrame, lake: Lake, consumer: str, dt_proc: str) -> None:
    """Record that ``consumer`` has used the files, so that they no longer open its gate."""
    rows = pending.select("tb_name", "lote", "arquivo", F.lit(dt_proc).alias("dt_proc"))
    rows = rows.withColumn("consumidor", F.lit(consumer))
    rows.write.mode("append").partitionBy("consumidor").parquet(lake.processed_files)
