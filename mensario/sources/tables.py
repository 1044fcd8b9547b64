"""Scans and sinks.

Every scan declares its schema, so ``ref`` and ``dt_proc`` stay text although they
are partition folders, and no read infers anything from the data. A scan of a table that runs
write holds the runs that count when it is made, see ``runs``.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario import fixed_values as fv
from mensario.operators.features import BOOK_GRID
from mensario.schemas import STAGE, TRUSTED
from mensario.sources import runs

APPEND = "append"
REPLACE_MONTHS = "replace_months"


def scan_parquet(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def scan_parquet_or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """As ``scan_parquet``; a table nobody has written yet has no rows."""
    try:
        return scan_parquet(spark, schema, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_runs(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The rows of the table's runs that count; a table of which no run has finished has none."""
    stored = T.StructType([*schema.fields, T.StructField(runs.TRY, T.StringType())])
    return scan_parquet(spark, stored, path).where(runs.counting(spark, path)).select(*schema.fieldNames())


def scan_trusted(spark: SparkSession, subject: str, path: str) -> DataFrame:
    return scan_runs(spark, TRUSTED[subject], path)


def scan_faturas(spark: SparkSession, path: str) -> DataFrame:
    return scan_trusted(spark, fv.SUBJECT_FATURAS, path)


def scan_pagamentos(spark: SparkSession, path: str) -> DataFrame:
    return scan_trusted(spark, fv.SUBJECT_PAGAMENTOS, path)


def scan_stage(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    if missing_ok and not runs.records(spark, path):
        return spark.createDataFrame([], STAGE)
    return scan_runs(spark, STAGE, path)


def book_schema() -> T.StructType:
    """The stored book's columns; an aggregate widens its value's type the way Spark's own does."""
    fields = [
        T.StructField("id_cliente", T.LongType()),
        T.StructField("ref", T.StringType()),
        T.StructField("dt_proc", T.StringType()),
    ]
    for feature in BOOK_GRID.features():
        base = STAGE[feature.value].dataType
        decimal = isinstance(base, T.DecimalType)
        if feature.agg == "sum":
            kind = T.DecimalType(base.precision + 10, base.scale) if decimal else T.LongType()
        elif feature.agg == "avg":
            kind = T.DecimalType(base.precision + 4, base.scale + 4) if decimal else T.DoubleType()
        else:
            kind = base
        fields.append(T.StructField(feature.name, kind))
    return T.StructType(fields)


def scan_book(spark: SparkSession, path: str) -> DataFrame:
    return scan_runs(spark, book_schema(), path)


def balance_by(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by ``columns`` into files of about the advisory size.

    Unlike a plain repartition by month this splits a month too large for one task
    and joins months too small for a file of their own.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def _write_run(
    df: DataFrame,
    path: str,
    dt_proc: str,
    mode: str,
    months: list[str] | None = None,
    sources: dict[str, str | None] | None = None,
    ref: Column | None = None,
    **options: str,
) -> int:
    """Parquet by month, run and try, then the run's record; returns how many rows. They count from the record on, instead of
    those of an earlier try under the same stamp, and with ``replace_months`` instead of all other runs of the months.

    What earlier runs have hidden is removed first. The rows are counted by the job that writes them. ``ref`` is the month, a constant, if
    all rows are of one and of ``dt_proc``: as constants behind the count, the partition columns need no sort of a task's rows.
    """
    spark, attempt, written = df.sparkSession, uuid4().hex, Observation()
    if any(run["baldes"] for run in runs.records(spark, path)):
        raise ValueError(f"{path} is bucketed")
    runs.remove_hidden(spark, path, dt_proc)
    constants = {runs.TRY: F.lit(attempt)} | ({} if ref is None else {"ref": ref, "dt_proc": F.lit(dt_proc)})
    rows = df.observe(written, F.count(F.lit(1)).alias("rows")).withColumns(constants)
    rows.write.partitionBy("ref", "dt_proc", runs.TRY).mode("append").options(**options).parquet(path)
    runs.record(spark, path, dt_proc, attempt, mode == REPLACE_MONTHS, months=months, sources=sources)
    return written.get["rows"]


def write_trusted(df: DataFrame, path: str, dt_proc: str, mode: str = APPEND) -> int:
    """Expects balanced rows, see ``balance_by``. ``append`` adds a run beside earlier ones."""
    return _write_run(df, path, dt_proc, mode)


def write_stage(df: DataFrame, path: str, dt_proc: str, mode: str = APPEND, ref: Column | None = None) -> int:
    """A run has one ``ref``, so there is nothing to gather before writing; given, there is nothing to sort."""
    return _write_run(df, path, dt_proc, mode, ref=ref)


def write_book(df: DataFrame, path: str, dt_proc: str, mode: str = APPEND, ref: Column | None = None) -> int:
    """``ref`` as in ``write_stage``. A Bloom filter per row group, sized to what it holds, lets the lookup of one customer
    skip nearly all of a table that is spread by hash of the customer."""
    bloom = {"parquet.bloom.filter.enabled#id_cliente": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    return _write_run(df, path, dt_proc, mode, ref=ref, **bloom)


def write_states(df: DataFrame, path: str, dt_proc: str, months: list[str], sources: dict[str, str | None]) -> int:
    """States in place of all earlier ones of ``months``, with what each month was made from."""
    return _write_run(df, path, dt_proc, REPLACE_MONTHS, months, sources)
