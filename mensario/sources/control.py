"""Audit rows of the trusted runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensario.schemas import CONTROL
from mensario.sources.tables import scan_parquet


def control_row(spark: SparkSession, tb_name: str, dt_proc: str, qtd_registros: int) -> DataFrame:
    """Table, run and row count, all as text. The count comes from the write it belongs to."""
    return spark.range(1).select(
        F.lit(tb_name).alias("tb_name"),
        F.lit(dt_proc).alias("dt_proc"),
        F.lit(str(qtd_registros)).alias("qtd_registros"),
    )


def write_control(row: DataFrame, path: str) -> None:
    """A run's own folder, so a repeated run replaces its row."""
    row.write.mode("overwrite").parquet(path)


def scan_control(spark: SparkSession, path: str) -> DataFrame:
    return scan_parquet(spark, CONTROL, path)
