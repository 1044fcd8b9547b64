"""Joined rows to the stage table: classes, percentage paid, days late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions import classify
from mensario.functions.period import Period


def with_payment_class(joined: DataFrame) -> DataFrame:
    return joined.withColumn("fbc_classif_pagto", classify.payment_timing())


def with_amount_class(joined: DataFrame) -> DataFrame:
    return joined.withColumn("fbc_classif_vlr_pagto", classify.payment_amount())


def with_percent_paid(classified: DataFrame) -> DataFrame:
    return classified.withColumn("fvl_perc_vlr_fatura", classify.percent_paid())


def with_days_late(classified: DataFrame, period: Period) -> DataFrame:
    return classified.withColumn("fvl_numero_dias_atraso", classify.days_late(period))


def build_stage(joined: DataFrame, period: Period, dt_proc: str) -> DataFrame:
    rows = (
        joined.transform(with_payment_class)
        .transform(with_amount_class)
        .transform(with_percent_paid)
        .transform(with_days_late, period)
    )
    return rows.select(
        "id_cliente",
        period.ref.alias("ref"),
        F.lit(dt_proc).alias("dt_proc"),
        "fbc_classif_pagto",
        "fbc_classif_vlr_pagto",
        "dt_emissao",
        F.col("vlr_fatura").alias("fvl_vlr_fatura"),
        F.col("vlr_pagamento").alias("fvl_vlr_pagto"),
        F.col("vlr_pagto_min").alias("fvl_vlr_pagto_min"),
        "fvl_perc_vlr_fatura",
        "fvl_numero_dias_atraso",
        F.lit(1).alias("fvl_qtd_transacao"),
    )


def with_window_flags(
    stage: DataFrame, period: Period, windows: tuple[int, ...] = fv.JANELAS_MESES
) -> DataFrame:
    """One 0/1 column per look-back window; windows nest, so a set flag stays set in longer ones."""
    return stage.withColumns(
        {classify.window_flag_name(m): classify.window_flag(period, m) for m in windows}
    )
