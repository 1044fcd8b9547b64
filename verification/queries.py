"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario import fixed_values as fv
from mensario.operators import inspection, joins, stage, trusted
from mensario.operators.book import book_of, build_features, tasks_for
from mensario.plans import incremental, monthly
from mensario.sources import bucketed, control, files, tables
from mensario.sources.lake import Lake
from mensario.streaming import landing
from verification import fixtures as fx
from verification.fixtures import AGAIN, DT_PROC, MONTH_BEFORE, PERIOD
from verification.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]
FATURAS, PAGAMENTOS = fv.SUBJECT_FATURAS, fv.SUBJECT_PAGAMENTOS
SAMPLE = 5


def portable(df: DataFrame) -> DataFrame:
    """The result in types two engines print alike: decimals as double, dates as text."""
    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        return col

    return df.select(*map(column, df.schema))


# Steps on the typed tables.


def faturas(spark: SparkSession, d: str) -> DataFrame:
    return inspection.in_period(fx.faturas(spark, d), PERIOD)


def pagamentos(spark: SparkSession, d: str) -> DataFrame:
    return inspection.in_period(fx.pagamentos(spark, d), PERIOD)


def joined(spark: SparkSession, d: str) -> DataFrame:
    return joins.join_faturas_pagamentos(faturas(spark, d), pagamentos(spark, d))


def with_payment_class(spark: SparkSession, d: str) -> DataFrame:
    return stage.with_payment_class(joined(spark, d))


def with_amount_class(spark: SparkSession, d: str) -> DataFrame:
    return stage.with_amount_class(joined(spark, d))


def with_percent(spark: SparkSession, d: str) -> DataFrame:
    return stage.with_percent_paid(with_amount_class(spark, d))


def with_days(spark: SparkSession, d: str) -> DataFrame:
    return stage.with_days_late(with_payment_class(spark, d), PERIOD)


def stage_rows(spark: SparkSession, d: str) -> DataFrame:
    return stage.build_stage(joined(spark, d), PERIOD, DT_PROC)


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return stage.with_window_flags(stage_rows(spark, d), PERIOD)


def book(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    return build_features(flagged(spark, d), tasks=tasks)


# Steps that go through files. Each run writes to a folder of its own.


def source_files(spark: SparkSession, d: str, subject: str) -> str:
    """The subject as CSV files, the way a source system would deliver them."""
    folder = f"{new_folder(spark)}/{subject}"
    fx.raw_of(spark, d, subject).write.option("header", True).csv(folder)
    return folder


def csv_scan(subject: str) -> Query:
    return lambda spark, d: files.scan_csv(spark, subject, source_files(spark, d, subject))


def csv_scan_reordered(spark: SparkSession, d: str) -> DataFrame:
    """Invoices from a file with its columns the other way round and one column too many."""
    folder = f"{new_folder(spark)}/{FATURAS}"
    raw = fx.raw_of(spark, d, FATURAS)
    raw.select(F.lit("x").alias("observacao"), *reversed(raw.columns)).write.option("header", True).csv(folder)
    return files.scan_csv(spark, FATURAS, folder)


def stored_trusted(spark: SparkSession, d: str, subject: str) -> str:
    folder = new_folder(spark)
    rows = trusted.TO_TRUSTED[subject](fx.raw_of(spark, d, subject), DT_PROC)
    tables.write_trusted(tables.balance_by(rows, "ref"), folder, DT_PROC)
    return folder


def trusted_scan(subject: str) -> Query:
    return lambda spark, d: tables.scan_trusted(spark, subject, stored_trusted(spark, d, subject))


def trusted_sink(subject: str, amount: str) -> Query:
    """What a reader finds per month folder, two appended runs included."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        folder = stored_trusted(spark, d, subject)
        for stamp in (AGAIN, AGAIN):  # a run repeated under its stamp counts once
            again = trusted.TO_TRUSTED[subject](fx.raw_of(spark, d, subject), stamp)
            tables.write_trusted(tables.balance_by(again, "ref"), folder, stamp)
        return (
            tables.scan_trusted(spark, subject, folder)
            .groupBy("ref")
            .agg(F.count(F.lit(1)).alias("qtd"), F.sum(amount).alias("total"))
        )

    return query


def stored_stage(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark)
    tables.write_stage(stage_rows(spark, d), folder, DT_PROC, ref=PERIOD.ref)
    return tables.scan_stage(spark, folder)


def stored_book(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark)
    tasks = tasks_for(spark, flagged(spark, d).count())
    tables.write_book(book(spark, d, tasks), folder, DT_PROC, ref=PERIOD.ref)
    return tables.scan_book(spark, folder)


def stored_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One customer out of the stored book."""
    return book_of(stored_book(spark, d), fx.CUSTOMER)


def trusted_lake(spark: SparkSession, d: str) -> Lake:
    """A lake with both trusted tables of one run."""
    lake = Lake(new_folder(spark))
    for subject in monthly.SUBJECTS:
        rows = trusted.TO_TRUSTED[subject](fx.raw_of(spark, d, subject), DT_PROC)
        tables.write_trusted(tables.balance_by(rows, "ref"), lake.trusted(subject), DT_PROC)
        landing._prepare(spark, lake, subject)
    return lake


def book_retry(spark: SparkSession, d: str) -> DataFrame:
    """A book whose first try ended after the stage was written, built again under the same stamp."""
    lake = trusted_lake(spark, d)
    tables.write_stage(stage_rows(spark, d), lake.stage, DT_PROC, ref=PERIOD.ref)
    return monthly.build_book(spark, lake, PERIOD, DT_PROC, gate=False)


def book_replaced(spark: SparkSession, d: str) -> DataFrame:
    """What stage and book hold for the month after a second run in place of the first."""
    lake = trusted_lake(spark, d)
    for stamp in (DT_PROC, AGAIN):
        monthly.build_book(spark, lake, PERIOD, stamp, tables.REPLACE_MONTHS, gate=False)
    stored = {"stage": tables.scan_stage(spark, lake.stage), "book": tables.scan_book(spark, lake.book)}
    parts = [df.groupBy("ref", "dt_proc").agg(F.count(F.lit(1)).alias("qtd")).withColumn("tabela", F.lit(name)) for name, df in stored.items()]
    return parts[0].unionByName(parts[1])


# Buckets at least; more as the tables grow.
BUCKETS = 8


def bucketed_sides(spark: SparkSession, d: str) -> tuple[list[DataFrame], str | None]:
    """Both trusted tables of the period, stored in buckets, and the column of hot rows if there are any."""
    lake = Lake(new_folder(spark))
    buckets = bucketed.buckets_for(max(fx.rows_of(spark, d, s) for s in monthly.SUBJECTS), BUCKETS)
    for subject in monthly.SUBJECTS:
        rows = trusted.TO_TRUSTED[subject](fx.raw_of(spark, d, subject), DT_PROC)
        bucketed.write_trusted_bucketed(rows, subject, lake.trusted(subject), DT_PROC, buckets)
    sides = [inspection.in_period(bucketed.scan_trusted_bucketed(spark, s, lake.trusted(s)), PERIOD) for s in monthly.SUBJECTS]
    return sides, bucketed.hot_column(spark, *(lake.trusted(s) for s in monthly.SUBJECTS))


def join_bucketed(spark: SparkSession, d: str) -> DataFrame:
    sides, hot = bucketed_sides(spark, d)
    return joins.join_stored(*sides, hot)


def repeated_bucketed(spark: SparkSession, d: str) -> DataFrame:
    sides, hot = bucketed_sides(spark, d)
    return inspection.repeats_stored(sides[1], hot)


def book_from_states(spark: SparkSession, d: str) -> DataFrame:
    """The book from states, most of which were made for the book of the month before."""
    lake = trusted_lake(spark, d)
    incremental.refresh_states(spark, lake, MONTH_BEFORE, AGAIN)
    return incremental.build_book(spark, lake, PERIOD, DT_PROC, gate=False)


def book_corrected(spark: SparkSession, d: str) -> DataFrame:
    """The book after half of the payments came late, from states made before and made again where these touch them."""
    lake = Lake(new_folder(spark))
    for subject in monthly.SUBJECTS:
        landing._prepare(spark, lake, subject)
    rows = {s: trusted.TO_TRUSTED[s](fx.raw_of(spark, d, s), DT_PROC) for s in monthly.SUBJECTS}
    early = F.col("id_pagamento") % 2 == 0
    tables.write_trusted(tables.balance_by(rows[FATURAS], "ref"), lake.trusted(FATURAS), DT_PROC)
    tables.write_trusted(tables.balance_by(rows[PAGAMENTOS].where(early), "ref"), lake.trusted(PAGAMENTOS), DT_PROC)
    incremental.refresh_states(spark, lake, PERIOD, DT_PROC)
    late = rows[PAGAMENTOS].where(~early).withColumn("dt_proc", F.lit(AGAIN))
    tables.write_trusted(tables.balance_by(late, "ref"), lake.trusted(PAGAMENTOS), AGAIN)
    return incremental.build_book(spark, lake, PERIOD, DT_PROC, gate=False)


def control_rows(spark: SparkSession, d: str) -> DataFrame:
    """Written and read back, one row per subject."""
    lake = Lake(new_folder(spark))
    names = {FATURAS: fv.TRUSTED_FATURAS, PAGAMENTOS: fv.TRUSTED_PAGAMENTOS}
    for subject, name in names.items():
        row = control.control_row(spark, name, DT_PROC, fx.raw_of(spark, d, subject).count())
        control.write_control(row, lake.trusted_control(subject, DT_PROC))
    stored = [control.scan_control(spark, lake.trusted_control(s, DT_PROC)) for s in names]
    return reduce(DataFrame.unionByName, stored)


def landed_lake(spark: SparkSession, d: str) -> Lake:
    """Both subjects landed, twice: the second run must add nothing."""
    lake = Lake(new_folder(spark))
    sources = {s: source_files(spark, d, s) for s in monthly.SUBJECTS}
    for _ in range(2):
        monthly.ingest(spark, lake, sources)
    return lake


def landing_ingest(subject: str) -> Query:
    """All landed rows of the subject, every column."""
    return lambda spark, d: landing.scan_raw(spark, landed_lake(spark, d), subject)


def landing_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """Invoices landed in parts, then delivered again under the same file names with a tenth of the amounts; only these count."""
    lake, source = Lake(new_folder(spark)), new_folder(spark)
    raw = fx.raw_of(spark, d, FATURAS)
    for factor in ("1", "0.1"):
        amount = (F.col("valor_fatura").cast("decimal(14,2)") * F.lit(factor).cast("decimal(2,1)")).cast("decimal(14,2)")
        fx.deliver(spark, raw.withColumn("valor_fatura", amount.cast("string")), new_folder(spark), source, FATURAS, fx.parts_of(spark, d, FATURAS))
        landing.land_files(spark, lake, FATURAS, source)
    return landing.scan_raw(spark, lake, FATURAS)


def landing_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Rows by subject from one folder that holds the files of both, told apart by their names."""
    lake, source = Lake(new_folder(spark)), new_folder(spark)
    for subject in monthly.SUBJECTS:
        fx.deliver(spark, fx.raw_of(spark, d, subject), new_folder(spark), source, subject, fx.parts_of(spark, d, subject))
    monthly.ingest(spark, lake, monthly.mixed_delivery(source))
    rows = [landing.scan_raw(spark, lake, s).agg(F.lit(s).alias("tb_name"), F.count(F.lit(1)).alias("qtd"), F.max("id_fatura").alias("ultima")) for s in monthly.SUBJECTS]
    return rows[0].unionByName(rows[1])


def landing_control(spark: SparkSession, d: str) -> DataFrame:
    """Rows by subject according to the control rows of the landed files."""
    lake = landed_lake(spark, d)
    files = [landing.landed_files(spark, lake, s) for s in monthly.SUBJECTS]
    return files[0].unionByName(files[1]).groupBy("tb_name").agg(F.sum("qtd_registros").alias("qtd_registros"))


def control_gate(spark: SparkSession, d: str) -> DataFrame:
    """Rows still waiting once the trusted run of the invoices has used its files."""
    lake = landed_lake(spark, d)
    landing.mark_processed(landing.require_pending(spark, lake, FATURAS), lake, FATURAS, DT_PROC)
    files = [landing.pending_files(spark, lake, s) for s in monthly.SUBJECTS]
    return files[0].unionByName(files[1]).groupBy("tb_name").agg(F.sum("qtd_registros").alias("qtd_registros"))


def monthly_run(spark: SparkSession, d: str) -> DataFrame:
    """Source files to stored book through every layer."""
    sources = {s: source_files(spark, d, s) for s in monthly.SUBJECTS}
    return monthly.run_month(spark, Lake(new_folder(spark)), sources, PERIOD, DT_PROC)


def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return book_of(book(spark, d), fx.CUSTOMER)


QUERIES: dict[str, Query] = {
    "csv_scan_faturas": csv_scan(FATURAS),
    "csv_scan_pagamentos": csv_scan(PAGAMENTOS),
    "csv_scan_reordered": csv_scan_reordered,
    "trusted_scan_faturas": trusted_scan(FATURAS),
    "trusted_scan_pagamentos": trusted_scan(PAGAMENTOS),
    "sink_trusted_faturas": trusted_sink(FATURAS, "vlr_fatura"),
    "sink_trusted_pagamentos": trusted_sink(PAGAMENTOS, "vlr_pagamento"),
    "sink_stage": stored_stage,
    "sink_book": stored_book,
    "stored_book_lookup": stored_lookup,
    "book_retry": book_retry,
    "book_replaced": book_replaced,
    "join_bucketed": join_bucketed,
    "repeated_bucketed": repeated_bucketed,
    "book_from_states": book_from_states,
    "book_corrected": book_corrected,
    "control_row": control_rows,
    "landing_ingest_faturas": landing_ingest(FATURAS),
    "landing_ingest_pagamentos": landing_ingest(PAGAMENTOS),
    "landing_redelivery": landing_redelivery,
    "landing_mixed": landing_mixed,
    "landing_control": landing_control,
    "control_gate": control_gate,
    "normalize_faturas": lambda spark, d: trusted.normalize_faturas(fx.raw_faturas(spark, d)),
    "normalize_pagamentos": lambda spark, d: trusted.normalize_pagamentos(fx.raw_pagamentos(spark, d)),
    "typed_faturas": lambda spark, d: trusted.trusted_faturas(fx.raw_faturas(spark, d), DT_PROC),
    "typed_pagamentos": lambda spark, d: trusted.trusted_pagamentos(fx.raw_pagamentos(spark, d), DT_PROC),
    "period_filter_faturas": faturas,
    "period_filter_pagamentos": pagamentos,
    "join_fatura_pagamento": joined,
    "ref_months": lambda spark, d: inspection.months_present(fx.faturas(spark, d)),
    "ref_bounds_faturas": lambda spark, d: inspection.bounds(faturas(spark, d), "ref"),
    "ref_bounds_pagamentos": lambda spark, d: inspection.bounds(pagamentos(spark, d), "ref"),
    "dup_check_faturas": lambda spark, d: inspection.key_counts(faturas(spark, d)),
    "dup_check_pagamentos": lambda spark, d: inspection.key_counts(pagamentos(spark, d)),
    "repeated_pagamentos": lambda spark, d: inspection.repeated_keys(pagamentos(spark, d)),
    "classify_pagamento": with_payment_class,
    "classify_valor": with_amount_class,
    "perc_pago": with_percent,
    "dias_atraso": with_days,
    "stage": stage_rows,
    "stage_bounds": lambda spark, d: inspection.bounds(stage_rows(spark, d), "dt_emissao"),
    "flags_janela": flagged,
    "book": book,
    "book_point_lookup": point_lookup,
    "sample_rows": lambda spark, d: inspection.sample_rows(fx.faturas(spark, d), SAMPLE, "id_fatura"),
    "monthly_run": monthly_run,
}


def portable_queries() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, d: portable(query(spark, d))

    return {name: wrap(query) for name, query in QUERIES.items()}
