"""The monthly runs: land files, build the trusted tables, build the book.

A gate opens a run only if a landed file is waiting for it. What a run used is
recorded once it has succeeded, and a run's rows are replaced when it is repeated under
the same stamp, so a run that failed at any step can be repeated with its stamp.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.period import Period, processing_stamp
from mensario.operators.book import build_features, tasks_for
from mensario.operators.inspection import bounds, columns_of, in_period, months_present, repeats, repeats_stored, sample_rows
from mensario.operators.joins import join_faturas_pagamentos, join_stored
from mensario.operators.stage import build_stage, with_window_flags
from mensario.operators.trusted import TO_TRUSTED
from mensario.sources import runs
from mensario.sources.bucketed import buckets_of, hot_column, scan_trusted_bucketed, write_trusted_bucketed
from mensario.sources.control import control_row, write_control
from mensario.sources.files import Delivery
from mensario.sources.lake import Lake, trusted_name
from mensario.sources.tables import (
    APPEND,
    REPLACE_MONTHS,
    balance_by,
    scan_book,
    scan_stage,
    scan_trusted,
    write_book,
    write_stage,
    write_trusted,
)
from mensario.streaming.landing import (
    finished,
    land_files,
    mark_processed,
    pending_batches,
    require_pending,
    scan_raw,
    waiting_files,
)

SUBJECTS = (fv.SUBJECT_FATURAS, fv.SUBJECT_PAGAMENTOS)
BOOK_CONSUMER = "book_fatura"
#: Rows of a sample for the eye.
SAMPLE = 5


@dataclass(frozen=True)
class TrustedRun:
    subject: str
    dt_proc: str
    rows: int


Sources = dict[str, str | Delivery]


def mixed_delivery(folder: str) -> Sources:
    """A folder with the files of both subjects, told apart by names that begin with the subject."""
    return {subject: Delivery(folder, f"{subject}*") for subject in SUBJECTS}


def ingest(spark: SparkSession, lake: Lake, sources: Sources) -> None:
    """Land both subjects; ``sources`` gives the folder of each, or the folder and a pattern for the names."""
    for subject in SUBJECTS:
        land_files(spark, lake, subject, sources[subject])


def process(
    spark: SparkSession,
    lake: Lake,
    subject: str,
    dt_proc: str | None = None,
    mode: str = APPEND,
    only_pending: bool = False,
    gate: bool = True,
    buckets: int | None = None,
) -> TrustedRun:
    """Raw to trusted for one subject, with its control row; in ``buckets`` if given, see ``bucketed``.

    By default all raw files are read and appended, so a month that an earlier run wrote is
    there twice afterwards; what an earlier try under the same ``dt_proc`` wrote is replaced. ``only_pending`` reads the batches not used before;
    ``replace_months`` swaps whole months and needs all raw files. Without ``gate`` a
    run over all files starts even if none is waiting.
    """
    if only_pending and mode == REPLACE_MONTHS:
        raise ValueError("replacing whole months needs all raw files, not only the pending ones")
    dt_proc = dt_proc or processing_stamp()
    open_gate = require_pending if gate or only_pending else waiting_files
    pending = open_gate(spark, lake, subject)

    lotes = pending_batches(pending) if only_pending else None
    rows = TO_TRUSTED[subject](scan_raw(spark, lake, subject, lotes), dt_proc)
    if buckets:
        count = write_trusted_bucketed(rows, subject, lake.trusted(subject), dt_proc, buckets, mode)
    else:
        count = write_trusted(balance_by(rows, "ref"), lake.trusted(subject), dt_proc, mode)

    control = control_row(spark, trusted_name(subject), dt_proc, count)
    write_control(control, lake.trusted_control(subject, dt_proc))
    mark_processed(pending, lake, subject, dt_proc)
    return TrustedRun(subject, dt_proc, count)


def _joined(spark: SparkSession, lake: Lake, period: Period) -> DataFrame:
    """The period's invoices with their payments, without a shuffle if both tables have the same buckets."""
    paths = [lake.trusted(subject) for subject in SUBJECTS]
    buckets = {buckets_of(spark, path) for path in paths}
    if len(buckets) > 1 or None in buckets:
        faturas, pagamentos = (in_period(scan_trusted(spark, s, p), period) for s, p in zip(SUBJECTS, paths))
        return join_faturas_pagamentos(faturas, pagamentos)
    faturas, pagamentos = (in_period(scan_trusted_bucketed(spark, s, p), period) for s, p in zip(SUBJECTS, paths))
    return join_stored(faturas, pagamentos, hot_column(spark, *paths))


def _repeats(spark: SparkSession, lake: Lake, subject: str, period: Period) -> DataFrame:
    path = lake.trusted(subject)
    if buckets_of(spark, path) is None:
        return repeats(in_period(scan_trusted(spark, subject, path), period))
    return repeats_stored(in_period(scan_trusted_bucketed(spark, subject, path), period), hot_column(spark, path))


def book_checks(spark: SparkSession, lake: Lake, period: Period) -> dict[str, DataFrame]:
    """What to look at before a book: per subject its columns, a few rows, months present and covered, repeated
    keys; and the date bounds of the stage, where there is one.

    Payments are checked on the same keys as invoices, so part-payments are listed as well.
    """
    checks = {}
    for subject in SUBJECTS:
        table = scan_trusted(spark, subject, lake.trusted(subject))
        rows = in_period(table, period)
        checks[f"{subject}: columns"] = spark.createDataFrame(columns_of(table), "coluna string, tipo string")
        checks[f"{subject}: a few rows"] = sample_rows(table, SAMPLE)
        checks[f"{subject}: months present"] = months_present(table)
        checks[f"{subject}: months in the period"] = bounds(rows, "ref")
        checks[f"{subject}: keys that occur more than once"] = _repeats(spark, lake, subject, period)
    stage = scan_stage(spark, lake.stage, missing_ok=True).where(F.col("ref") == period.ref)
    checks["stage: dates of issue"] = bounds(stage, "dt_emissao")
    return checks


def remove_hidden_runs(spark: SparkSession, lake: Lake) -> int:
    """Remove the files of runs that others have replaced; returns how many folders. Call it when nobody reads them."""
    tables = [lake.trusted(subject) for subject in SUBJECTS] + [lake.stage, lake.book]
    return sum(runs.remove_hidden(spark, path) for path in tables)


def build_book(
    spark: SparkSession,
    lake: Lake,
    period: Period,
    dt_proc: str | None = None,
    mode: str = APPEND,
    gate: bool = True,
) -> DataFrame:
    """Trusted to stage to book; returns the stored book of this run.

    The book is built from the stage just written, so the join runs once. A try that failed
    left nothing that counts: stage and book rows of the same ``ref`` and ``dt_proc`` are replaced. ``replace_months``
    leaves this run alone for its ``ref``, in stage and book. Without
    ``gate`` it is built even if no file is waiting, such as for an earlier month.
    """
    dt_proc = dt_proc or processing_stamp()
    open_gate = require_pending if gate else waiting_files
    waiting = [open_gate(spark, lake, subject, BOOK_CONSUMER) for subject in SUBJECTS]

    rows = write_stage(build_stage(_joined(spark, lake, period), period, dt_proc), lake.stage, dt_proc, mode, ref=period.ref)

    this_run = (F.col("ref") == period.ref) & (F.col("dt_proc") == dt_proc)
    stage = with_window_flags(scan_stage(spark, lake.stage).where(this_run), period)
    write_book(build_features(stage, tasks=tasks_for(spark, rows)), lake.book, dt_proc, mode, ref=period.ref)

    # in one write: both subjects or none
    mark_processed(waiting[0].unionByName(waiting[1]), lake, BOOK_CONSUMER, dt_proc)
    return scan_book(spark, lake.book).where(this_run)


def run_month(
    spark: SparkSession,
    lake: Lake,
    sources: Sources,
    period: Period,
    dt_proc: str | None = None,
    mode: str = APPEND,
    only_pending: bool = False,
    gate: bool = True,
    buckets: int | None = None,
    build: Callable[..., DataFrame] = build_book,
) -> DataFrame:
    """Everything in order: land, both trusted tables, the book, by way of a stage or by ``incremental.build_book``.

    A step this ``dt_proc`` has finished already is skipped, so a run that failed is repeated with its stamp and
    goes on where it stopped. Without ``gate`` it runs even if no file is waiting.
    """
    dt_proc = dt_proc or processing_stamp()
    ingest(spark, lake, sources)
    for subject in SUBJECTS:
        if not finished(spark, lake, subject, dt_proc):
            process(spark, lake, subject, dt_proc, mode, only_pending, gate, buckets)
    if finished(spark, lake, BOOK_CONSUMER, dt_proc):
        return scan_book(spark, lake.book).where((F.col("ref") == period.ref) & (F.col("dt_proc") == dt_proc))
    return build(spark, lake, period, dt_proc, mode, gate)
