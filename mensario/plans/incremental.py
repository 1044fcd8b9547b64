"""The book from stored monthly states: a month's states are made once, and again only after a correction.

Each month of issue remembers the runs its invoices and the payments of each month came from. A month whose
invoices have other runs now is made anew; so is one that payments of a changed month touch, now or as
they were. The others stay, however many months the book covers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.period import Period, processing_stamp
from mensario.operators.book import tasks_for
from mensario.operators.joins import KEYS
from mensario.operators.states import book_of_states, build_states, states_of
from mensario.plans.monthly import BOOK_CONSUMER, SUBJECTS
from mensario.schemas import STATE
from mensario.sources import runs
from mensario.sources.lake import Lake
from mensario.sources.tables import APPEND, balance_by, scan_book, scan_runs, scan_trusted, write_book, write_states
from mensario.streaming.landing import mark_processed, require_pending, waiting_files


def _payments_known(source: str | None) -> dict[str, str]:
    return json.loads(source)["pagamentos"] if source else {}


def stale_months(spark: SparkSession, lake: Lake, period: Period) -> tuple[list[str], dict[str, str]]:
    """The period's months whose states have to be made, and for all its months what they are then made from."""
    paths = [lake.trusted(subject) for subject in SUBJECTS]
    invoices, payments = (runs.versions(spark, path) for path in paths)
    covered = period.months_covered
    paid = {q: payments[q] for q in covered if q in payments}
    want = {m: json.dumps({"faturas": invoices[m], "pagamentos": paid}, sort_keys=True) for m in covered if m in invoices}
    have = runs.sources(spark, lake.states)
    stale, unsure = set(), {}
    for month, source in want.items():
        known = have.get(month)
        if known is None or json.loads(known)["faturas"] != invoices[month]:
            stale.add(month)
        else:
            before = _payments_known(known)
            unsure[month] = {q for q in covered if paid.get(q) != before.get(q)}
    unsure = {m: qs for m, qs in unsure.items() if qs}
    if unsure:
        changed = sorted(set().union(*unsure.values()))
        touched = _touched(spark, lake, sorted(unsure), changed)
        stale |= {m for m, qs in unsure.items() if touched.get(m, set()) & qs}
    # months that were made from earlier runs and have none now: their states must not count
    gone = {m for m in covered if m in have and m not in want}
    return sorted(stale | gone), want


def _touched(spark: SparkSession, lake: Lake, months: list[str], changed: list[str]) -> dict[str, set[str]]:
    """For months of issue the ``changed`` months of payment with payments to their invoices, by the tables or by the states.

    Only the keys of the changed payments and of the months' invoices are joined.
    """
    faturas, pagamentos = (scan_trusted(spark, s, lake.trusted(s)) for s in SUBJECTS)
    paid = pagamentos.where(F.col("ref").isin(changed)).select(*KEYS, F.col("ref").alias("ref_pagto")).distinct()
    now = faturas.where(F.col("ref").isin(months)).select(*KEYS, "ref").join(paid, list(KEYS)).select("ref", "ref_pagto")
    before = scan_runs(spark, STATE, lake.states).where(F.col("ref").isin(months) & F.col("ref_pagto").isin(changed))
    found: dict[str, set[str]] = {}
    for row in now.unionByName(before.select("ref", "ref_pagto")).distinct().collect():  # pairs of months
        found.setdefault(row["ref"], set()).add(row["ref_pagto"])
    return found


def refresh_states(spark: SparkSession, lake: Lake, period: Period, dt_proc: str) -> list[str]:
    """Make the states the period lacks; returns their months. A failed try is replaced by the next one under its stamp."""
    stale, want = stale_months(spark, lake, period)
    if stale:
        faturas = scan_trusted(spark, fv.SUBJECT_FATURAS, lake.trusted(fv.SUBJECT_FATURAS)).where(F.col("ref").isin(stale))
        pagamentos = scan_trusted(spark, fv.SUBJECT_PAGAMENTOS, lake.trusted(fv.SUBJECT_PAGAMENTOS)).where(period.covers("ref"))
        # a stamp of its own: of one stamp only the last try counts, and a book may be made of several
        stamp = f"{dt_proc}_{runs.next_order(spark, lake.states)}"
        rows = balance_by(build_states(faturas, pagamentos, stamp), "ref")
        write_states(rows, lake.states, stamp, stale, {m: want.get(m) for m in stale})
    known = runs.sources(spark, lake.states)
    settled = {m: source for m, source in want.items() if known.get(m) != source}
    if settled:
        runs.settle(spark, lake.states, settled)
    return stale


def build_book(
    spark: SparkSession, lake: Lake, period: Period, dt_proc: str | None = None, mode: str = APPEND, gate: bool = True
) -> DataFrame:
    """As ``monthly.build_book``, from states: no stage is written. Returns the stored book of this run."""
    dt_proc = dt_proc or processing_stamp()
    open_gate = require_pending if gate else waiting_files
    waiting = [open_gate(spark, lake, subject, BOOK_CONSUMER) for subject in SUBJECTS]
    refresh_states(spark, lake, period, dt_proc)
    states = scan_runs(spark, STATE, lake.states)
    tasks = tasks_for(spark, states_of(states, period).count())
    write_book(book_of_states(states, period, dt_proc, tasks), lake.book, dt_proc, mode, ref=period.ref)
    mark_processed(waiting[0].unionByName(waiting[1]), lake, BOOK_CONSUMER, dt_proc)
    return scan_book(spark, lake.book).where((F.col("ref") == period.ref) & (F.col("dt_proc") == dt_proc))
