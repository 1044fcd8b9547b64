"""Which runs of a stored table count.

A run's rows lie in folders of their own, by month, stamp and try. They count once the
run's record is written, which is the last thing a run does: a reader finds the runs as they were
before it or after it, never half a run and never a run beside the one it replaces. What
no longer counts is removed at the beginning of the next run, or by ``remove_hidden``.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition folder of a try.
TRY = "tentativa"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: One row a run: ``ordem`` counts a table's runs, ``substitui`` says that a run stands alone in the months it wrote,
#: ``baldes`` is the number of buckets it was written in, and ``fontes`` what each month was made from, for tables made from others.
RUN = T.StructType(
    [
        T.StructField("dt_proc", T.StringType()),
        T.StructField(TRY, T.StringType()),
        T.StructField("ordem", T.LongType()),
        T.StructField("substitui", T.BooleanType()),
        T.StructField("meses", T.ArrayType(T.StringType())),
        T.StructField("baldes", T.IntegerType()),
        T.StructField("fontes", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _records_folder(path: str) -> str:
    """Below the table, hidden from a read of the table."""
    return f"{path}/_execucoes"


def _path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, pattern: str) -> list[str]:
    location, files = _path(spark, pattern)
    return sorted(str(status.getPath().toString()) for status in files.globStatus(location) or [])


def _month_of(folder: str) -> str | None:
    """The month of a folder ref=.../dt_proc=.../tentativa=..."""
    value = unquote(folder.split("/")[-3].removeprefix("ref="))
    return None if value == _NULL_FOLDER else value


def records(spark: SparkSession, path: str) -> list[Row]:
    """The table's runs in order; their number does not depend on the data."""
    location, files = _path(spark, _records_folder(path))
    if not files.exists(location):
        return []
    rows = spark.read.schema(RUN).parquet(_records_folder(path)).collect()
    return sorted(rows, key=lambda r: (r["ordem"], r["dt_proc"] or ""))


def visible(found: list[Row]) -> dict[str, list[str | None]]:
    """The tries that count, each with its months that do.

    Of a stamp its last try counts. In a month that a run replaced, neither runs before it count nor earlier tries.
    """
    replaced: dict[str | None, int] = {}
    for run in found:
        for month in run["meses"] if run["substitui"] else ():
            replaced[month] = max(run["ordem"], replaced.get(month, -1))
    last = {run["dt_proc"]: run for run in found if run[TRY]}
    return {run[TRY]: [m for m in run["meses"] if run["ordem"] >= replaced.get(m, -1)] for run in last.values()}


def _in_months(months: list[str | None]) -> Column:
    named = F.col("ref").isin([m for m in months if m is not None])
    return named | F.col("ref").isNull() if None in months else named


def counting(spark: SparkSession, path: str) -> Column:
    """Rows of the runs that count now, as a condition on partition folders, so that no other folder is read.

    A plan built on it keeps seeing these runs, whatever is written meanwhile.
    """
    found = records(spark, path)
    written = {run[TRY]: len(run["meses"]) for run in found}
    shown = {attempt: months for attempt, months in visible(found).items() if months}
    whole = [attempt for attempt, months in shown.items() if len(months) == written[attempt]]
    condition = F.col(TRY).isin(whole)
    for attempt, months in shown.items():
        if attempt not in whole:
            condition = condition | ((F.col(TRY) == attempt) & _in_months(months))
    return condition


def versions(spark: SparkSession, path: str) -> dict[str | None, str]:
    """For each month the tries its rows come from: equal as long as the month's rows are."""
    tries: dict[str | None, list[str]] = {}
    for attempt, months in visible(records(spark, path)).items():
        for month in months:
            tries.setdefault(month, []).append(attempt)
    return {month: ",".join(sorted(mine)) for month, mine in tries.items()}


def next_order(spark: SparkSession, path: str) -> int:
    return max((run["ordem"] for run in records(spark, path)), default=-1) + 1


def _append(spark: SparkSession, path: str, run: dict[str, object]) -> None:
    """One file, written whole or not at all."""
    kinds = {f.name: f.dataType for f in RUN}
    months = F.array(*map(F.lit, run.pop("meses")))
    sources = [F.lit(x) for pair in (run.pop("fontes") or {}).items() for x in pair]
    row = {**{name: F.lit(value) for name, value in run.items()}, "meses": months, "fontes": F.create_map(*sources) if sources else F.lit(None)}
    one = spark.range(0, 1, 1, 1).select(*(row[name].cast(kind).alias(name) for name, kind in kinds.items()))
    one.write.mode("append").parquet(_records_folder(path))


def record(
    spark: SparkSession,
    path: str,
    dt_proc: str,
    attempt: str,
    replaces: bool,
    buckets: int | None = None,
    months: list[str] | None = None,
    sources: dict[str, str | None] | None = None,
) -> None:
    """Make a try count, for the months it wrote or for ``months``, of which some may have no rows."""
    if months is None:
        months = sorted((_month_of(f) for f in folders(spark, f"{path}/ref=*/dt_proc={dt_proc}/{TRY}={attempt}")), key=str)
    order = next_order(spark, path)
    _append(spark, path, {"dt_proc": dt_proc, TRY: attempt, "ordem": order, "substitui": replaces, "meses": months, "baldes": buckets, "fontes": sources})


def settle(spark: SparkSession, path: str, sources: dict[str, str]) -> None:
    """Say what months that stay as they are would now be made from."""
    order = next_order(spark, path)
    _append(spark, path, {"dt_proc": None, TRY: None, "ordem": order, "substitui": False, "meses": [], "baldes": None, "fontes": sources})


def sources(spark: SparkSession, path: str) -> dict[str, str]:
    """What each month was last said to be made from."""
    told: dict[str, str | None] = {}
    for run in records(spark, path):
        told.update(run["fontes"] or {})
    return {month: source for month, source in told.items() if source is not None}


def remove_hidden(spark: SparkSession, path: str, dt_proc: str | None = None) -> int:
    """Remove the folders that a recorded run has hidden, and what failed tries of ``dt_proc`` left; returns how many.

    A reader that began before the last run may still be at them: call it when none is.
    """
    found = records(spark, path)
    shown, recorded = visible(found), {run[TRY] for run in found}
    removed = 0
    for folder in folders(spark, f"{path}/ref=*/dt_proc=*/{TRY}=*"):
        attempt, stamp = folder.rpartition(f"{TRY}=")[2], unquote(folder.split("/")[-2].removeprefix("dt_proc="))
        failed = attempt not in recorded and stamp == dt_proc
        hidden = attempt in recorded and _month_of(folder) not in shown.get(attempt, ())
        if failed or hidden:
            location, files = _path(spark, folder)
            files.delete(location, True)
            removed += 1
    return removed
