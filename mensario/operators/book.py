"""The book: one row per customer, one column per feature of the grid.

Written directly, the grid is several hundred conditional aggregates. Each of them
would touch every row, and each partial group would shuffle several hundred
buffers. Here the work is done in three narrow steps instead:

1. rows with the same customer, classes and windows collapse to one small state
   (sum, count, min, max per value). This combines before the shuffle, so a
   customer with most of the rows leaves each task as a few dozen of them;
2. after the one further shuffle, by customer, every state is added to the cells
   (class x window) it belongs to, and each cell's features are finished once;
3. a customer's cells, at most one per label and window, become a map, from which
   the wide row is a plain projection.

Steps 2 and 3 share the partitioning by customer.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario.operators.features import AVG, BOOK_GRID, MAX, MIN, SUM, FeatureGrid

KEYS = ("id_cliente", "ref", "dt_proc")

#: Stage rows or states whose customers a task merges and spreads. Adaptive execution sizes tasks by shuffled bytes, of which
#: one becomes about 50 of cells and wide rows.
TASK_ROWS = 250_000

# Partial states each aggregate is made from.
_STATES_OF = {SUM: ("sum",), AVG: ("sum", "count"), MIN: ("min",), MAX: ("max",)}
_COLLECT = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks to build a book of so many stage rows or states in; None, as adaptive execution sees fit, if they are few."""
    return max(ceil(rows / TASK_ROWS), spark.sparkContext.defaultParallelism) if rows > TASK_ROWS else None


def _states(grid: FeatureGrid) -> list[tuple[str, str]]:
    return [
        (value, state)
        for value, aggs in grid.values
        for state in dict.fromkeys(s for a in aggs for s in _STATES_OF[a])
    ]


def _label_code(grid: FeatureGrid, column: str) -> Column:
    """Position of the row's label in the grid, NULL if the grid does not list it."""
    branches = " ".join(
        f"when '{label}' then {i}" for i, (col, label) in enumerate(grid.labels) if col == column
    )
    return F.expr(f"case {column} {branches} end")


def _window_mask(grid: FeatureGrid) -> Column:
    """One bit per window the row lies in; the window of all rows is always set."""
    bits = (
        str(1 << i) if flag is None else f"if({flag} = 1, {1 << i}, 0)"
        for i, flag in enumerate(grid.flags)
    )
    return F.expr(" | ".join(bits))


def combine_rows(flagged: DataFrame, grid: FeatureGrid = BOOK_GRID) -> DataFrame:
    """Step 1: one state row per customer, class combination and window combination."""
    codes = {f"code_{c}": _label_code(grid, c) for c in grid.label_columns}
    return (
        flagged.withColumns({**codes, "mask": _window_mask(grid)})
        .groupBy(*KEYS, *codes, "mask")
        .agg(*[_COLLECT[state](value).alias(f"{state}_{value}") for value, state in _states(grid)])
    )


def combine_states(flagged: DataFrame, grid: FeatureGrid = BOOK_GRID) -> DataFrame:
    """The rows ``combine_rows`` gives, from states of several rows each: its columns of states, labels and window flags."""
    codes = {f"code_{c}": _label_code(grid, c) for c in grid.label_columns}
    return (
        flagged.withColumns({**codes, "mask": _window_mask(grid)})
        .groupBy(*KEYS, *codes, "mask")
        .agg(*[_MERGE[state](f"{state}_{value}").alias(f"{state}_{value}") for value, state in _states(grid)])
    )


def _average(value: str, dtype: T.DataType) -> Column:
    """Average from its sum and count, in the type and rounding ``avg`` gives for ``dtype``."""
    total, n = F.col(f"sum_{value}"), F.col(f"count_{value}")
    if not isinstance(dtype, T.DecimalType):
        return F.try_divide(total.cast("double"), n.cast("double"))
    n = n.cast(T.DecimalType(20, 0))
    # Fewer integer digits in the sum leave more fraction digits in the quotient, so that
    # rounding it to the result type rounds once; the wide sum is for totals that do not fit.
    short = total.try_cast(T.DecimalType(20 + dtype.scale, dtype.scale))
    quotient = F.coalesce(F.try_divide(short, n), F.try_divide(total, n))
    result = T.DecimalType(min(dtype.precision + 4, 38), min(dtype.scale + 4, 38))
    return quotient.cast(result)


def _finish(value: str, agg: str, dtype: T.DataType) -> Column:
    if agg == AVG:
        return _average(value, dtype)
    col = F.col(f"{agg}_{value}")
    if agg == SUM and isinstance(dtype, T.DecimalType):
        return col.cast(T.DecimalType(min(dtype.precision + 10, 38), dtype.scale))
    return col


def merge_cells(states: DataFrame, types: dict[str, T.DataType], grid: FeatureGrid = BOOK_GRID, tasks: int | None = None) -> DataFrame:
    """Step 2: the finished features of every cell a customer has rows in.

    A row whose labels are all unknown to the grid keeps its customer through a NULL cell.
    No customer brings more rows than there are class and window combinations, so the
    partitions are even, and adaptive execution sizes them unless ``tasks`` are given.
    """
    columns = [f"{state}_{value}" for value, state in _states(grid)]
    labels = F.array(*[f"code_{c}" for c in grid.label_columns])
    windows = F.expr(f"array({', '.join(map(str, range(len(grid.windows))))})")
    merged = (
        (states.repartition(tasks, "id_cliente") if tasks else states.repartition("id_cliente"))
        .select(*KEYS, "mask", F.explode(labels).alias("label"), *columns)
        .select(*KEYS, "mask", "label", F.explode(windows).alias("window"), *columns)
        .where("mask & shiftleft(1, window) != 0")
        .groupBy(*KEYS, F.expr(f"label * {len(grid.windows)} + window").alias("cell"))
        .agg(*[_MERGE[state](f"{state}_{value}").alias(f"{state}_{value}") for value, state in _states(grid)])
    )
    return merged.select(
        *KEYS,
        "cell",
        *[
            _finish(value, agg, types[value]).alias(f"{value}_{agg}")
            for value, aggs in grid.values
            for agg in aggs
        ],
    )


def spread_cells(cells: DataFrame, grid: FeatureGrid = BOOK_GRID) -> DataFrame:
    """Step 3: one wide row per customer. A customer has at most one cell per label and window."""
    entry = F.when(
        F.col("cell").isNotNull(),
        F.struct(
            "cell",
            F.struct(*[f"{value}_{agg}" for value, aggs in grid.values for agg in aggs]),
        ),
    )
    by_customer = cells.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
    return by_customer.selectExpr(
        *KEYS, *[f"cells[{f.cell}].{f.value}_{f.agg} as {f.name}" for f in grid.features()]
    )


def build_features(flagged: DataFrame, grid: FeatureGrid = BOOK_GRID, tasks: int | None = None) -> DataFrame:
    """Stage rows with window flags to the book; ``tasks`` as from ``tasks_for``."""
    types = {value: flagged.schema[value].dataType for value, _ in grid.values}
    return spread_cells(merge_cells(combine_rows(flagged, grid), types, grid, tasks), grid)


def features_of_states(flagged: DataFrame, types: dict[str, T.DataType], grid: FeatureGrid = BOOK_GRID, tasks: int | None = None) -> DataFrame:
    """As ``build_features``, from states instead of rows; ``types`` are those of the values."""
    return spread_cells(merge_cells(combine_states(flagged, grid), types, grid, tasks), grid)


def book_of(book: DataFrame, id_cliente: int) -> DataFrame:
    """One customer's row; on a stored book the condition reaches the Parquet scan."""
    return book.where(F.col("id_cliente") == id_cliente)
