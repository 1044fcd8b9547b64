"""Vector compression to integer codes, nearest entries found with fixed pivots.

A vector's components become integers and are cut into equal parts, each with a codebook
of its own position. The squared distances of every part to a few pivots are computed once
and written with the parts. In each round the entries' distances to the same pivots give,
by the triangle inequality, a lower bound for each part and entry: the entry of the least
bound is compared exactly first, and of the others only those whose bound does not
exceed what that gave. Sums per entry are formed in the tasks; a codebook is all that
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Fixed pivots of each part position.
PIVOTS = 6
#: Integer components beyond it would leave no room for squared distances in a long; such a component counts as not finite.
LARGEST = 1 << 26
#: Rows of a batch compared at once.
BLOCK = 2048
#: Labels with more than this share of the rows are few, so their sums are broadcast; the others' rows are shuffled.
HOT_SHARE = 1 / 1000


@dataclass
class Codebooks:
    """``entries``: position x entry x component, integers. ``pivots``: position x pivot x component."""

    entries: np.ndarray
    pivots: np.ndarray

    def text(self) -> str:
        """All components in the order of position, entry, component, joined by commas."""
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def _whole(vector: Column) -> Column:
    """The components as integers, NULL if the vector cannot be kept."""
    # NaN and infinities fail the comparison, or are beyond it
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) <= LARGEST, F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.when(fits, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).try_cast("int")))


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of ``points``, each as far from those before it as any; fewer if there are fewer."""
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``a`` to every row of ``b``, integers."""
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def nearest(part: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each row of ``part`` the nearest entry (the lower index among equals), its squared distance, and how many
    distances were computed. ``to_pivots`` holds the roots of the squared distances of the rows to ``pivots``."""
    entry_pivots = np.sqrt(squared(entries, pivots).astype(np.float64))
    bound = np.abs(to_pivots[:, :1] - entry_pivots[None, :, 0])
    for k in range(1, entry_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, k : k + 1] - entry_pivots[None, :, k]), out=bound)
    rows = np.arange(len(part))
    guess = bound.argmin(axis=1)
    first = ((part - entries[guess]) ** 2).sum(axis=1)
    # the bound is a difference of rounded roots: give it more than their rounding before it may rule an entry out
    limit = np.sqrt(first.astype(np.float64)) * (1 + 1e-9) + 1e-3 + to_pivots.max(axis=1, initial=0) * 1e-9
    left = bound <= limit[:, None]
    left[rows, guess] = False
    row, entry = np.nonzero(left)
    exact = ((part[row] - entries[entry]) ** 2).sum(axis=1)
    # the least (distance, entry) of each row
    row, entry, exact = np.r_[rows, row], np.r_[guess, entry], np.r_[first, exact]
    order = np.lexsort((entry, exact, row))
    chosen = order[np.searchsorted(row[order], rows)]
    return entry[chosen], exact[chosen], len(row)


def _blocks(batch: pa.RecordBatch, width: int, n_pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices with their parts (row x position x component) and the roots of their pivot distances."""
    for start in range(0, batch.num_rows, BLOCK):
        part = batch.slice(start, BLOCK)
        n = part.num_rows
        whole = np.asarray(part.column("whole").flatten()).astype(np.int64).reshape(n, PARTS, width)
        far = np.sqrt(np.asarray(part.column("far").flatten()).astype(np.float64)).reshape(n, PARTS, n_pivots)
        yield part, whole, far


def _measured(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``kept`` with ``far``: the squared distances of each part to its position's pivots."""
    names = kept.columns
    width = pivots.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            whole = np.asarray(batch.column("whole").flatten()).astype(np.int64).reshape(n, PARTS, width)
            far = np.stack([squared(whole[:, p], pivots[p]) for p in range(PARTS)], axis=1).reshape(-1)
            offsets = np.arange(n + 1) * (PARTS * pivots.shape[1])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(far, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*names, "far"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, far array<long>")


def _sums(measured: DataFrame, books: Codebooks) -> DataFrame:
    """(position, entry, n, sums) of the parts assigned to each entry; a task gives one row for an entry it met."""
    entries, pivots = books.entries, books.pivots
    width = entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(entries.shape[:2], np.int64)
        total = np.zeros(entries.shape, np.int64)
        for batch in batches:
            for _, whole, far in _blocks(batch, width, pivots.shape[1]):
                for p in range(PARTS):
                    code, _, _ = nearest(whole[:, p], far[:, p], entries[p], pivots[p])
                    order = np.argsort(code, kind="stable")
                    seen, first, counts = np.unique(code[order], return_index=True, return_counts=True)
                    n[p, seen] += counts
                    total[p, seen] += np.add.reduceat(whole[order, p], first, axis=0)
        position, entry = np.nonzero(n)
        flat = total[position, entry]
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * width, pa.int32()), pa.array(flat.reshape(-1), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(position, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[position, entry]), sums], names=["position", "entry", "n", "sums"])

    return measured.select("whole", "far").mapInArrow(run, "position int, entry int, n long, sums array<long>")


def _moved(measured: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the mean of its parts, rounded down; entries without parts stay."""
    partial = _sums(measured, books)
    width = books.entries.shape[2]
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    rows = partial.groupBy("position", "entry").agg(F.sum("n").alias("n"), *each).collect()  # at most PARTS x ENTRIES
    entries = books.entries.copy()
    for row in rows:
        entries[row["position"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return Codebooks(entries, books.pivots)


def _coded(measured: DataFrame, books: Codebooks) -> DataFrame:
    entries, pivots = books.entries, books.pivots
    kinds = {f.name: f.dataType.simpleString() for f in measured.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, whole, far in _blocks(batch, entries.shape[2], pivots.shape[1]):
                codes = np.zeros((len(whole), PARTS), np.uint8)
                error = np.zeros(len(whole), np.int64)
                for p in range(PARTS):
                    code, exact, _ = nearest(whole[:, p], far[:, p], entries[p], pivots[p])
                    codes[:, p] = code
                    error += exact
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], names=["vec_id", "label", "code", "error"]
                )

    return measured.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """The error of all rows of a label beside each of its rows, NULL being a label like any other."""
    sums = cut(coded.groupBy("label").agg(F.count("*").alias("_n"), F.sum("error").alias("label_error")))
    rows = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = sums.where(F.col("_n") > rows * HOT_SHARE)  # fewer than 1 / HOT_SHARE labels
    marked = F.broadcast(hot.select(F.col("label").alias("_label"), "label_error"))
    with_hot = coded.join(marked, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    cold = sums.where(F.col("_n") <= rows * HOT_SHARE).select(F.col("label").alias("_label"), F.col("label_error").alias("_cold"))
    settled = with_hot.where("label_error is not null")
    rest = with_hot.where("label_error is null").drop("label_error").join(cold, F.col("label").eqNullSafe(F.col("_label")))
    return settled.unionByName(rest.withColumnRenamed("_cold", "label_error").drop("_label"))


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks) of every row of ``vectors`` (vec_id, embedding, label) kept.

    Rows whose vector is NULL or holds a NULL, a non-finite component or one beyond ``LARGEST`` / ``SCALE`` are
    dropped, and so are rows whose vector is not as long as that of the least vec_id kept; that length must be a multiple of
    16, or ValueError is raised. A codebook begins with the vectors of the least vec_ids, NULL ids last, rows of one id in the
    order of their vectors; with fewer than 64 rows it has as many entries. ``code`` holds a byte a part, ``codebooks`` all
    final entries as text. Repeated rows stay, no rows give no rows, and other columns are not looked at.
    """
    kept = vectors.select("vec_id", _whole(F.col("embedding")).alias("whole"), "label").where("whole is not null")
    begin = kept.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(1).collect()
    kind = {f.name: f.dataType.simpleString() for f in kept.schema}
    if not begin:
        empty = f"vec_id {kind['vec_id']}, label {kind['label']}, code binary, error long, label_error long, codebooks string"
        return kept.sparkSession.createDataFrame([], empty)
    size = len(begin[0]["whole"])
    if size % PARTS:
        raise ValueError(f"vectors of {size} components cannot be cut into {PARTS} equal parts")
    kept = kept.where(F.size("whole") == size)
    least = kept.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(ENTRIES).collect()
    start = np.array([r["whole"] for r in least], np.int64).reshape(len(least), PARTS, size // PARTS).transpose(1, 0, 2).copy()
    books = Codebooks(start, np.stack([_spread(p, PIVOTS) for p in start]))
    measured = cut(_measured(kept, books.pivots))
    for _ in range(ROUNDS):
        books = _moved(measured, books)
    coded = cut(_coded(measured, books))
    return _with_label_error(coded).withColumn("codebooks", F.lit(books.text()))
