"""Near-duplicate documents by SimHash, found with a generalised pigeonhole index.

Fingerprints of 64 bits link at ``TAU`` or fewer differing bits. The bits are put into
``m`` parts so that correlated bits share a part. Part i gets a threshold T_i of its own
(-1: not probed) with sum(T_i) = TAU - m + 1; then every linked pair agrees within T_i
in some part i. Dynamic programming gives the thresholds of least expected candidates,
from counts over all distinct fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut
from mensario.llm.components import components

BITS, TAU, SEED, WORDS = 64, 2, 42, 3
#: Buckets with more fingerprints are split by the bits outside their key.
BUCKET = 1024
#: A probe or an index row costs about as much as so many comparisons.
ROW_COST = 20.0


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the 3-word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole, n = b" ".join(words), max(1, len(words) - WORDS + 1)
    ends = [x - 1 for x in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(x + 1 for x in ends)]
    digest, last = xxhash.xxh64_intdigest, min(WORDS, len(words)) - 1
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 65536):
        hashes = np.array([digest(whole[s:e], SEED) for s, e in zip(starts[i : min(n, i + 65536)], ends[i + last :])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``; a NULL text counts as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fp long")


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: for each pair of bits how many fingerprints have both set; last, the number of fingerprints."""
    both, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).astype("<i8")
        for i in range(0, len(values), 65536):
            part = np.unpackbits(values[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += part.T @ part
            n += len(part)
    if n:
        yield pa.RecordBatch.from_pydict({"both": pa.array([[*both.ravel().tolist(), float(n)]])})


def _correlated_parts(corr: np.ndarray, m: int) -> list[list[int]]:
    """Bits in ``m`` parts of nearly equal width; each part grows by the bit most correlated with it."""
    free, parts = set(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        pool = sorted(free)
        part = [pool[int(np.argmax(corr[np.ix_(pool, pool)].sum(axis=1)))]]
        while len(part) < width:
            pool = sorted(free.difference(part))
            part.append(pool[int(np.argmax(corr[np.ix_(pool, part)].sum(axis=1)))])
        free.difference_update(part)
        parts.append(sorted(part))
    return parts


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum ``total`` and least sum of costs[i][t_i + 1], by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, extra in enumerate(options, start=-1):
                new = (cost + extra, [*chosen, t])
                if used + t not in step or new < step[used + t]:
                    step[used + t] = new
        best = step
    return best[total]


def _value(bits: list[int], column: str = "fp") -> F.Column:
    """The fingerprint with all other bits cleared: equal values mean equal parts."""
    mask = sum(1 << b for b in bits)
    return F.col(column).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _signed(bit: int) -> int:
    return (1 << bit) - (1 << 64) if bit == 63 else 1 << bit


def plan_parts(distinct: DataFrame, options: tuple[int, ...] = (2, 3, 4, 5)) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part to probe, from statistics over all distinct fingerprints."""
    tasks = distinct.select("fp").mapInArrow(_bit_counts, "both array<double>")
    sums = tasks.select(F.posexplode("both")).groupBy("pos").agg(F.sum("col").alias("x")).collect()
    both = np.zeros(BITS * BITS + 1)
    both[[r["pos"] for r in sums]] = [r["x"] for r in sums]
    n = both[-1] or 1.0
    both = both[:-1].reshape(BITS, BITS) / n
    one = np.diag(both)
    spread = np.sqrt(np.maximum(np.outer(one * (1 - one), one * (1 - one)), 1e-12))
    corr = np.abs(both - np.outer(one, one)) / spread
    np.fill_diagonal(corr, 0)
    agree = one**2 + (1 - one) ** 2
    layouts = {m: _correlated_parts(corr, m) for m in options}
    keys = [(m, i) for m in options for i in range(m)]
    values = F.array(*(F.struct(F.lit(k).alias("k"), _value(layouts[m][i]).alias("v")) for k, (m, i) in enumerate(keys)))
    pairs = {
        r["k"]: float(r["c"])
        for r in distinct.select(F.explode(values).alias("x")).groupBy("x.k", "x.v").count().groupBy("k").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("c")).collect()
    }
    best = None
    for m in options:
        costs = []
        for i, bits in enumerate(layouts[m]):
            exact = pairs.get(keys.index((m, i)), 0.0)
            # pairs that differ in exactly one bit of the part, were its bits independent given the others
            one_off = exact * sum((1 - agree[b]) / max(agree[b], 0.5) for b in bits)
            costs.append([0.0, exact + ROW_COST * n, exact + one_off + ROW_COST * n * (2 + len(bits))])
        cost, chosen = allocate(costs, TAU - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(bits, t) for bits, t in zip(layouts[m], chosen) if t >= 0])
    return best[1]


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, v). Per bucket: a forest over the fingerprints that link.

    Each fingerprint is compared until it joins a tree, so a bucket of b rows gives less
    than b links, and no link between trees is lost. A bucket is held whole: it has
    ``BUCKET`` rows at most.
    """
    kept: list[np.ndarray] = []

    def forest(fps: np.ndarray, reps: np.ndarray) -> Iterator[tuple[int, int]]:
        left = np.arange(1, len(fps))
        front = [0]
        while len(left) or front:
            if not front:
                front, left = [int(left[0])], left[1:]
            i = front.pop()
            near = np.bitwise_count((fps[left] ^ fps[i]).view(np.uint64)) <= TAU
            for j in left[near]:
                yield int(reps[i]), int(reps[j])
            front.extend(left[near].tolist())
            left = left[~near]

    def links(rows: np.ndarray) -> pa.RecordBatch:
        part, v, fp, rep = rows
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (v[1:] != v[:-1])) + 1
        bounds = np.r_[0, cuts, len(v)]
        sizes = np.diff(bounds)
        found: list[tuple[int, int]] = []
        two = bounds[:-1][sizes == 2]
        near = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= TAU]
        a, b = rep[near].tolist(), rep[near + 1].tolist()
        for start, size in zip(bounds[:-1][sizes > 2], sizes[sizes > 2]):
            found.extend(forest(fp[start : start + size], rep[start : start + size]))
        a.extend(x for x, _ in found)
        b.extend(y for _, y in found)
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
        if kept:
            rows = np.concatenate([*kept, rows], axis=1)
        part, v = rows[0], rows[1]
        last = np.flatnonzero((part != part[-1]) | (v != v[-1]))
        start = int(last[-1]) + 1 if len(last) else 0
        if start:
            yield links(rows[:, :start])
        kept = [rows[:, start:]]
    if kept:
        yield links(kept[0])


def _signatures(bits: list[int], t: int) -> list[tuple[F.Column, set[int]]]:
    """The keys of a part, and the bits each fixes. Two values one bit apart are equal once that bit is cleared."""
    base = _value(bits)
    if t == 0:
        return [(base, set(bits))]
    return [(base.bitwiseAND(F.lit(~_signed(b))), set(bits)) for b in bits]


def near_pairs(distinct: DataFrame) -> DataFrame:
    """(a, b): links between the documents that stand for fingerprints within TAU bits of one another.

    ``distinct`` has one row (fp, rep) per fingerprint. What comes out has the same
    components as the full set of links. A bucket over ``BUCKET`` rows is split: its rows
    agree on the key's bits, so on one of three parts of all others; this repeats until
    the key leaves so few bits that a bucket cannot be larger.
    """
    keys = [x for bits, t in plan_parts(distinct) for x in _signatures(bits, t)]
    fixed = {k: bits for k, (_, bits) in enumerate(keys)}
    keyed = distinct.select(F.explode(F.array(*(F.struct(F.lit(k).cast("long").alias("part"), v.alias("v")) for k, (v, _) in enumerate(keys)))).alias("x"), "fp", "rep").select("x.part", "x.v", "fp", "rep")
    pairs, in_bucket = None, F.col("count") <= BUCKET
    while True:
        small = {p: bits for p, bits in fixed.items() if BITS - len(bits) <= int(math.log2(BUCKET))}
        sizes = cut(keyed.groupBy("part", "v").count().where("count > 1"))
        whole = in_bucket | F.col("part").isin(list(small)) if small else in_bucket
        found = (
            keyed.join(sizes.where(whole).drop("count"), ["part", "v"])
            .repartition("part", "v")
            .sortWithinPartitions("part", "v")
            .mapInArrow(_matches, "a long, b long")
        )
        pairs = found if pairs is None else pairs.unionByName(found)
        hot = sizes.where(~whole)
        parts = sorted(r["part"] for r in hot.select("part").distinct().collect())
        if not parts:
            return pairs
        rows = cut(keyed.join(hot.drop("count"), ["part", "v"]))
        fixed, keyed, old = {}, None, fixed
        for p, k in ((p, k) for p in parts for k in range(3)):
            free = [b for b in range(BITS) if b not in old[p]][k::3]
            fixed[len(fixed)] = old[p] | set(free)
            more = rows.where(F.col("part") == p).select(F.lit(len(fixed) - 1).cast("long").alias("part"), F.col("v").bitwiseOR(_value(free)).alias("v"), "fp", "rep")
            keyed = more if keyed is None else keyed.unionByName(more)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links, itself included. Rows with a NULL doc_id take
    part through their text: they get the class of equal fingerprints, NULL if there is none. Repeated rows
    stay. Documents without words share the fingerprint 0. Other columns are not looked at.
    """
    prints = cut(fingerprints(docs))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL"))
    linked = components(near_pairs(distinct))
    labels = distinct.join(linked, distinct["rep"] == linked["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(labels, "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the least (doc_id, hash of the text), NULL ids last.

    Classes are of fingerprints, so texts that only share their doc_id are told apart, and rows without doc_id are
    in the class of their text like any others. Rows equal in doc_id and text are one. Columns may have any names.
    """
    name = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("hash"))
    prints = cut(fingerprints(docs.select(name.alias("doc_id"), "text")))
    distinct = cut(prints.select("fp").distinct().withColumn("rep", F.col("fp")))
    linked = components(near_pairs(distinct))
    labels = distinct.join(linked, distinct["rep"] == linked["node"], "left").select("fp", F.coalesce("component", "rep").alias("class"))
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(labels, "fp").groupBy("class").agg(F.min("first").alias("first"))
    key = [F.coalesce(F.col("n.doc_id").cast("string"), F.lit("")).alias("id"), F.col("n.last").alias("last"), F.col("n.hash").alias("hash")]
    keep = firsts.select(F.col("first").alias("n")).select(*key)
    rows = docs.select(F.struct(*docs.columns).alias("row"), name.alias("n")).select("row", *key)
    same = ["id", "last", "hash"]
    return rows.join(keep, same, "left_semi").dropDuplicates(same).select("row.*")
