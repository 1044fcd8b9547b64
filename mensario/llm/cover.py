"""Near-duplicate embeddings by dual traversal of cover trees.

Vectors of length one at cosine c lie sqrt(2 - 2c) apart, so links are pairs within a
radius. Vectors are dealt into blocks of bounded size; a task takes two blocks, builds a cover tree
of each (nested levels, radii halved from level to level) and descends both at once. A pair
of nodes is left when its centres lie farther apart than both covering radii and the link radius.
What is left at the leaves is compared exactly, in double precision.

Every block meets every other one: no bound holds for all data in high dimensions, so
the work is quadratic in the number of distinct vectors where the trees cannot prune. The tasks stay of one size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut
from mensario.llm.components import components

COSINE = 0.9
#: Vectors of a block, and rows of a block compared at a time.
BLOCK, STRIP = 2048, 256
#: Children pairs from which two nodes are compared by a matrix product, and pairs unrolled at a time.
WIDE, PORTION = 4096, 100_000
#: Radii from 2 (any two unit vectors) down; below the last, points are leaves of their node.
LEVELS = (2.0, 1.0, 0.5, 0.25)
#: Bounds are widened by this much: the first look at a pair is in single precision.
SLACK = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first so that no square over- or underflows."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _away(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _net(x: np.ndarray, rows: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres among ``rows``, the first one included, farther apart than ``radius``; the nearest centre's number for each row."""
    centres, least = rows[:0], 1 - 0.5 * radius**2
    for i in range(0, len(rows), STRIP):
        part = rows[i : i + STRIP]
        if len(centres):
            part = part[(x[part] @ x[centres].T).max(axis=1) < least]
        near = x[part] @ x[part].T >= least
        chosen: list[int] = []
        for k in range(len(part)):
            if not near[k, chosen].any():
                chosen.append(k)
        centres = np.r_[centres, part[chosen]]
    owner = np.concatenate([(x[rows[i : i + STRIP]] @ x[centres].T).argmax(axis=1) for i in range(0, len(rows), STRIP)])
    return centres, owner


def cover_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of the leaves, and for each the number of its node on every level below the root.

    Levels are nested: a node's centre is the first row of its range and the centre of its own first child.
    """
    x = vectors.astype(np.float32)
    order, cuts, numbers = np.arange(len(x)), np.array([0, len(x)]), []
    for radius in LEVELS[1:]:
        ranges, sizes = [], []
        for b, e in zip(cuts[:-1], cuts[1:]):
            rows = order[b:e]
            if len(rows) == 1:
                ranges.append(rows)
                sizes.append(np.ones(1, np.int64))
                continue
            centres, owner = _net(x, rows, radius)
            of = {int(c): k for k, c in enumerate(centres)}
            is_centre = np.array([int(r) in of for r in rows])
            owner[is_centre] = [of[int(r)] for r in rows[is_centre]]
            ranges.append(rows[np.lexsort((~is_centre, owner))])
            sizes.append(np.bincount(owner, minlength=len(centres)))
        order, cuts = np.concatenate(ranges), np.r_[0, np.cumsum(np.concatenate(sizes))]
        numbers.append(np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)))
    return order, np.stack(numbers)


@dataclass
class Tree:
    """Vectors in leaf order; for each level where its nodes begin, how far they reach, and where their children begin."""

    x: np.ndarray
    begin: list[np.ndarray]
    radius: list[np.ndarray]
    child: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray, numbers: np.ndarray) -> Tree:
        begin = [np.zeros(1, np.int64), *(np.flatnonzero(np.r_[True, n[1:] != n[:-1]]) for n in numbers), np.arange(len(x))]
        radius = []
        for b in begin:
            centre = np.repeat(b, np.diff(np.r_[b, len(x)]))
            radius.append(np.maximum.reduceat(_away((x * x[centre]).sum(axis=1)), b))
        child = [np.r_[np.searchsorted(below, b), len(below)] for b, below in zip(begin, begin[1:])]
        return cls(x, begin, radius, child)


def dual(p: Tree, q: Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of p, row of q) at ``cosine`` or more; if p is q, each pair once and no row with itself."""
    reach, same = math.sqrt(2 - 2 * cosine) + SLACK, p is q
    fast = [[(t.x[b].astype(np.float32), r.astype(np.float32)) for b, r in zip(t.begin, t.radius)] for t in (p, q)]
    todo = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        depth, a, b = todo.pop()
        if depth == len(LEVELS):
            hit = np.einsum("ij,ij->i", p.x[a], q.x[b]) >= cosine
            if same:
                hit &= a < b
            yield a[hit], b[hit]
            continue
        found = []
        (u, ru), (v, rv) = fast[0][depth + 1], fast[1][depth + 1]
        first_a, first_b = p.child[depth][a], q.child[depth][b]
        width_a, width_b = p.child[depth][a + 1] - first_a, q.child[depth][b + 1] - first_b
        wide = width_a * width_b > WIDE
        for k in np.flatnonzero(wide).tolist():  # the upper levels: few nodes, products of matrices
            first, end = first_b[k], first_b[k] + width_b[k]
            mirrored = same and a[k] == b[k]
            for s in range(first_a[k], first_a[k] + width_a[k], STRIP):
                e = min(s + STRIP, first_a[k] + width_a[k])
                t = max(first, s) if mirrored else first
                bound = np.minimum(ru[s:e, None] + rv[None, t:end] + np.float32(reach), 2)
                bound *= bound
                bound *= -0.5
                bound += np.float32(1 - SLACK)
                rows, cols = np.nonzero(u[s:e] @ v[t:end].T >= bound)
                rows, cols = rows + s, cols + t
                if mirrored:
                    rows, cols = rows[rows <= cols], cols[rows <= cols]
                found.append((rows, cols))
        # the lower ones: many pairs of nodes with a few children each
        a, b, first_a, first_b, width_a, width_b = (x[~wide] for x in (a, b, first_a, first_b, width_a, width_b))
        many = width_a * width_b
        for low, high in _portions(many):
            pair = np.repeat(np.arange(low, high), many[low:high])
            within = np.arange(len(pair)) - np.repeat(np.cumsum(many[low:high]) - many[low:high], many[low:high])
            rows, cols = first_a[pair] + within // width_b[pair], first_b[pair] + within % width_b[pair]
            if same:
                up = (a[pair] != b[pair]) | (rows <= cols)
                rows, cols = rows[up], cols[up]
            near = _away(np.einsum("ij,ij->i", u[rows], v[cols])) <= ru[rows] + rv[cols] + reach + SLACK
            found.append((rows[near], cols[near]))
        if found:
            a, b = (np.concatenate(k) for k in zip(*found))
            todo.extend((depth + 1, a[k : k + PORTION], b[k : k + PORTION]) for k in range(0, len(a), PORTION))


def _portions(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PORTION`` in all, so that what is unrolled at once stays bounded."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PORTION, side="right")))
        yield low, high
        low = high


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node each of ``n`` nodes is linked with, over any number of links."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root[a] == root[b]).all():
            break
    return root


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks()
    flat = flat.flatten().to_numpy(zero_copy_only=False)
    return unit(flat.reshape(table.num_rows, -1))


def _build(block: pa.Table) -> pa.Table:
    """A block's rows in the leaf order of its cover tree, with the numbers of their nodes."""
    order, numbers = cover_tree(_vectors(block))
    block = block.take(pa.array(order)).append_column("pos", pa.array(np.arange(len(order), dtype=np.int32)))
    for k, n in enumerate(numbers, start=1):
        block = block.append_column(f"node{k}", pa.array(n.astype(np.int32)))
    return block


def _meet(cosine: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Links between the two blocks: how many each vector has, and the root of its tree of links."""
        same = key[1] == key[2]
        rows = rows.sort_by([("block", "ascending"), ("pos", "ascending")])
        x, block = _vectors(rows), rows.column("block").to_numpy()
        numbers = np.stack([rows.column(f"node{k}").to_numpy() for k in range(1, len(LEVELS))])
        ids, mult, n = rows.column("rep").to_numpy(), rows.column("n").to_numpy(), int((block == block[0]).sum())
        links, a, b = np.zeros(len(ids), np.int64), [], []
        if same or n < len(ids):
            p = Tree.of(x[:n], numbers[:, :n])
            q = p if same else Tree.of(x[n:], numbers[:, n:])
            shift = 0 if same else n
            for i, j in dual(p, q, cosine):
                np.add.at(links, i, mult[j + shift])
                np.add.at(links, j + shift, mult[i])
                a.append(i)
                b.append(j + shift)
        root = _forest(len(ids), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(ids))
        hit = links > 0
        return pa.table({"rep": pa.array(ids[hit]), "links": pa.array(links[hit]), "root": pa.array(ids[root[hit]])})

    return run


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    ``n_links``: other rows at ``cosine`` or more; ``component_id``: the least vec_id reachable over links, itself
    included; ``kept`` marks it. Vectors that are NULL, empty, all zero, or hold a NULL or a number that is not
    finite link with nothing; so do vectors of different lengths with one another. Equal vectors are compared once and
    count as often as they occur. Rows without vec_id link with nothing either. Labels are not looked at.
    """
    rows = cut(vectors.select("vec_id", F.col("embedding").alias("v")))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    good = F.coalesce(F.col("v").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("v", lambda e: e != 0), F.lit(False))
    usable = rows.where(good).withColumn("h", F.xxhash64("v"))
    distinct = cut(usable.groupBy("h", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    n_blocks = max(1, -(-distinct.count() // BLOCK))
    blocked = distinct.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("h"), F.lit(n_blocks)).cast("int").alias("block"), "rep", "n", "v")
    kind, of = vectors.schema["vec_id"].dataType.simpleString(), vectors.schema["embedding"].dataType.simpleString()
    nodes = ", ".join(f"node{k} int" for k in range(1, len(LEVELS)))
    trees = cut(blocked.groupBy("dim", "block").applyInArrow(_build, f"dim int, block int, rep {kind}, n long, v {of}, pos int, {nodes}"))
    met = trees.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    found = cut(met.groupBy("dim", "p", "q").applyInArrow(_meet(cosine), f"rep {kind}, links long, root {kind}"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    labels = distinct.join(counts, "rep", "left").join(linked, F.col("rep") == F.col("node"), "left").select(
        "h", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    classed = usable.join(cut(labels), ["h", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return classed.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
