"""Benchmark decontamination with suffix arrays over shards of the corpus.

A task cuts its documents into shards of bounded size, sorts each shard's suffixes of
words and binary-searches every window of the benchmark in them. The benchmark comes in blocks of bounded
size; one block is in a worker's memory at a time. Nothing is shuffled.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Bytes of benchmark words a block holds, and of text a shard holds (or one document, if that is longer).
BLOCK_BYTES, SHARD_BYTES = 2 << 20, 8 << 20
#: Longer items are searched in pieces that overlap by a window less one word.
PIECE_WORDS = 50_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Three word numbers of 21 bits make one sort key.
_BITS, _PACK = 21, 3


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


class Block:
    """Distinct windows of some items: their word numbers, lengths, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        self.vocab: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[str | None]] = {}
        for item, tokens in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in tokens]
            for i in range(max(1, len(ids) - WINDOW + 1)):
                seen.setdefault(tuple(ids[i : i + WINDOW]), set()).add(item)
        self.lengths = np.array([len(k) for k in seen], np.int64)
        self.windows = np.zeros((len(seen), _PACK * -(-WINDOW // _PACK)), np.int64)
        for row, k in zip(self.windows, seen):
            row[: len(k)] = k
        self.holders = [sorted(x for x in items if x is not None) for items in seen.values()]


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks, read one partition at a time; items without words have no windows."""
    items: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        tokens = words(text)
        for i in range(0, max(1, len(tokens) - WINDOW + 1), PIECE_WORDS):
            piece = tokens[i : i + PIECE_WORDS + WINDOW - 1]
            if not piece:
                continue
            if items and size + sum(map(len, piece)) > BLOCK_BYTES:
                yield Block(items)
                items, size = [], 0
            items.append((item, piece))
            size += sum(map(len, piece)) + len(piece)
    if items:
        yield Block(items)


def _key(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (ids[at] << 2 * _BITS) | (ids[at + 1] << _BITS) | ids[at + 2]


def suffix_array(ids: np.ndarray, least: int) -> np.ndarray:
    """Suffix starts in order of their first ``WINDOW`` words. 0 stands for words no item has.

    Suffixes that meet a 0 within ``least`` words cannot hold a window and are left out.
    ``ids`` ends with at least ``WINDOW + 3`` zeros.
    """
    zeros = np.flatnonzero(ids == 0)
    starts = np.flatnonzero(ids)
    starts = starts[zeros[np.searchsorted(zeros, starts)] - starts >= least]
    order = starts[np.argsort(_key(ids, starts), kind="stable")]
    if len(order) < 2:
        return order
    key = _key(ids, order)
    tied = np.r_[False, key[1:] == key[:-1]]
    for depth in range(_PACK, WINDOW, _PACK):
        group = np.cumsum(~tied)
        inside = np.flatnonzero(tied | np.r_[tied[1:], False])
        if not len(inside):
            break
        deeper = _key(ids, np.minimum(order[inside] + depth, len(ids) - _PACK))
        by = np.lexsort((deeper, group[inside]))
        order[inside] = order[inside][by]
        deeper, g = deeper[by], group[inside]
        tied = np.zeros(len(order), bool)
        tied[inside[1:]] = (deeper[1:] == deeper[:-1]) & (g[1:] == g[:-1])
    return order


def search(ids: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each window the range of suffixes that begin with it, by binary search key by key."""
    low, high = np.zeros(len(block.lengths), np.int64), np.full(len(block.lengths), len(order))
    for depth in range(0, WINDOW, _PACK):
        part = block.windows[:, depth : depth + _PACK]
        least = (part[:, 0] << 2 * _BITS) | (part[:, 1] << _BITS) | part[:, 2]
        known = np.clip(block.lengths - depth, 0, _PACK)
        most = least | ((np.int64(1) << (_BITS * (_PACK - known))) - 1)
        keys = _key(ids, np.minimum(order + depth, len(ids) - _PACK))

        def bisect(goal: np.ndarray, right: bool) -> np.ndarray:
            a, b = low.copy(), high.copy()
            while (open_ := a < b).any():
                middle = (a + b) // 2
                value = keys[np.minimum(middle, len(keys) - 1)]
                up = open_ & ((value <= goal) if right else (value < goal))
                a = np.where(up, middle + 1, a)
                b = np.where(open_ & ~up, middle, b)
            return a

        low, high = bisect(least, False), bisect(most, True)
    return low, high


def scan(texts: list[bytes], load: list[Callable[[], Block]]) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """Of each text of a shard: words, words hit, items found, and the longest stretches of hit words (start, end)."""
    counts = np.zeros(len(texts), np.int64)
    hit, items = None, [set() for _ in texts]
    for get in load or [lambda: Block([])]:
        block = get()
        number, parts = block.vocab.get, []
        for k, text in enumerate(texts):
            found = _WORD.findall(text)
            counts[k] = len(found)
            parts.append(np.fromiter(map(number, found, repeat(0)), np.int64, len(found)))
            parts.append(np.zeros(1, np.int64))
        ids = np.concatenate([*parts, np.zeros(WINDOW + _PACK, np.int64)])
        firsts = np.cumsum(np.r_[0, counts + 1])
        hit = np.zeros(len(ids) + 1, np.int64) if hit is None else hit
        if not len(block.lengths):
            continue
        order = suffix_array(ids, int(block.lengths.min()))
        if not len(order):
            continue
        low, high = search(ids, order, block)
        window = np.repeat(np.arange(len(low)), high - low)
        at = order[np.repeat(low, high - low) + np.arange(len(window)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + block.lengths[window], -1)
        doc = np.searchsorted(firsts, at, side="right") - 1
        for pair in np.unique(doc * len(low) + window).tolist():
            items[pair // len(low)].update(block.holders[pair % len(low)])
    covered = np.cumsum(hit) > 0
    edges = np.diff(np.r_[False, covered, False].astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans = [[] for _ in texts]
    for b, e, k in zip(begins.tolist(), ends.tolist(), (np.searchsorted(firsts, begins, side="right") - 1).tolist()):
        spans[k].append((b - int(firsts[k]), e - int(firsts[k])))
    return [(int(n), sum(e - b for b, e in s), sorted(i), s) for n, i, s in zip(counts, items, spans)]


def _loaders(shared: list[Broadcast]) -> list[Callable[[], Block]]:
    only: list[Block] = []

    def load(one: Broadcast) -> Block:
        if only:
            return only[0]
        block = pickle.loads(one.value)
        one.__dict__.pop("_value", None)  # the bytes are read again from the executor's disk if need be
        if len(shared) == 1:
            only.append(block)
        return block

    return [lambda one=one: load(one) for one in shared]


def _scanned(batches: Iterator[pa.RecordBatch], text_at: int, shared: list[Broadcast]) -> Iterator[tuple[pa.RecordBatch, list]]:
    load = _loaders(shared)
    for batch in batches:
        start, texts, size = 0, [], 0
        for i, text in enumerate(batch.column(text_at)):
            raw = (text.as_py() or "").encode().lower()
            if texts and size + len(raw) > SHARD_BYTES:
                yield batch.slice(start, len(texts)), scan(texts, load)
                start, texts, size = i, [], 0
            texts.append(raw)
            size += len(raw)
        if texts:
            yield batch.slice(start, len(texts)), scan(texts, load)


def _shared(docs: DataFrame, benchmark: DataFrame) -> list[Broadcast]:
    """Each block as bytes with its class, so that workers need not have the package on their path."""
    return [docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(b)) for b in blocks(benchmark)]


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row of ``docs``.

    ``items`` lists the item_ids (as text, sorted) of which a window of ``WINDOW`` words occurs, or the whole
    item if it is shorter; ``spans`` the longest stretches of hit words, as (start, end) in words. NULL texts
    have no words. Items with a NULL id count as hits but are not listed; items without words never match.
    Repeated rows stay; an empty benchmark hits nothing.
    """
    shared = _shared(docs, benchmark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scanned(batches, 1, shared):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(pa.string())),
                    pa.array([[{"start": b, "end": e} for b, e in f[3]] for f in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a window occurs; all columns as they are."""
    shared, text_at = _shared(docs, benchmark), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scanned(batches, text_at, shared):
            yield batch.filter(pa.array([not f[1] for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
