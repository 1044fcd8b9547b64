"""Two tokenizers' tokens of the same texts, aligned by bytes, and how often their ids meet.

Texts are cut where white space begins, which no token of either vocabulary crosses, and
every distinct stretch is encoded and aligned once a task. A pair of ids that stand for the
same bytes is an identity: its place in an array over the first vocabulary says all about
it, so identities are counted in vectors as long as that vocabulary. Only the other,
irregular pairs are shuffled: first their counts, then each document's pairs to the counts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut
from mensario.llm.pieces import SPACE, Vocabulary, by_size, ragged, vocabulary

#: Characters of text aligned at once; distinct stretches and links a task keeps.
BATCH_SYMBOLS, KEPT_STRETCHES, KEPT_LINKS = 1 << 18, 1 << 18, 1 << 21
#: Irregular pairs with more than one in so many of all rows are at most so many, and their counts are broadcast.
HOT_PAIRS = 100_000


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass
class Pair:
    """Both vocabularies: bytes of each id, and ``identity``, for each first id the second id of the same bytes or -1."""

    first: str
    second: Vocabulary
    bytes_a: np.ndarray
    lengths_a: np.ndarray
    bytes_b: np.ndarray
    lengths_b: np.ndarray
    identity: np.ndarray
    spaces: str

    def stretches(self, text: str) -> list[str]:
        """``text`` cut before each of ``spaces`` that follows no white space."""
        if not self.spaces:
            return [text]
        return re.findall(rf"[{self.spaces}]?[^{self.spaces}]*(?:(?<=\s)[{self.spaces}][^{self.spaces}]*)*", text)[:-1]


def _joined(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)


def pair(path_a: str, path_b: str) -> Pair:
    """Read on the driver: a byte-level vocabulary with its merges, and a model of pieces."""
    with open(path_a, encoding="utf-8") as file:
        first = file.read()
    said, letters = json.loads(first), byte_letters()
    vocab = said["model"]["vocab"]
    tokens_a = [b""] * (max([*vocab.values(), *(t["id"] for t in said["added_tokens"])]) + 1)
    for token, number in vocab.items():
        tokens_a[number] = bytes(letters[c] for c in token)
    second = vocabulary(path_b)
    tokens_b = []
    for number, piece in enumerate(second.piece):
        tokens_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte[number] else piece.replace(SPACE, " ").encode() if second.is_text[number] else b"")
    of = {}
    for number, token in enumerate(tokens_b):
        if token and (token not in of or second.is_byte[of[token]]):  # a piece before the byte
            of[token] = number
    identity = np.array([of.get(t, -1) if t else -1 for t in tokens_a], np.int64)
    a, len_a = _joined(tokens_a)
    b, len_b = _joined(tokens_b)
    # white space that any pattern takes for white space and that no piece holds behind another character
    spaces = " " + "".join(c for c in "\n\t" if second.never_follows(c)) if second.words_apart else ""
    return Pair(first, second, a, len_a, b, len_b, identity, spaces)


def _written(ids: int, end: str) -> np.ndarray:
    """Every id as text with ``end`` behind it."""
    return np.array([f"{i}{end}" for i in range(ids)], object)


class _Store:
    """What is known of each distinct stretch: tokens, groups, links, and the groups written out, each with a semicolon behind."""

    def __init__(self, both: Pair):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        self.both = both
        self.tokenizer = Tokenizer.from_str(both.first)
        self.tokenizer.encode_special_tokens = True
        self.begins_a = np.cumsum(both.lengths_a) - both.lengths_a
        self.begins_b = np.cumsum(both.lengths_b) - both.lengths_b
        n_a, n_b = len(both.identity), both.second.size
        # what stands behind an id: of the first side inside a group and at its end, then of the second
        self.texts = np.concatenate([_written(n_a, ","), _written(n_a, "|"), _written(n_b, ","), _written(n_b, ";")])
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.number: dict[str, int] = {}
        self.written: list[str] = []
        self.whole, self.n_a, self.n_b, self.n_groups, self.n_links, self.links = np.zeros(0, bool), none, none, none, none, none

    def full(self) -> bool:
        return len(self.number) > KEPT_STRETCHES or len(self.links) > KEPT_LINKS

    def _whole(self, fresh: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Which stretches both sides give back byte for byte."""
        both, raw = self.both, [s.encode() for s in fresh]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        texts, edges = [], []
        for bytes_, begins, lengths, ids, n in ((both.bytes_a, self.begins_a, both.lengths_a, a, n_a), (both.bytes_b, self.begins_b, both.lengths_b, b, n_b)):
            texts.append(bytes_[ragged(begins[ids], lengths[ids])].tobytes())
            edges.append(np.r_[0, np.cumsum(lengths[ids])][np.r_[0, np.cumsum(n)]])
        if all((np.diff(e) == sizes).all() for e in edges) and texts[0] == texts[1] == b"".join(raw):
            return np.ones(len(fresh), bool)
        (text_a, text_b), (edge_a, edge_b) = texts, (e.tolist() for e in edges)
        return np.array([r == text_a[edge_a[i] : edge_a[i + 1]] == text_b[edge_b[i] : edge_b[i + 1]] for i, r in enumerate(raw)], bool)

    def add(self, fresh: list[str]) -> None:
        """Encode and align stretches not met before."""
        both, width = self.both, self.both.second.size
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        n_a = np.fromiter(map(len, ids), np.int64, len(ids))
        a = np.fromiter(chain.from_iterable(ids), np.int64, int(n_a.sum()))
        b, n_b = both.second.encode_words([s.replace(" ", SPACE) for s in fresh])
        b = b.astype(np.int64)
        whole = self._whole(fresh, a, n_a, b, n_b)
        of_a, of_b = np.repeat(np.arange(len(fresh)), n_a), np.repeat(np.arange(len(fresh)), n_b)
        a, of_a = a[whole[of_a]], of_a[whole[of_a]]
        b, of_b = b[whole[of_b]], of_b[whole[of_b]]
        end_a, end_b = np.cumsum(both.lengths_a[a]), np.cumsum(both.lengths_b[b])
        shared = np.intersect1d(end_a, end_b, assume_unique=True)  # the ends of groups
        ends = np.union1d(end_a, end_b)  # between two of them lie one token of each side: a link
        link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        count = lambda of: np.bincount(of, minlength=len(fresh)).astype(np.int64)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        n = len(both.identity)
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        texts = self.texts[np.r_[a + n * last_a, 2 * n + b + width * last_b][order]].tolist()
        edges = np.r_[0, np.cumsum(count(of_a) + count(of_b))].tolist()
        self.number.update(zip(fresh, range(len(self.written), len(self.written) + len(fresh))))
        self.written.extend(map("".join, map(texts.__getitem__, map(slice, edges[:-1], edges[1:]))))
        self.whole = np.r_[self.whole, whole]
        self.n_a, self.n_b = np.r_[self.n_a, count(of_a)], np.r_[self.n_b, count(of_b)]
        self.n_groups = np.r_[self.n_groups, count(of_a[last_a])]
        self.n_links = np.r_[self.n_links, count(of_a[link_a])]
        self.links = np.r_[self.links, a[link_a] * width + b[link_b]]


def _lists(values: np.ndarray, of: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """``values`` in lists by their row ``of``, which ascends."""
    offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=n))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_PARTS = "n_a long, n_b long, n_groups long, n_links long, groups {groups}, same array<int>, same_n array<int>, other array<long>, other_n array<int>"


def _aligned(both: Pair, store: _Store, part: pa.RecordBatch, texts: list[str], digest: bool) -> pa.RecordBatch:
    split = [both.stretches(" " + t) if t else [] for t in texts]
    known = store.number
    fresh = list({s for stretches in split for s in stretches if s not in known})
    if fresh:
        store.add(fresh)
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
    of = np.repeat(np.arange(len(texts)), counts)
    whole = np.ones(len(texts), bool)
    whole[of[~store.whole[flat]]] = False
    ok = whole[of]
    flat, of = flat[ok], of[ok]
    total = lambda values: np.bincount(of, values[flat], len(texts)).astype(np.int64)
    begins = np.cumsum(store.n_links) - store.n_links
    codes = store.links[ragged(begins[flat], store.n_links[flat])]
    doc = np.repeat(of, store.n_links[flat])
    width = len(both.identity) * both.second.size
    found, n = np.unique(doc * width + codes, return_counts=True)
    doc, code = found // width, found % width
    first = code // both.second.size
    same = both.identity[first] == code % both.second.size
    groups, edges = [], np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))].tolist()
    numbers = flat.tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        text = "".join(map(store.written.__getitem__, numbers[a:b]))[:-1]
        groups.append(sha256(text.encode()).hexdigest() if digest and text else text)
    return pa.RecordBatch.from_arrays(
        [
            part.column(0), part.column(2), *(pa.array(total(v)) for v in (store.n_a, store.n_b, store.n_groups, store.n_links)), pa.array(groups, pa.string()),
            _lists(first[same], doc[same], len(texts), pa.int32()), _lists(n[same], doc[same], len(texts), pa.int32()),
            _lists(code[~same], doc[~same], len(texts), pa.int64()), _lists(n[~same], doc[~same], len(texts), pa.int32()),
        ],
        names=["doc_id", "_row", "n_a", "n_b", "n_groups", "n_links", "groups", "same", "same_n", "other", "other_n"],
    )


def _align(docs: DataFrame, both: Pair, digest: bool) -> DataFrame:
    """One row per row of ``docs``: tokens, groups, and each distinct pair of linked ids with its links."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(both)
        for batch in batches:
            for part, texts in by_size(batch, 1, BATCH_SYMBOLS):
                yield _aligned(both, store, part, texts, digest)
                if store.full():
                    store.clear()

    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    return rows.mapInArrow(run, f"doc_id {kind}, _row long, {_PARTS.format(groups='string')}")


def _identity_counts(aligned: DataFrame, size: int) -> np.ndarray:
    """For each first id the documents that hold its identity linked. A task adds up a vector as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(np.asarray(batch.column(0).flatten()), minlength=size)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], names=["a", "n"])

    counts = np.zeros(size, np.int64)
    for row in aligned.select("same").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        counts[row["a"]] = row["n"]
    return counts


def _of_identities(aligned: DataFrame, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """The sums over the links of identities, from the vectors."""
    kept = ["doc_id", "_row", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            ids, n = np.asarray(lists.flatten()), np.asarray(batch.column(len(kept) + 1).flatten()).astype(np.int64)
            edges = np.r_[0, np.cumsum(np.asarray(pa.compute.list_value_length(lists)).astype(np.int64))]
            total = lambda values: np.diff(np.r_[0, np.cumsum(values)][edges])
            sums = [pa.array(total(n * counts[ids])), pa.array(total(n * (counts[ids] == best[ids])))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *sums], names=[*kept, "same_sum", "same_best"])

    kinds = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in kept)
    return aligned.select(*kept, "same", "same_n").mapInArrow(run, f"{kinds}, same_sum long, same_best long")


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of ``docs`` (doc_id, text).

    A space and the text are encoded with both vocabularies. ``groups`` lists the ids of both sides between
    neighbouring places where a token of each side ends, as ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that. A link is a
    token of each side whose bytes overlap; its count is the number of rows of ``docs`` that hold the pair of its ids linked.
    ``n_best`` counts the links whose count is the highest of their first id, ``count_sum`` adds up all counts.

    A NULL or empty text, or one whose bytes a vocabulary does not give back, has no tokens: zeros and an empty
    ``groups``. Repeated rows count each; no rows give no rows; columns besides doc_id and text are not looked at.
    Vectors over the first vocabulary go to the driver and back, and at most ``HOT_PAIRS`` pair counts are broadcast.
    """
    both = pair(path_a, path_b)
    aligned = cut(_align(docs, both, digest))
    same = _identity_counts(aligned, len(both.identity))
    link = F.explode(F.arrays_zip("other", "other_n")).alias("l")
    others = aligned.select("_row", link).select("_row", F.col("l.other").alias("code"), F.col("l.other_n").alias("n"))
    counts = cut(others.groupBy("code").agg(F.count("*").alias("held")))
    first_id = F.expr(f"code div {both.second.size}").alias("a")
    best = same.copy()
    for row in counts.groupBy(first_id).agg(F.max("held").alias("m")).collect():  # a row an id
        best[row["a"]] = max(best[row["a"]], row["m"])
    tops = docs.sparkSession.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "a long, best long")
    ranked = counts.select("code", "held", first_id).join(F.broadcast(tops), "a")
    counts = cut(ranked.select("code", "held", (F.col("held") == F.col("best")).alias("top")))
    rows = counts.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    hot = F.col("held") > rows / HOT_PAIRS
    marked = others.join(F.broadcast(counts.where(hot)), "code", "left")
    known = marked.where("held is not null")
    rare = marked.where("held is null").select("_row", "code", "n").join(counts.where(~hot), "code")
    sums = [F.sum(F.col("n") * F.col("held")).alias("other_sum"), F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).alias("other_best")]
    by_row = known.select("_row", "n", "held", "top").unionByName(rare.select("_row", "n", "held", "top")).groupBy("_row").agg(*sums)
    both_sums = _of_identities(aligned, same, best).join(by_row, "_row", "left")
    plus = lambda x, y, name: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).cast("long").alias(name)
    return both_sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", plus("same_best", "other_best", "n_best"), plus("same_sum", "other_sum", "count_sum"), "groups")
