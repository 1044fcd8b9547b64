"""Language identification by a convolutional network over bytes.

Windows of ``WINDOW`` bytes; byte embeddings; filters of several widths; maximum over the
window; softmax. Trained in numpy on a bounded, stratified sample of labelled rows.
A text's scores are the means over all its windows, weighted by their bytes of letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import fold, stratified

WINDOW, DIM, WIDTHS, FILTERS = 128, 8, (2, 3, 4), 16
#: Rows of each language learnt from, at most about so many, and windows of each.
ROWS_PER_LANGUAGE, WINDOWS_PER_ROW = 1500, 3
EPOCHS, BATCH, RATE = 8, 256, 0.01
#: Below this score a language is not told (``identified``).
LEAST_SCORE = 0.4
UNKNOWN = "und"
_WIDE = max(WIDTHS)


@dataclass
class Network:
    """Weights; ``filters`` holds all widths in one matrix, zero beyond a filter's width."""

    languages: list[str]
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # (_WIDE * DIM) x F
    bias: np.ndarray
    out: np.ndarray  # F x languages
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximum of each filter over each window, its place, and the unrolled input."""
        x = self.embed[windows]  # n x (WINDOW + pad) x DIM
        n, length = windows.shape
        step = x.strides
        rolled = np.lib.stride_tricks.as_strided(x, (n, length - _WIDE + 1, _WIDE * DIM), step)
        flat = np.ascontiguousarray(rolled)
        conv = (flat.reshape(-1, _WIDE * DIM) @ self.filters).reshape(n, length - _WIDE + 1, -1)
        return conv, flat, x

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        conv, _, _ = self.pooled(windows)
        return _softmax(np.maximum(conv.max(axis=1) + self.bias, 0) @ self.out + self.out_bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def to_windows(text: str) -> np.ndarray:
    """All bytes of ``text`` in rows of WINDOW bytes, each followed by the bytes a filter needs beyond it."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    padded = np.zeros(n * WINDOW + _WIDE - 1, np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + _WIDE - 1), (WINDOW, 1))


def train(texts: list[str], labels: list[str], seed: int = 7) -> Network:
    """A network from texts of at most a few windows each. Empty input gives a network without languages."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    mask = np.zeros((_WIDE * DIM, len(WIDTHS) * FILTERS), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * DIM, k * FILTERS : (k + 1) * FILTERS] = 1
    n_out = max(1, len(languages))
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
        (rng.normal(0, 0.25, mask.shape) * mask).astype(np.float32),
        np.zeros(mask.shape[1], np.float32),
        rng.normal(0, 0.2, (mask.shape[1], n_out)).astype(np.float32),
        np.zeros(n_out, np.float32),
    )
    pieces = []
    for text, label in zip(texts, labels):
        tokens = text.split()
        short = " ".join(tokens[int(rng.integers(0, len(tokens))) :][: int(rng.integers(1, 6))]) if tokens else ""
        pieces += [(w, languages.index(label)) for t in (text, short) if has_letter(t) for w in to_windows(t)]
    if not pieces:
        return net
    x, y = np.stack([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    weight = (len(y) / (n_out * np.maximum(np.bincount(y, minlength=n_out), 1))).astype(np.float32)
    names = ("embed", "filters", "bias", "out", "out_bias")
    m1 = {k: np.zeros_like(getattr(net, k)) for k in names}
    m2 = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    total = EPOCHS * -(-len(y) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            pick = order[i : i + BATCH]
            step += 1
            grads = _gradients(net, x[pick], y[pick], weight, mask)
            rate = RATE * (1 - step / (total + 1))
            for k, g in grads.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                move = rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    n = len(y)
    conv, flat, emb = net.pooled(x)
    place = conv.argmax(axis=1)  # n x F
    top = np.take_along_axis(conv, place[:, None, :], axis=1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    p = _softmax(hidden @ net.out + net.out_bias)
    p[np.arange(n), y] -= 1
    p *= weight[y][:, None] / n
    back = (p @ net.out.T) * (top > 0)
    rows = np.arange(n)[:, None]
    at = flat[rows, place]  # n x F x (_WIDE * DIM)
    filters = np.einsum("nfk,nf->kf", at, back) * mask
    into = back[:, :, None] * net.filters.T[None]  # n x F x (_WIDE * DIM)
    embed = np.zeros_like(net.embed)
    for j in range(_WIDE):
        np.add.at(embed, x[rows, place + j].ravel(), into[:, :, j * DIM : (j + 1) * DIM].reshape(-1, DIM))
    return {"embed": embed, "filters": filters, "bias": back.sum(axis=0), "out": hidden.T @ p, "out_bias": p.sum(axis=0)}


def learn(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> Network:
    """Trained on about ``rows`` rows of each language (fewer where there are fewer), never on held-out rows."""
    known = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    length = F.greatest(F.length("text") - 2 * WINDOW, F.lit(0)) + 1
    cuts = F.array(*(F.substring(F.col("text"), F.pmod(F.xxhash64("doc_id", F.lit(k)), length).cast("int") + 1, F.lit(2 * WINDOW)) for k in range(WINDOWS_PER_ROW)))
    sample = stratified(known, "lang", "doc_id", rows).select("doc_id", F.explode(cuts).alias("piece"), "lang").distinct().collect()
    sample = sorted((r["doc_id"], r["piece"], r["lang"]) for r in sample)
    return train([s[1] for s in sample], [s[2] for s in sample])


def _letters() -> np.ndarray:
    letter = np.zeros(256, np.float32)
    for low, high in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        letter[low : high + 1] = 1
    return letter


def score(net: Network, texts: list[str | None], chunk: int = 256) -> tuple[list[str], list[float]]:
    """Language and score of each text; long texts are scored in chunks, so memory stays bounded."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    letter = _letters()
    sums = np.zeros((len(texts), max(1, len(net.languages))))
    waiting: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        windows = np.concatenate(waiting)
        weight = letter[windows[:, :WINDOW]].sum(axis=1) + 1e-3
        np.add.at(sums, np.array(owner), net.probabilities(windows) * weight[:, None])
        waiting.clear()
        owner.clear()

    for k, text in enumerate(texts):
        if text is None or not has_letter(text) or not net.languages:
            continue
        rows = to_windows(text)
        for i in range(0, len(rows), chunk):
            waiting.append(rows[i : i + chunk])
            owner.extend([k] * len(waiting[-1]))
            if len(owner) >= chunk:
                flush()
    if owner:
        flush()
    for k in np.flatnonzero(sums.sum(axis=1)):
        p = sums[k] / sums[k].sum()
        names[k], scores[k] = net.languages[int(p.argmax())], float(p.max())
    return names, scores


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``, from its text alone.

    NULL texts and texts without a letter are ``und`` with score 0, as is everything if no row had a label.
    Repeated rows stay; ties go to the first language by name. A row without doc_id counts as not held out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = score(net, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, net: Network, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without rows whose language is not told: no letter, or a score below ``least``. Columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = score(net, batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
