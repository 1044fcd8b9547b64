"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is an embedding of the word, the mean of embeddings of its character
grams of 3, 5 and 7 bytes, and the sum of embeddings of its beginnings (a stem with any ending looks alike). Windows of ``WINDOW`` words start every ``STRIDE`` words, so they overlap; a text's score is a logistic
function of its highest windows, of how many are expected to be toxic, and of how many there are. Labels hold for whole texts, so training first takes the windows of
toxic texts with the character grams most typical of toxic texts, then those the network itself
scores highest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import fold, stratified

WINDOW, STRIDE = 16, 12
WORD_ROWS, GRAM_BITS, DIM, HIDDEN, ATTEND = 1 << 15, 17, 8, 8, 8
GRAM_ROWS = 1 << GRAM_BITS
#: Bytes of a gram; a word with its marks has one of three at least.
GRAMS = (3, 5, 7)
#: Bytes of a beginning, the mark included.
STEMS = (4, 5, 6, 7, 8)
INPUT = 3 * DIM
#: Texts of each label learnt from, at most about so many.
ROWS_PER_LABEL = 2500
EPOCHS, BATCH, RATE = 8, 128, 0.01
#: Logits are cut here before they count as evidence.
LIMIT = 12.0
#: Words a worker keeps the inputs of before it starts afresh, and windows it scores at once.
CACHE, CHUNK = 100_000, 4096
#: Columns of the update, reset and candidate gates.
GATES = (slice(0, HIDDEN), slice(HIDDEN, 2 * HIDDEN), slice(2 * HIDDEN, 3 * HIDDEN))
_WORD = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def starts(n: int) -> range:
    """First words of the windows that cover ``n`` words."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Rows of the character grams of each word, marked at both ends; how many each has; rows of beginnings, and whose."""
    raw = [b"<" + w.encode() + b">" for w in words]
    joined = np.frombuffer(b"\0".join(raw) + b"\0" * max(*GRAMS, *STEMS), np.uint8).astype(np.uint64)
    lengths = np.array([len(r) for r in raw], np.int64)
    firsts = np.cumsum(np.r_[0, lengths[:-1] + 1])
    rows, owners = [], []

    def hashed(n: int, salt: int) -> np.ndarray:
        code = np.full(len(joined) - n + 1, salt, np.uint64)
        for k in range(n):
            code = (code * np.uint64(257)) + joined[k : len(joined) - n + 1 + k]
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)

    for n in GRAMS:
        code = hashed(n, n)
        count = np.maximum(lengths - n + 1, 0)
        owner = np.repeat(np.arange(len(raw)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        rows.append(code[firsts[owner] + within])
        owners.append(owner)
    rows, owner = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    begun = [(hashed(n, 100 + n)[firsts[long]], long) for n in STEMS if len(long := np.flatnonzero(lengths >= n))]
    stems = tuple(np.concatenate(x) for x in zip(*begun)) if begun else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return rows[order], np.bincount(owner, minlength=len(raw)), stems


def word_rows(words: list[str]) -> np.ndarray:
    return np.array([1 + zlib.crc32(w.encode()) % (WORD_ROWS - 1) for w in words], np.int64)


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    distinct, first = np.unique(rows[order], return_index=True)
    return distinct, np.add.reduceat(values[order], first, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    p: dict[str, np.ndarray]
    #: Weights of ``evidence``, the last one constant.
    weights: np.ndarray = field(default_factory=lambda: np.array([1.0, 0, 0, 0, 0, 0]))
    #: The score of a text without words.
    empty: float = 0.0
    cache: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        p = {"words": normal(WORD_ROWS, DIM, scale=0.1), "grams": normal(GRAM_ROWS, DIM, scale=0.3)}
        for d in "fb":
            p |= {f"x{d}": normal(INPUT, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32), f"h{d}": normal(HIDDEN, 3 * HIDDEN, scale=0.3)}
        p |= {"a": normal(2 * HIDDEN, ATTEND, scale=0.3), "av": normal(ATTEND, scale=0.3), "o": normal(2 * HIDDEN, scale=0.3), "ob": np.zeros(1, np.float32)}
        return cls(p)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """The input vector of each word; what their gradients need."""
        rows, counts, stems = grams(words)
        at = word_rows(words)
        owner = np.repeat(np.arange(len(words)), counts)
        mean = np.add.reduceat(self.p["grams"][rows], np.cumsum(counts) - counts, axis=0) / counts[:, None].astype(np.float32)
        begun = np.zeros((len(words), DIM), self.p["grams"].dtype)
        np.add.at(begun, stems[1], self.p["grams"][stems[0]])
        return np.concatenate([self.p["words"][at], mean, begun], axis=1), (rows, counts, owner, at, stems)

    def run(self, xf: np.ndarray, xb: np.ndarray, real: np.ndarray, keep: bool = False):
        """Logit of each window from its projected inputs (n x WINDOW x 3 HIDDEN), words that are none masked out."""
        n, steps = real.shape
        states = np.zeros((n, steps, 2 * HIDDEN), np.float32)
        saved = {"f": [], "b": []}
        for d, x, order in (("f", xf, range(steps)), ("b", xb, range(steps - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            u, half = self.p[f"h{d}"], slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in order:
                g = h @ u
                zr = _sigmoid(x[:, t, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, t, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if keep:
                    saved[d].append((t, h, z, r, c, g[:, 2 * HIDDEN :]))
                h = new
                states[:, t, half] = h
        act = np.tanh(states.reshape(-1, 2 * HIDDEN) @ self.p["a"]).reshape(n, steps, ATTEND)
        e = act @ self.p["av"]
        e = np.where(real, e, np.float32(-1e9))
        w = np.exp(e - e.max(axis=1, keepdims=True))
        w /= w.sum(axis=1, keepdims=True)
        pooled = (w[:, :, None] * states).sum(axis=1)
        logit = pooled @ self.p["o"] + self.p["ob"][0]
        return (logit, states, saved, act, w, pooled) if keep else logit

    def logits(self, tables: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """What ``run`` gives, for windows of rows of ``tables`` (one table per direction and gate, row 0 for no word).

        Every array is contiguous and no wider than a gate, and the attention sums scalars instead of states.
        """
        n, steps = at.shape
        a, o = self.p["a"], self.p["o"]
        act = [np.zeros((n, ATTEND), np.float32) for _ in range(steps)]
        vote = np.zeros((steps, n), np.float32)
        columns = np.ascontiguousarray(at.T)
        for k, d in enumerate("fb"):
            uz, ur, uc = (np.ascontiguousarray(self.p[f"h{d}"][:, g]) for g in GATES)
            xz, xr, xc = tables[3 * k : 3 * k + 3]
            half = slice(k * HIDDEN, (k + 1) * HIDDEN)
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                row = columns[t]
                z = xz.take(row, axis=0)
                z += h @ uz
                r = xr.take(row, axis=0)
                r += h @ ur
                for gate in (z, r):
                    gate *= 0.5
                    np.tanh(gate, out=gate)
                    gate += 1
                    gate *= 0.5
                r *= h @ uc
                r += xc.take(row, axis=0)
                np.tanh(r, out=r)
                h -= r
                h *= z
                h += r
                act[t] += h @ a[half]
                vote[t] += h @ o[half]
        e = np.stack([np.tanh(x, out=x) @ self.p["av"] for x in act])
        e[columns == 0] = -1e9
        e -= e.max(axis=0)
        np.exp(e, out=e)
        return (e * vote).sum(axis=0) / e.sum(axis=0) + self.p["ob"][0]

    def gradients(self, words: list[str], ids: np.ndarray, y: np.ndarray) -> dict[str, tuple[np.ndarray | slice, np.ndarray]]:
        """Of the mean log loss of the windows ``ids`` (rows of numbers into ``words``, -1 for none): rows and their gradient."""
        p, n = self.p, len(ids)
        vec, (rows, counts, owner, at, stems) = self.inputs(words)
        vec = np.concatenate([vec, np.zeros((1, INPUT), np.float32)])
        real = ids >= 0
        xs = {d: (vec @ p[f"x{d}"] + p[f"c{d}"])[ids] for d in "fb"}
        logit, states, saved, act, w, pooled = self.run(xs["f"], xs["b"], real, True)
        out = ((_sigmoid(logit) - y) / n).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "grams")}
        g["o"], g["ob"] = pooled.T @ out, np.array([out.sum()], np.float32)
        back = out[:, None] * p["o"]
        d_states = w[:, :, None] * back[:, None, :]
        d_w = (states * back[:, None, :]).sum(axis=2)
        d_e = w * (d_w - (w * d_w).sum(axis=1, keepdims=True))
        g["av"] = (act * d_e[:, :, None]).sum(axis=(0, 1))
        d_act = (d_e[:, :, None] * p["av"]) * (1 - act**2)
        g["a"] = states.reshape(-1, 2 * HIDDEN).T @ d_act.reshape(-1, ATTEND)
        d_states = d_states + d_act @ p["a"].T
        d_vec = np.zeros_like(vec)
        for d in "fb":
            half = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            dh, dx = np.zeros((n, HIDDEN), np.float32), np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            for t, h, z, r, c, gc in reversed(saved[d]):
                dh = dh + d_states[:, t, half]
                dc = dh * (1 - z) * (1 - c**2)
                dz = dh * (h - c) * z * (1 - z)
                dr = dc * gc * r * (1 - r)
                dx[:, t] = np.concatenate([dz, dr, dc], axis=1)
                dg = np.concatenate([dz, dr, dc * r], axis=1)
                g[f"h{d}"] += h.T @ dg
                dh = dh * z + dg @ p[f"h{d}"].T
            each = np.zeros((len(vec), 3 * HIDDEN), np.float32)
            np.add.at(each, ids.ravel(), dx.reshape(-1, 3 * HIDDEN))
            g[f"x{d}"], g[f"c{d}"] = vec.T @ each, each.sum(axis=0)
            d_vec += each @ p[f"x{d}"].T
        d_vec = d_vec[:-1]
        touched = {"words": _by_row(at, d_vec[:, :DIM]), "grams": _by_row(np.r_[rows, stems[0]], np.concatenate([(d_vec[:, DIM : 2 * DIM] / counts[:, None])[owner], d_vec[stems[1], 2 * DIM :]]))}
        return {k: (slice(None), x) for k, x in g.items()} | touched

    def windows(self, docs: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, logit) of all windows of all documents, so many at a time."""
        known, tables = self.cache.setdefault("ids", {}), self.cache
        ids, owner = [], []

        def project() -> None:
            done = len(tables["x"][0]) - 1 if "x" in tables else 0
            new = list(known)[done:]
            if not new:
                return
            vec, _ = self.inputs(new)
            add = [vec @ self.p[f"x{d}"][:, g] + self.p[f"c{d}"][g] for d in "fb" for g in GATES]
            old = tables.get("x") or [self.p[f"c{d}"][None, g] for d in "fb" for g in GATES]  # row 0: no word
            tables["x"] = [np.concatenate([o, x]) for o, x in zip(old, add)]

        def flush() -> tuple[np.ndarray, np.ndarray]:
            project()
            at = np.concatenate(ids)
            logits = self.logits(tables["x"], at)
            result = np.array(owner), logits
            ids.clear()
            owner.clear()
            if len(known) > CACHE:
                known.clear()
                tables.pop("x", None)
            return result

        for k, words in enumerate(docs):
            if not words:
                continue
            for low in range(0, len(starts(len(words))), CHUNK):
                firsts = starts(len(words))[low : low + CHUNK]
                part = words[firsts[0] : firsts[-1] + WINDOW]
                row = np.zeros(STRIDE * (len(firsts) - 1) + WINDOW, np.int64)
                row[: len(part)] = [known.setdefault(w, len(known) + 1) for w in part]
                ids.append(np.lib.stride_tricks.sliding_window_view(row, WINDOW)[::STRIDE])
                owner.extend([k] * len(firsts))
                if len(owner) >= CHUNK:
                    yield flush()
        if owner:
            yield flush()

    def evidence(self, docs: list[list[str]]) -> np.ndarray:
        """Of each text: its three highest logits, expected toxic windows (log1p), windows (log), and 1; all windows count."""
        top, toxic, n = np.full((len(docs), 3), -LIMIT), np.zeros(len(docs)), np.zeros(len(docs))
        for owner, logit in self.windows(docs):
            logit = np.clip(logit.astype(float), -LIMIT, LIMIT)
            np.add.at(toxic, owner, _sigmoid(logit))
            np.add.at(n, owner, 1)
            order = np.lexsort((-logit, owner))
            owners, first = np.unique(owner[order], return_index=True)
            rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
            best = np.full((len(docs), 3), -LIMIT)
            high = rank < 3
            best[owner[order][high], rank[high]] = logit[order][high]
            top[owners] = -np.sort(-np.concatenate([top[owners], best[owners]], axis=1), axis=1)[:, :3]
        return np.column_stack([top, np.log1p(toxic), np.log(np.maximum(n, 1)), np.ones(len(docs))])

    def score(self, docs: list[list[str]]) -> np.ndarray:
        return np.where([bool(d) for d in docs], _sigmoid(self.evidence(docs) @ self.weights), self.empty)


def _exclusive(docs: list[list[str]], toxic: np.ndarray) -> np.ndarray:
    """How many more toxic texts have each gram row than would by chance, in standard deviations: rare grams weigh little."""
    seen = np.zeros((2, GRAM_ROWS))
    for words, y in zip(docs, toxic):
        if words:
            rows, _, stems = grams(list(dict.fromkeys(words)))
            seen[int(y), np.unique(np.r_[rows, stems[0]])] += 1
    chance = seen.sum(axis=0) * toxic.mean()
    return (seen[1] - chance) / np.sqrt(chance + 1)


def train(docs: list[list[str]], labels: list[int], seed: int = 11) -> Network:
    """A network from whole texts. Without both labels it scores every text by the share of label 1."""
    rng = np.random.default_rng(seed)
    net, y = Network.fresh(rng), np.array(labels, np.int64)
    pairs = [k for k, words in enumerate(docs) if words]
    if not len(pairs) or len(set(y[pairs].tolist())) < 2:
        for k in ("o", "ob"):
            net.p[k][:] = 0
        net.weights = np.array([0, 0, 0, 0, 0, 20.0 if len(y) and y.all() else -20.0])
        net.empty = float(y.mean()) if len(y) else 0.0
        return net
    odds = _exclusive([docs[k] for k in pairs], y[pairs])
    picked: dict[int, list[int]] = {}
    for k in pairs:
        own = list(dict.fromkeys(docs[k]))
        rows, counts, stems = grams(own)
        level = np.maximum.reduceat(odds[rows], np.cumsum(counts) - counts)
        np.maximum.at(level, stems[1], odds[stems[0]])
        best = dict(zip(own, level.tolist()))
        level = np.array([max(best[w] for w in docs[k][s : s + WINDOW]) for s in starts(len(docs[k]))])
        order = np.argsort(-level, kind="stable")
        if y[k]:
            picked[k] = [int(i) for i in order[:3] if level[i] >= 0.5 * level[order[0]]]
        else:
            picked[k] = [int(order[0]), *map(int, rng.choice(len(level), min(3, len(level)), replace=False))]
    m1, m2 = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        if epoch in (EPOCHS // 2, EPOCHS - 2):  # from here on, also what the network itself scores highest
            for k, i in _highest(net, docs, pairs).items():
                picked[k] = [i, *picked[k][: 2 if y[k] else 4]]
        windows = [(k, i) for k, chosen in picked.items() for i in dict.fromkeys(chosen)]
        n_pos = sum(int(y[k]) for k, _ in windows)
        order = rng.permutation(len(windows))
        total = EPOCHS * -(-len(windows) // BATCH)
        for b in range(0, len(order), BATCH):
            step += 1
            vocab: dict[str, int] = {}
            ids = np.full((len(order[b : b + BATCH]), WINDOW), -1, np.int64)
            for row, j in zip(ids, order[b : b + BATCH]):
                k, i = windows[j]
                part = docs[k][i * STRIDE : i * STRIDE + WINDOW]
                row[: len(part)] = [vocab.setdefault(w, len(vocab)) for w in part]
            grads = net.gradients(list(vocab), ids, np.array([y[windows[j][0]] for j in order[b : b + BATCH]]))
            rate = RATE * max(0.1, 1 - step / total)
            for k, (rows, g) in grads.items():  # of the embeddings only the rows in use
                m1[k][rows] = 0.9 * m1[k][rows] + 0.1 * g
                m2[k][rows] = 0.99 * m2[k][rows] + 0.01 * g * g
                net.p[k][rows] -= (rate * (m1[k][rows] / (1 - 0.9**step)) / (np.sqrt(m2[k][rows] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        if not n_pos:
            break
    net.cache.clear()
    net.weights = _logistic(net.evidence([docs[k] for k in pairs]), y[pairs])
    net.cache.clear()
    net.empty = float(y[[k for k in range(len(docs)) if not docs[k]]].mean()) if len(pairs) < len(docs) else 0.0
    return net


def _highest(net: Network, docs: list[list[str]], shown: list[int]) -> dict[int, int]:
    """The number of the highest window of each of the texts ``shown``."""
    net.cache.clear()
    best, top, seen = {}, np.full(len(shown), -np.inf), np.zeros(len(shown), np.int64)
    for owner, logit in net.windows([docs[k] for k in shown]):
        for k, x in zip(owner.tolist(), logit.tolist()):
            if x > top[k]:
                top[k], best[shown[k]] = x, int(seen[k])
            seen[k] += 1
    net.cache.clear()
    return best


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression with a penalty on all but the constant, by projected gradient steps.

    More toxic windows never count against toxicity, more windows never for it.
    """
    sign = np.array([1, 1, 1, 1, -1, 0])
    scale = np.maximum(x.std(axis=0), 1e-3)
    scale[-1] = 1
    z, w, penalty = x / scale, np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 0
    pace = 4 / (np.square(z).sum(axis=1).max() + ridge / len(y))
    for _ in range(5000):
        w -= pace * (z.T @ (_sigmoid(z @ w) - y) + penalty * w) / len(y)
        w = np.where(w * sign < 0, 0, w)
    return w / scale


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL) -> Network:
    """Trained on about ``rows`` texts of each label (fewer where there are fewer), never on held-out ones.

    The ids of the sample are broadcast, its texts come to the driver. Labels but 0 and 1 and NULL texts are left out; a document with several labels counts as toxic if one says so.
    """
    known = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = stratified(known, "toxic", "doc_id", rows)
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").distinct().collect()
    sample = sorted((r["doc_id"], r["text"], r["toxic"]) for r in sample)
    return train([tokens(s[1]) for s in sample], [s[2] for s in sample])


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from its text alone.

    NULL texts and texts without words get the share of label 1 among such training texts, 0 if there are none.
    Repeated rows stay. A row without doc_id counts as not held out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                scores.append(net.score([tokens(t.as_py()) for t in part.column(1)]))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores.astype(float), pa.float64())], names=["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
