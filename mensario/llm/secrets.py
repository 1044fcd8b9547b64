"""Secret scans: patterns, and formats learnt by grammar inference.

Three patterns find labelled credentials. From a bounded sample of them one prefix tree per kind is
built over character classes; states whose outcomes are statistically compatible are merged (by the
Hoeffding bound), which gives a probabilistic automaton per kind. Every run of credential characters that no
pattern covers is scored: it is a secret if some automaton makes it likelier, per character, than
the automaton of ordinary runs does, by more than a margin set on the samples. Ordinary runs are words
in a row, from which all runs that look like a credential are left out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut

#: Documents learnt from, at most about so many, and credentials of each kind.
LEARN_DOCS, PER_KIND = 20_000, 1000
#: Confidence of the compatibility test; states with fewer visits than LEAST are not told apart.
ALPHA, LEAST = 0.05, 10
#: Characters of a candidate: the shortest credential that the access pattern takes, or that of the shortest labelled one;
#: the assign pattern takes ``LEAST_ASSIGNED``.
SHORTEST, LEAST_ASSIGNED = 20, 6
#: Share of the ordinary runs that the margin lies above.
ORDINARY = 0.99

# The patterns of the base kinds, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "grammar")

#: Runs that can pass: a hex run is only looked at from its first 24 characters on, as shorter ones fail.
_HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST_ASSIGNED)


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the credential itself) in code points."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), "hex", m.start()) for m in _HEX_LONG.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, spans: list[tuple[int, int, str, int]], shortest: int = SHORTEST) -> Iterator[tuple[int, int]]:
    """Runs of credential characters with a digit and a letter that touch no base span."""
    taken = iter(sorted((s[0], s[1]) for s in spans))
    now = next(taken, None)
    reach = 0
    for m in _RUN.finditer(text):
        if m.end() - m.start() < shortest:
            continue
        while now and now[0] < m.end():
            reach = max(reach, now[1])
            now = next(taken, None)
        run = m[0]
        if m.start() >= reach and any(map(str.isdigit, run)) and any(map(str.isalpha, run)):
            yield m.start(), m.end()


def ordinary(text: str, spans: list[tuple[int, int, str, int]]) -> str:
    """The first words of a text as one run, joined by signs; without base spans and without any run that could be a credential."""
    kept, at = [], 0
    for start, end in sorted([*((s[0], s[1]) for s in spans), *candidates(text, spans, LEAST_ASSIGNED)]):
        if start > at:
            kept.append(text[at:start])
        at = max(at, end)
    words = re.findall(r"[A-Za-z0-9]+", " ".join([*kept, text[at:]]))[:40]
    return "".join(w + "_-./"[zlib.crc32(w.encode()) % 4] for w in words)[:60].rstrip("_-./") or "_"


#: Classes of characters: hex letters, other letters, digits; signs stand for themselves.
_CLASS = str.maketrans({c: k for k, chars in {"a": "abcdef", "g": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "G": "GHIJKLMNOPQRSTUVWXYZ", "0": "0123456789"}.items() for c in chars})
_SYMBOLS = 12  # 5 classes, 6 signs, and the end


def symbols(value: str) -> str:
    return value.translate(_CLASS) + "$"


@dataclass
class Automaton:
    """``moves[state][symbol]`` = (visits, next state); ``visits[state]``."""

    moves: list[dict[str, tuple[int, int]]]
    visits: list[int]

    def likelihood(self, value: str) -> float:
        """Mean log probability per symbol; unseen moves get a smoothed share and lead back to the start."""
        state, total, word = 0, 0.0, symbols(value)
        for s in word:
            seen, to = self.moves[state].get(s, (0, 0))
            total += math.log((seen + 0.5) / (self.visits[state] + 0.5 * _SYMBOLS))
            state = to
        return total / len(word)


def infer(values: Iterable[str]) -> Automaton:
    """Merge compatible states of the prefix tree of ``values``, nearest to the root first."""
    child: list[dict[str, int]] = [{}]
    count: list[dict[str, int]] = [{}]
    for value in values:
        node = 0
        for s in symbols(value):
            count[node][s] = count[node].get(s, 0) + 1
            if s not in child[node]:
                child[node][s] = len(child)
                child.append({})
                count.append({})
            node = child[node][s]
    bound = math.sqrt(0.5 * math.log(2 / ALPHA))

    def same(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            n, m = sum(count[x].values()), sum(count[y].values())
            if n < LEAST or m < LEAST:
                continue
            gap = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for s in count[x].keys() | count[y].keys():
                if abs(count[x].get(s, 0) / n - count[y].get(s, 0) / m) > gap:
                    return False
                if s in child[x] and s in child[y]:
                    todo.append((child[x][s], child[y][s]))
        return True

    def fold(into: int, node: int) -> None:
        todo = [(into, node)]
        while todo:
            x, y = todo.pop()
            for s, n in count[y].items():
                count[x][s] = count[x].get(s, 0) + n
            for s, z in child[y].items():
                if s in child[x]:
                    todo.append((child[x][s], z))
                else:
                    child[x][s] = z

    red, seen = [0], {0}
    while True:
        blue = next(((r, s, child[r][s]) for r in red for s in sorted(child[r]) if child[r][s] not in seen), None)
        if blue is None:
            break
        parent, s, node = blue
        like = next((r for r in red if same(r, node)), None)
        if like is None:
            red.append(node)
            seen.add(node)
        else:
            child[parent][s] = like
            fold(like, node)
    number = {r: k for k, r in enumerate(red)}
    moves = [{s: (count[r][s], number[child[r][s]]) for s in child[r]} for r in red]
    return Automaton(moves, [sum(count[r].values()) for r in red])


@dataclass
class Formats:
    secret: list[Automaton]
    plain: Automaton
    margin: float
    #: (characters, margin) of candidates shorter than ``SHORTEST``, longest first, down to the shortest labelled credential.
    short: list[tuple[int, float]] = field(default_factory=list)

    @property
    def shortest(self) -> int:
        return self.short[-1][0] if self.short else SHORTEST

    def odds(self, value: str) -> float:
        return max((a.likelihood(value) for a in self.secret), default=-math.inf) - self.plain.likelihood(value)

    def secret_like(self, value: str) -> bool:
        margin = self.margin if len(value) >= SHORTEST else next((m for n, m in self.short if len(value) >= n), math.inf)
        return self.odds(value) > margin


def fit(labelled: dict[str, list[str]], plain: list[str]) -> Formats:
    """Automata of each kind with values, and the margin: halfway from the odds that ``ORDINARY`` of the ordinary runs stay
    below to those that 99 in 100 labelled credentials exceed, or the former where the two overlap. The margin is set on
    ordinary runs that the automaton has not learnt. Short runs scatter more: their margins come from ordinary runs as short."""
    automata = [infer(v) for k, v in sorted(labelled.items()) if v]
    formats = Formats(automata, infer(plain[::2]), math.inf)
    values = [v for found in labelled.values() for v in found]
    held_out = plain[1::2] or plain

    def margin(length: int | None, known: list[str]) -> float:
        high = sorted([0.1, *(formats.odds(v[:length]) for v in held_out)])
        low = sorted(formats.odds(v) for v in known)
        high_end = max(0.1, high[min(len(high) - 1, int(len(high) * ORDINARY))])
        return max(high_end, (high_end + low[len(low) // 100]) / 2)

    if values:
        formats.margin = margin(None, [v for v in values if len(v) >= SHORTEST] or values)
        shortest = min(map(len, values))
        for n in sorted({n for n in (14, 10, 8) if n > shortest} | ({shortest} if shortest < SHORTEST else set()), reverse=True):
            formats.short.append((n, margin(n, [v for v in values if n <= len(v) < SHORTEST] or values)))
    return formats


def learn(docs: DataFrame) -> Formats:
    """From about ``LEARN_DOCS`` documents, chosen by a hash of their text, and ``PER_KIND`` values of each kind."""
    total = docs.count()
    share = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, found = [], []
            for t in batch.column(0):
                text = t.as_py()
                spans = base_spans(text)
                for _, end, kind, at in spans:
                    kinds.append(kind)
                    found.append(text[at:end])
                kinds.append("plain")
                found.append(ordinary(text, spans))
            yield pa.RecordBatch.from_pydict({"kind": kinds, "value": found}, pa.schema([("kind", pa.string()), ("value", pa.string())]))

    sample = cut(docs.where(F.col("text").isNotNull() & (share < F.lit(LEARN_DOCS / max(1, total)))).select("text").mapInArrow(values, "kind string, value string").distinct())
    picked = {k: [r["value"] for r in sample.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(PER_KIND).collect()] for k in (*KINDS[:3], "plain")}
    return fit({k: picked[k] for k in KINDS[:3]}, picked["plain"])


def find(text: str | None, formats: Formats) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind; those of the patterns stay as they are."""
    if not text:
        return []
    base = base_spans(text)
    added = [(a, b, "grammar", a) for a, b in candidates(text, base, formats.shortest) if formats.secret_like(text[a:b])]
    return [s[:3] for s in sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))]


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``; spans: array of (start, end, kind), in code points, end exclusive.

    NULL and empty texts have no spans. Repeated rows stay.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"start": a, "end": b, "kind": k} for a, b, k in find(t.as_py(), formats)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<start: int, end: int, kind: string>>")
