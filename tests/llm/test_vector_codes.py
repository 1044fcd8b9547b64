"""Codes against a plain version: every part to every entry."""

import hashlib

import numpy as np
import pytest

from mensario.llm import queries, vector_codes
from tests.conftest import TESTDATA
from verification.compare import difference, duckdb_on

SCHEMA = "vec_id long, embedding array<double>, label int, whole int, far string, code string, error long, _n int, _label int"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "y", 1, 2, 3) for r in rows], SCHEMA)


def plain(rows):
    """{vec_id: [(code, error, label_error)]} and the codebooks, one part and entry after another."""
    kept = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 16
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:64]] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(part(v, p), e), k) for k, e in enumerate(books[p])) for p in range(16)] for _, v, _ in kept]
    for _ in range(2):
        found = assign()
        for p in range(16):
            for k in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    errors, out = {}, []
    for (i, _, label), f in zip(kept, assign()):
        errors[label] = errors.get(label, 0) + sum(d for d, _ in f)
        out.append((i, bytes(k for _, k in f), sum(d for d, _ in f), label))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, errors[label]) for i, c, e, label in out), key=str), text


def got(df):
    rows = df.collect()
    return sorted(((r.vec_id, bytes(r.code), r.error, r.label_error) for r in rows), key=str), rows[0].codebooks


def test_drawn_vectors_with_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.integers(-3, 4, 32) / 256 * rng.choice([1, 50])).tolist(), int(rng.integers(3)) if i % 4 else None) for i in rng.permutation(300)]
    rows += rows[:20] + [(5, rows[7][1], 1), (None, rows[3][1], 2), (None, rows[9][1], None)]
    assert got(vector_codes.compress(table_of(spark, rows))) == plain(rows)


def test_odd_vectors_are_dropped(spark):
    good = [(i, [i / 100 + j / 7 for j in range(16)], i % 2) for i in range(10)]
    bad = [(20, None, 1), (21, [None] * 16, 1), (22, [float("nan")] * 16, 1), (23, [float("inf")] * 16, 0), (24, [0.0] * 15 + [None], 0), (25, [1e300] * 16, 0), (26, [0.5] * 8, 0), (27, [], 0)]
    assert got(vector_codes.compress(table_of(spark, good + bad))) == plain(good)
    assert vector_codes.compress(table_of(spark, bad[:5])).collect() == []
    assert vector_codes.compress(table_of(spark, good).limit(0)).collect() == []
    with pytest.raises(ValueError, match="16 equal parts"):
        vector_codes.compress(table_of(spark, [(1, [0.5] * 20, 0)]))


def test_bounds_rule_out_most_entries_and_never_the_nearest():
    rng = np.random.default_rng(3)
    entries = rng.integers(-256, 256, (64, 4))
    part = np.r_[rng.integers(-256, 256, (4000, 4)), entries, entries[::-1]]
    pivots = vector_codes._spread(entries, vector_codes.PIVOTS)
    far = np.sqrt(vector_codes.squared(part, pivots).astype(float))
    code, exact, computed = vector_codes.nearest(part, far, entries, pivots)
    every = vector_codes.squared(part, entries)
    assert (code == every.argmin(axis=1)).all() and (exact == every.min(axis=1)).all()
    assert computed < 0.2 * every.size


def test_large_components_are_exact():
    rng = np.random.default_rng(4)
    most = vector_codes.LARGEST
    entries = rng.integers(-most, most + 1, (64, 8))
    part = np.r_[entries + rng.integers(-1, 2, entries.shape), rng.integers(-most, most + 1, (500, 8))]
    pivots = vector_codes._spread(entries, 3)
    far = np.sqrt(vector_codes.squared(part, pivots).astype(float))
    code, exact, _ = vector_codes.nearest(part, far, entries, pivots)
    every = vector_codes.squared(part, entries)
    assert (code == every.argmin(axis=1)).all() and (exact == every.min(axis=1)).all()


def test_many_labels_are_shuffled_and_few_broadcast_to_the_same_sums(spark, monkeypatch):
    rows = [(i, [(i * j % 13) / 8 for j in range(16)], i % 40 if i % 3 else 7) for i in range(200)]
    rows += [(300 + i, [i / 9] * 16, None) for i in range(5)]
    want = plain(rows)
    for share in (0.0, 0.1, 1.0):
        monkeypatch.setattr(vector_codes, "HOT_SHARE", share)
        assert got(vector_codes.compress(table_of(spark, rows))) == want


def test_the_query_over_the_whole_table(spark):
    found = queries.op13_vector_codes(spark, TESTDATA)
    assert difference(found, queries.ORACLE_SQL["op13_vector_codes"], duckdb_on(TESTDATA)) is None
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()]
    want, books = plain(rows)
    assert sorted((r.vec_id, bytes.fromhex(r.code), r.error, r.label_error) for r in found.collect()) == sorted(want)
    assert found.first().codebooks_sha256 == hashlib.sha256(books.encode()).hexdigest()
