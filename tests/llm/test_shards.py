import zlib

import pytest

from mensario.llm import shards
from mensario.llm.queries import op10_shards
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD


def check(found, rows, n=8):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in found) == sorted(((i or -1), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(n):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {(r.law, r.grown_shard) for r in found} <= {("bytes", None)} and all(0 <= r.shard < n for r in found)


def test_query_is_balanced_and_keeps_small_groups_together(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    found = op10_shards(spark, TESTDATA).collect()
    check(found, rows)
    total = sum(r.size for r in found)
    sums = [sum(r.size for r in found if r.shard == s) for s in range(8)]
    assert max(abs(x - total / 8) for x in sums) <= max(r.size for r in found) + 0.01 * total / 8


@pytest.mark.parametrize("cell", [2, 256])
def test_a_group_of_a_third_of_all_rows_is_cut(docs, monkeypatch, cell):
    monkeypatch.setattr(shards, "CELL_ROWS", cell)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}" + "x" * (i % 50)) for i in range(900)]
    found = shards.assign(docs(rows)).collect()
    check(found, rows)
    sums = [sum(r.size for r in found if r.shard == s) for s in range(8)]
    assert max(sums) - min(sums) <= 150


def test_odd_rows(docs, odd):
    check(shards.assign(odd).collect(), ODD)
    assert shards.assign(docs([])).collect() == []
    one = shards.assign(docs([(1, "x")])).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]
