import re

import xxhash

from mensario.llm import simhash
from mensario.llm.common import cut, table
from mensario.llm.components import components
from mensario.llm.queries import op1_simhash
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD, classes_of


def plain(text):
    """The contract word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    return classes_of(len(prints), pairs)


def test_query_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, TESTDATA, "documents").select("doc_id", "text").collect())
    prints = [plain(text) for _, text in docs]
    want = [(docs[i][0], f"{prints[i]:016x}", docs[k][0]) for i, k in enumerate(brute(prints))]
    assert sorted(map(tuple, op1_simhash(spark, TESTDATA).collect())) == want


def test_dense_groups_lose_no_link(spark, rng, monkeypatch):
    """Small buckets: everything is split several times, and classes stay those of all pairs."""
    monkeypatch.setattr(simhash, "BUCKET", 12)
    prints = set()
    for _ in range(2):
        base = rng.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)}
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(100)})
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    distinct = cut(spark.createDataFrame(rows, "fp long, rep long"))
    found = dict(map(tuple, components(simhash.near_pairs(distinct)).collect()))
    assert [found.get(i, i) for i in range(len(prints))] == brute(prints)


def test_thresholds_add_up():
    cost, chosen = simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 4, 50], [0, 2, 60]], -1)
    assert sum(chosen) == -1 and cost == min(
        sum([[0, 5, 9], [0, 1, 2], [0, 4, 50], [0, 2, 60]][i][t + 1] for i, t in enumerate((a, b, c, d)))
        for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for d in (-1, 0, 1) if a + b + c + d == -1
    )


def test_odd_rows(spark, odd, docs):
    found = simhash.classes(odd).collect()
    assert len(found) == len(ODD)
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1), (None, None), (4, 4), (5, 5), (6, 6)}
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6]
    assert simhash.classes(docs([])).collect() == []


def test_long_paths_and_stars_are_one_component(spark):
    path = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100)}


def test_a_shared_doc_id_loses_no_text(docs):
    one, two = ("the mill by the river turns all day and night", "quite different matters were said about ships at sea")
    kept = simhash.deduplicate(docs([(1, one), (1, two), (1, one), (2, two), (3, one)]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, one), (1, two)])


def test_one_row_of_a_class_stays_whatever_the_ids_and_column_names(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text), (2, text), (None, text), (None, "of no document " + text[:80]), (None, "of no document " + text[:80]), (7, "other words " * 9), (7, text), (8, None), (None, "")]
    names = ["row", "n", "id", "last", "hash", "fp", "rep", "class", "first", "_text_hash", "_kept", "_kept_hash", "node", "component"]
    table = spark.createDataFrame([(*r, *range(len(names))) for r in rows], ["doc_id", "text", *names])
    found = simhash.deduplicate(table)
    assert found.columns == table.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert kept == sorted([(2, text), (None, "of no document " + text[:80]), (7, "other words " * 9), (8, None)], key=str)
    assert simhash.deduplicate(table.limit(0)).collect() == []
