import re

import numpy as np

from mensario.llm import decontam
from mensario.llm.common import table
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = plain(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    result = []
    for doc, text in docs:
        words, hit, found = plain(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        result.append((doc, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(result, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=repr)


def test_equals_brute_force_in_one_block_and_in_many(spark, monkeypatch):
    docs, items = table(spark, TESTDATA, "documents"), table(spark, TESTDATA, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(r[2] for r in want) and found(decontam.matches(docs, items)) == want
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(decontam, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(decontam, "PIECE_WORDS", 15)
    assert len(list(decontam.blocks(items))) > 3
    assert found(decontam.matches(docs, items)) == want


def test_repetitive_texts_short_items_and_odd_rows(spark, docs, rng):
    words = "a b c Ä d1".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 200)))) for i in range(60)] + [(60, "a " * 500), *((i + 100 if i else None, t) for i, t in ODD)]
    items = [(1, "A, b. c"), (2, " ".join(rng.choice(words) for _ in range(12))), (3, None), (4, "...."), (None, "d1 d1 d1 d1"), (5, "a " * 300), (6, "a " * 10), (2, "Ä"), (7, "never seen here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows)
    assert found(decontam.matches(df, bench)) == brute(rows, items)
    kept = decontam.clean(df, bench)
    clean = [r[0] for r in brute(rows, items) if not r[2]]
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)
    assert all(r[2] == 0 for r in found(decontam.matches(df, bench.limit(0))))
    assert decontam.matches(docs([]), bench).collect() == []


def test_spans_are_the_longest_matches(spark, docs):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    text = "x y " + " ".join(f"w{i}" for i in range(5, 25)) + " z " + " ".join(f"w{i}" for i in range(9)) + " q " + " ".join(f"w{i}" for i in range(20, 30))
    assert [tuple(s) for s in decontam.matches(docs([(1, text)]), bench).first().spans] == [(2, 22), (33, 43)]


def test_suffix_array_is_sorted(rng):
    ids = np.array([rng.randint(0, 3) for _ in range(2000)] + [0] * 13)
    order = decontam.suffix_array(ids, 1)
    keys = [tuple(ids[i : i + decontam.WINDOW]) for i in order]
    assert keys == sorted(keys) and len(order) == (ids > 0).sum()
