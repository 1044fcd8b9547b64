import random

from pyspark.sql import functions as F

from mensario.llm import mixing
from mensario.llm.queries import op9_mixing
from tests.llm.conftest import ODD


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def test_targets_equal_the_repeated_resharing(spark, rng):
    for n in (1, 2, 7, 40):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 10**6]) for i in range(n)} | {None: 5, "É": 70, "z": 1}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.targets(df).collect()}
        want = brute_targets(sizes)
        assert found.keys() == want.keys() and all(abs(found[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    sf = "/root/testdata/sf0.01"
    rows = op9_mixing(spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op9_mixing(spark, sf).collect()))
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for s in set(source.values()):
        own = [r for r in rows if source[r.doc_id] == s]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)


def test_positions_invert_the_demand():
    rng = random.Random(1)
    for _ in range(50):
        tilt, t = rng.choice([-0.5, 0.0, 0.5, 1.0]), rng.random()
        demand = t + tilt * (t * t - t)
        found = demand if tilt == 0 else (((1 - tilt) ** 2 + 4 * tilt * demand) ** 0.5 - (1 - tilt)) / (2 * tilt)
        assert abs(found - t) < 1e-9


def test_words_and_odd_rows(spark, docs, odd):
    texts = [None, "", " ", "a", " a  b\t\nc\r", "a\xa0b c", "x" * 1000, "\x0b\x0ca"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.words().alias("n"))
    assert [r.n for r in df.collect()] == [0, 0, 0, 1, 3, 2, 1, 1]
    planned = mixing.plan(odd).collect()
    assert sum(r.rows for r in planned) == len(ODD) and all(r.copies == 0 for r in planned if r.size == 0)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixing.plan(docs([])).collect() == [] and mixing.mix(docs([])).collect() == []


def test_the_mix_holds_each_row_as_often_as_planned(docs, rng):
    df = docs([(i, "w " * rng.randint(0, 30), "en", rng.choice(["a", "b", None])) for i in range(200)] + [(7, "twice here", "en", "a")] * 2)
    times = {(r.doc_id, r.source, r.size): r.copies * r.rows for r in mixing.plan(df).collect()}
    mixed = mixing.mix(df).groupBy("doc_id", "source", mixing.words().alias("size")).agg(F.count("*").alias("n")).collect()
    assert {(r.doc_id, r.source, r.size): r.n for r in mixed} == {k: n for k, n in times.items() if n}
