"""Groups, links and counts against a plain walk over whole texts encoded by the libraries."""

import collections
import hashlib
import random

import pytest

from mensario.llm import alignment, queries
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD

spm = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
A, B = queries.vocabulary_file(queries.BYTES_50K), queries.vocabulary_file(queries.PIECES_32K)


@pytest.fixture(scope="module")
def sides():
    first = tokenizers.Tokenizer.from_file(A)
    first.encode_special_tokens = True
    letters = alignment.byte_letters()
    of_a = {i: bytes(letters[c] for c in t) for t, i in first.get_vocab().items() if i < 50256}
    second = spm.SentencePieceProcessor(model_file=B)
    of_b = {}
    for i in range(3, second.get_piece_size()):
        piece = second.id_to_piece(i)
        of_b[i] = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()
    return first, of_a, second, of_b


def walked(sides, texts):
    """What each of ``texts`` should give, by walking along both sides token by token."""
    first, of_a, second, of_b = sides
    told, counts = [], collections.Counter()
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(map(of_a.get, a)) != raw or b"".join(map(of_b.get, b)) != raw:
            told.append(([], [], [], []))
            continue
        ends_a, ends_b, at = [], [], 0
        for x in a:
            ends_a.append(at := at + len(of_a[x]))
        at = 0
        for x in b:
            ends_b.append(at := at + len(of_b[x]))
        i = j = 0
        groups, links, mine = [], [], ([a[0]], [b[0]])
        links.append((a[0], b[0]))
        while i < len(a):
            if ends_a[i] == ends_b[j]:
                groups.append(mine)
                i, j = i + 1, j + 1
                if i == len(a):
                    break
                mine = ([a[i]], [b[j]])
            elif ends_a[i] < ends_b[j]:
                i += 1
                mine[0].append(a[i])
            else:
                j += 1
                mine[1].append(b[j])
            links.append((a[i], b[j]))
        counts.update(set(links))
        told.append((a, b, groups, links))
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    written = lambda groups: ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return [(len(a), len(b), len(g), len(k), sum(counts[p] == best[p[0]] for p in k), sum(counts[p] for p in k), written(g)) for a, b, g, k in told]


def rows_of(df):
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)) for r in df.collect()), key=str)


def wanted(sides, rows):
    return sorted(zip([r[0] for r in rows], walked(sides, [r[1] or "" for r in rows])), key=str)


def test_the_query_over_the_whole_table(spark, sides):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    found = queries.op11_alignment(spark, TESTDATA).withColumnRenamed("groups_sha256", "groups")
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest() if text else ""
    assert rows_of(found) == [(i, (*w[:-1], digest(w[-1]))) for i, w in wanted(sides, rows)]
    assert all(t == "bigint" for c, t in found.dtypes if c not in ("doc_id", "groups"))


def test_texts_of_any_characters(docs, sides):
    rng = random.Random(4)
    pools = [list("etaoin  \n"), list(" \t\n\r\x0b\x1c\x85  ab."), ["'s", "'ll", " ", "can", "42", "<|endoftext|>", "</s>", "!?", "\n\n"], [chr(i) for i in range(0x20, 0x3000)], ["漢", "字", "😀", " ", "é"]]
    rows = [(i, "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 60)))) for i in range(600)]
    rows += [(1000 + i, "".join(rng.choice(pools[i % len(pools)]) for _ in range(rng.randrange(1, 80)))) for i in range(600)]
    found = rows_of(alignment.align(docs(rows), A, B))
    assert found == wanted(sides, rows)
    assert sum(w[0] > 0 for _, w in found) > 900


def test_an_identity_linked_inside_an_irregular_group_counts_once_a_document(docs, sides):
    """The same pair of ids, once as a group of its own and once overlapping in part."""
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(["=", "==", "===", " ", "-", "--", "a"]) for _ in range(40))) for i in range(200)]
    assert rows_of(alignment.align(docs(rows), A, B)) == wanted(sides, rows)


def test_odd_rows(docs, odd, sides):
    rows = [*ODD, (7, "a ▁ b"), (8, " "), (9, "x" * 5000), (10, "  two"), (None, None)]
    found = rows_of(alignment.align(docs(rows), A, B))
    assert found == wanted(sides, rows)
    assert dict((i, w) for i, w in found if i in (1, 2, 7)) == {i: (0, 0, 0, 0, 0, 0, "") for i in (1, 2, 7)}
    assert alignment.align(odd.limit(0), A, B).collect() == []


@pytest.mark.parametrize("hot", [1, 10**9])
def test_counts_agree_whether_they_are_broadcast_or_shuffled(docs, sides, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["Überraschung", "naïve", "l'été", "word", "größer", "días"]) for _ in range(12))) for i in range(150)]
    assert rows_of(alignment.align(docs(rows), A, B)) == wanted(sides, rows)


def test_stores_that_are_full_start_anew(docs, sides, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_STRETCHES", 20)
    monkeypatch.setattr(alignment, "BATCH_SYMBOLS", 200)
    rng = random.Random(13)
    rows = [(i, " ".join(str(rng.randrange(300)) for _ in range(20))) for i in range(100)]
    assert rows_of(alignment.align(docs(rows), A, B)) == wanted(sides, rows)


def test_without_white_space_no_piece_may_begin_texts_stay_whole(sides, docs):
    both = alignment.pair(A, B)
    assert set(both.spaces) == {" ", "\n", "\t"}
    both.spaces = ""
    assert both.stretches(" a b") == [" a b"]
