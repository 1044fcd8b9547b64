import hashlib
import re

import pytest

from mensario.llm import secrets
from mensario.llm.common import table
from mensario.llm.queries import op2_secrets

from tests.llm.conftest import ODD


#: The smallest tables hold hardly any secret.
MORE = "/root/testdata/sf0.01"


def plain(text):
    """The base patterns as the contract gives them, without shortcuts."""
    found = []
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, least, group in (("assign", assign, 6, 2), ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0)):
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(found, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


def test_query_keeps_exactly_the_base_spans(spark):
    texts = {r.doc_id: r.text for r in table(spark, MORE, "documents").collect()}
    n = 0
    for row in op2_secrets(spark, MORE).collect():
        base = plain(texts.pop(row.doc_id))
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
        assert set(joined.split(",")) <= set(row.spans.split(",")) | {""}
        n += len(base)
    assert not texts and n > 0


TRICKY = [
    'x = 1; Password: "hunter2hunter2" api_key=abc APIKEY="abcdef" toKen=token=abcdef ſecret=abcdefg',
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "a " + "deadbeef" * 3 + "g" + "f" * 23 + " ÄAKIA" + "0" * 20,
    "secret" * 4 + "=" + "0" * 30 + "\nPASSWD :x passwd= 'y" + "z" * 9,
]


def test_base_spans_on_tricky_texts():
    for text in TRICKY:
        assert [s[:3] for s in secrets.base_spans(text)] == plain(text)


def test_inference_merges_states_and_tells_formats_apart(rng):
    def credential():
        return "ghp_" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))

    known = [credential() for _ in range(300)]
    words = ["_".join(rng.choice(["the", "run", "of", "a", "house", "file2", "name"]) for _ in range(8)) for _ in range(300)]
    automaton = secrets.infer(known)
    assert len(automaton.visits) < 100 and automaton.visits[0] >= 300
    formats = secrets.fit({"assign": known}, words)
    fresh, text = credential(), "see the_file_of_a_house_name2_run and "
    assert secrets.find(text + fresh + " end", formats) == [(len(text), len(text) + len(fresh), "grammar")]
    assert sum(formats.odds(credential()) > formats.margin for _ in range(100)) > 75
    assert secrets.fit({}, []).margin == float("inf")


def test_odd_rows(spark, odd, docs):
    formats = secrets.learn(odd)
    found = secrets.scan(odd, formats).collect()
    assert len(found) == len(ODD) and all(r.spans == [] for r in found)
    assert secrets.scan(docs([]), secrets.learn(docs([]))).collect() == []


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.mark.parametrize("n_plain", [150, 3000])
@pytest.mark.parametrize("n_bare", [3, 300])
def test_unlabelled_credentials_are_found_in_small_and_large_tables(docs, rng, n_plain, n_bare):
    def credential():
        return "ghp_" + "".join(rng.choice(ALNUM) for _ in range(32))

    def words(n):
        return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))

    rows = [(i, words(60) + f" page {i % 90}") for i in range(n_plain)]
    rows += [(10_000 + i, f"{words(20)} token = {credential()} {words(5)}") for i in range(60)]
    bare = {20_000 + i: credential() for i in range(n_bare)}
    rows += [(k, f"{words(20)} {v} {words(20)}") for k, v in bare.items()]
    rows += [(30_000, "see 2024/05/12/the-house-of-a-friend.html and mail8.example.com/index2.html")]
    table = docs(rows)
    texts = dict(r[:2] for r in rows)
    found = {(r.doc_id, texts[r.doc_id][s.start : s.end]) for r in secrets.scan(table, secrets.learn(table)).collect() for s in r.spans if s.kind == "grammar"}
    assert found <= set(bare.items())
    assert len(found) >= 0.95 * n_bare


def test_candidates_are_as_short_as_labelled_credentials(rng):
    def credential(n):
        return "".join(rng.choice(ALNUM) for _ in range(n))

    words = ["_".join(rng.choice(["the", "run", "of", "a", "house", "file2", "name"]) for _ in range(8)) for _ in range(300)]
    formats = secrets.fit({"assign": [credential(12) for _ in range(300)]}, words)
    assert formats.shortest == 12
    fresh = "k7Rq2Xz9PbL4"
    assert secrets.find(f"see {fresh} and file2_house of", formats) == [(4, 16, "grammar")]
