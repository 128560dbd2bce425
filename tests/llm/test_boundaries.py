"""Boundary sets and the fill-in-middle transformation."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardpanel.llm import boundaries as B
from hazardpanel.llm.queries import QUERIES
from tests.conftest import SF_SMALL

TOKENS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    """The transformation by list slices, from its definition."""
    text = text or ""
    units = TOKENS.findall(text)
    if doc_id is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.text(alphabet=st.sampled_from("abZ é\n<SPM>😀"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_token_ends(text):
    assert B.token_ends(text).tolist() == [m.end() for m in TOKENS.finditer(text)]


SETS = {
    "empty": [],
    "array": range(0, 500_000, 997),
    "bitmap": [i for i in range(196_608) if i % 3 != 1],
    "runs": [*range(10, 70_000), *range(80_000, 140_000)],
    "mixed": [*range(5), *range(65_530, 65_540), *range(131_072, 196_608, 2), 10_000_000],
    "full": range(2 * 65_536),
}


@pytest.mark.parametrize("name", SETS)
def test_select_in_every_container(name):
    members = np.array(list(SETS[name]), np.int64)
    for s in (B.Boundaries.of(members), B.Boundaries.from_bytes(B.Boundaries.of(members).to_bytes())):
        assert len(s) == len(members) and s.offsets().tolist() == members.tolist()
        for k in {0, 1, len(members) // 3, len(members) // 2, len(members) - 1} & set(range(len(members))):
            assert s.select(k) == members[k]
        with pytest.raises(IndexError):
            s.select(len(members))


def test_the_kinds_of_containers():
    kinds = {name: {c.kind for c in B.Boundaries.of(np.array(list(m), np.int64)).containers} for name, m in SETS.items()}
    assert kinds["array"] == {B.ARRAY} and kinds["bitmap"] == {B.BITMAP} and kinds["full"] == {B.RUNS}
    assert kinds["mixed"] == {B.ARRAY, B.RUNS, B.BITMAP}


def test_against_list_slices(spark):
    long = "word, 😀 " * 40_000
    rows = [(i, t) for i, t in enumerate([None, "", "a", "é", "one two  three", "<P>", "x<S>y", "ends <M>", "<", "P>S><", "tab\tnew\nline", long, "ab" * 100_000,
                                          *["A b, c d. 12 <x" * k for k in range(1, 60)]])] + [(7, "x<S>y"), (3, "é"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "mine", "n") for i, t in rows], "doc_id long, text string, id string, form string")
    got = B.restore(B.transform(docs)).collect()
    assert sorted([(r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=str) == sorted([(i, *plain(i, t)) for i, t in rows], key=str)
    texts = {(i, t or "") for i, t in rows}
    assert all((r.id, r.restored) in texts for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}


def test_boundary_sets(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (2, None)], "doc_id long, text string")
    got = {r.id: (r.n, B.Boundaries.from_bytes(r.ends).offsets().tolist()) for r in B.boundary_sets(docs).collect()}
    assert got == {1: (3, [2, 3, 5]), 2: (0, [])}


def test_query_on_every_document(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(d.doc_id, n, form, p, m, sha(out), sha(d.text or "")) for d in docs for n, form, p, m, out in [plain(d.doc_id, d.text)]]
    got = QUERIES["op12_fill_in_middle"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.restore(B.transform(empty)).count() == 0 and B.boundary_sets(empty).count() == 0
