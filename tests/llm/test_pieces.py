"""Fill-in-the-middle: a brute-force version, the piece table, edge rows."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fundlake.llm.pieces import ARRANGED, PieceTable, arranged, fill_in_middle, parsed, restore


def plainly(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(docs):
    made = fill_in_middle(docs, docs.columns).collect()
    assert len(made) == docs.count()
    for r in made:
        want = plainly(r.row.doc_id, r.row.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want and r.output_sha256 == sha(want[4])
        text = (r.row.text or "").encode()
        parts = [(text, b"<P><S><M>")[p.buffer][p.start:p.start + p.length] for p in r.pieces]
        assert b"".join(parts).decode() == r.output, "the descriptors give the example"
    return made


def test_equals_brute_force(edge, empty, sample):
    check(sample)
    made = check(edge)
    assert made[0].row.asDict().keys() == set(edge.columns)
    assert check(empty) == []


def test_restores_texts(edge, sample):
    for docs in (edge, sample):
        made = fill_in_middle(docs, ["text"]).selectExpr("row.text", "form", "output")
        for r in restore(made, ["text"]).collect():
            assert r.restored == (r.row.text or "") and r.restored_sha256 == sha(r.restored)


def test_sentinels_marks_and_long_text(spark):
    texts = ["a <P> b", "tail <M>", "<S", "<<P<S<M<", "é" * 50_000 + "z" * 50_000, "A1\n\n\x00B", "\U0001f600x" * 30, "", None]
    docs = spark.createDataFrame([(k * 10 + j, t) for k, t in enumerate(texts) for j in range(10)], "doc_id long, text string")
    made = check(docs)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert all(r.form == "plain" for r in made if r.row.doc_id < 20)


def test_an_example_without_its_sentinel_raises(spark):
    broken = spark.createDataFrame([("<P>a<S>b", "psm")], "output string, form string")
    with pytest.raises(Exception, match="subsection not found"):
        restore(broken, ["form"]).collect()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<PSM>aé", max_size=30), st.integers(0, 60), st.integers(0, 60), st.sampled_from(sorted(ARRANGED)))
def test_piece_table_inverts(text, a, b, form):
    data = text.encode()
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    low, high = sorted((min(a, len(data)), min(b, len(data))))
    table = arranged(data, low, high, form)
    out = table.content()
    assert parsed(out, form).content() == data and table.sha256() == hashlib.sha256(out).hexdigest()
    table.invert(ARRANGED[form])
    assert table.content() == data


def test_cut_beyond_the_end_raises():
    with pytest.raises(ValueError):
        PieceTable(b"abc").cut(4)
