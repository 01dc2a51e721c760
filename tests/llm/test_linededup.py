"""Line dedup: brute force over all runs of lines, recall by lines and words, collisions."""

import random
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq

from fundlake.llm import common
from fundlake.llm import linededup as L


def repeated_lines(docs):
    """For each document the lines that stand in a run of two lines with words or more
    (blank lines between, 32 bytes or more) that an earlier document holds too."""
    owner = {}
    def pairs(text):
        lines = text.split("\n")
        has = [k for k, x in enumerate(lines) if x.split()]
        for a, z in zip(has, has[1:]):
            if len("".join(lines[a:z + 1]).encode()) >= 32:
                yield a, z, "\n".join(lines[a:z + 1])
    for i, text in sorted(docs):
        for _, _, run in pairs(text):
            owner.setdefault(run, i)
    return {i: {k for a, z, run in pairs(text) if owner[run] != i for k in range(a, z + 1)} for i, text in docs}


def words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def planted(rng):
    """Passages by (lines, words) in differing surroundings."""
    docs, want = [], {}
    for n, size in [(2, 8), (2, 20), (3, 12), (4, 40), (5, 25), (8, 16), (6, 60), (12, 120), (4, 400)]:
        for _ in range(40):
            passage = [words(rng, size // n + 1) for _ in range(n)]
            if rng.random() < 0.3:
                passage.insert(1, "")
            for copy in range(rng.choice([2, 2, 3])):
                head, tail = ([words(rng, 7) for _ in range(rng.randrange(5))] for _ in range(2))
                docs.append((len(docs), "\n".join([*head, *passage, *tail])))
                want[docs[-1][0]] = (n, size, range(len(head), len(head) + len(passage)) if copy else range(0))
    return docs, want


def gone(r):
    return {k for s in r.removed for k in range(s.line, s.line + s.lines)}


def test_whole_passages_go_whatever_surrounds_them(spark):
    docs, want = planted(random.Random(4))
    got = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: gone(got[i]) for i in want} == {i: set(w[2]) for i, w in want.items()}, "recall and precision are 1"
    for i, text in docs:
        assert got[i].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone(got[i]))


def test_equals_brute_force_on_runs(spark, sample):
    """Every line of a run that an earlier document holds goes; other lines go only in
    passages of over 50 words or chunks that repeat within their document."""
    docs = [(r.doc_id, r.text or "") for r in sample.collect()]
    want = repeated_lines(docs)
    got = {r.doc_id: r for r in L.dedup_lines(sample).collect()}
    texts = dict(docs)
    assert all(want[i] <= gone(got[i]) for i in want) and sum(map(len, want.values())) > 100
    lines = {}
    for i, text in docs:
        for k, x in enumerate(text.split("\n")):
            lines.setdefault(x, []).append((i, k))
    left = {x for i, r in got.items() for k, x in enumerate(texts[i].split("\n")) if k not in gone(r)}
    assert all(x in left for x in lines), "of every line one copy stays"
    for i, r in got.items():
        for k in gone(r) - want[i]:
            assert len(lines[texts[i].split("\n")[k]]) > 1


def test_cuts_do_not_shift():
    rng = random.Random(1)
    shared = [words(rng, 5) for _ in range(60)]
    def cuts(head):
        data = "\n".join([*head, *shared]).encode()
        starts, ends, first = L.line_spans(L.np.array([0, len(data)]), data)
        lo, _ = L.chunks(first, L.line_digests(starts, ends, data))
        return {int(x) - len(head) for x in lo if x >= len(head)}
    one, two = cuts([]), cuts([words(rng, 5) for _ in range(7)])
    assert len(one & two) > 10 and {x for x in one ^ two if x > 8} == set()


def test_bytes_decide_where_digests_collide(spark, monkeypatch):
    """With a line digest of almost no bits, unequal lines share it and must stay."""
    monkeypatch.setattr(L, "line_digests", lambda starts, ends, data: b"".join(bytes([(e - s) % 251]) * 16 for s, e in zip(starts.tolist(), ends.tolist())))
    a, b = "\n".join(f"first text line {k} of some length" for k in range(4)), "\n".join(f"other text line {k} of some length" for k in range(4))
    c = "one line that is much longer than those above\nand another line of an odd length"
    docs = spark.createDataFrame([(1, a), (2, b), (3, c), (4, c)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got == {1: a, 2: b, 3: c, 4: ""}


def test_rows_of_chunks_are_narrow(sample):
    """The digests of all chunks are shuffled twice: half of a sha256 each."""
    rows = L._rows(sample.selectExpr("doc_id", "xxhash64(text) as th", "coalesce(text, '') as text"))
    assert {len(r.digest) for r in rows.limit(200).collect()} == {16}


def test_texts_in_the_work_folder_are_compressed_well(spark, sample, monkeypatch):
    paths, work_path = {}, common.work_path

    def noted(session, name):
        paths[name] = work_path(session, name)
        return paths[name]
    monkeypatch.setattr(common, "work_path", noted)
    L.dedup_lines(sample)
    files = list(Path(urlparse(paths["line-dedup"]).path).glob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files if pq.ParquetFile(f).metadata.num_rows]
    assert groups and {g.column(c).compression for g in groups for c in range(g.num_columns)} == {"ZSTD"}


def test_texts_of_an_id_may_share_their_hash(spark, monkeypatch):
    """Rows of one id, and of none, whose texts share ``th`` are cut as others are."""
    rng = random.Random(6)
    a, b, c = ("\n".join(words(rng, 9) for _ in range(4)) for _ in range(3))
    docs = [(1, a), (2, f"{a}\nmine {words(rng, 3)}"), (2, f"{b}\n{words(rng, 4)}"), (None, f"{words(rng, 4)}\n{b}"), (None, c), (None, f"{c}\n{a}"), (0, f"{b}\n{a}")]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    seen = []
    rows = L._rows
    monkeypatch.setattr(L, "_rows", lambda d: rows(seen.append(d) or d))
    want = sorted((tuple(r) for r in L.dedup_lines(given).collect()), key=repr)
    assert all(0 <= r.th < 1 << 31 for r in seen[0].collect())
    monkeypatch.setattr(L.F, "hash", lambda *c: L.F.lit(7))
    got = sorted((tuple(r) for r in L.dedup_lines(given).collect()), key=repr)
    assert got == want and sum(r[3] for r in got) >= 5
