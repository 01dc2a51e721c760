"""Operators on texts, against plain versions and on edge cases."""

import hashlib
import os
import re
import types
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

from fundlake.llm import decontaminate as D
from fundlake.llm import linededup as L
from fundlake.llm import simhash as S
from fundlake.llm import tokens as K

LOWER = {c: c + 32 for c in range(65, 91)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- SimHash ----

def fingerprint(text):
    w = spaced((text or "").translate(LOWER))
    sh = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in sh], np.uint64)
    return sum(1 << b for b in range(64) if sh and 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(sh))


def plain_components(data, distance=3):
    f = np.array([fingerprint(t) for _, t in data], np.uint64)
    root = list(range(len(f)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[k]) <= distance):
            a, b = find(k), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, format(int(f[k]), "016x"), least.get(find(k))) for k, (i, _) in enumerate(data)), key=repr)


def test_simhash_against_all_pairs(sample, edge, monkeypatch):
    for docs in (sample, edge):
        data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert rows(S.simhash_groups(docs), "doc_id", "fingerprint", "component_id") == plain_components(data)


def test_gray_index_finds_all_links_in_dense_groups():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 60, 2)).astype(np.uint64)
    fps = np.unique(seeds[:, None] ^ flips[..., 0] ^ flips[..., 1])
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    fps = fps[np.argsort(rank)]
    got = {(int(a), int(b)) for q, t in S.GrayIndex(fps).search(fps, 3) for a, b in zip(q, t)}
    assert got == {(a, int(b)) for a in range(len(fps)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 3)}


def test_many_groups_give_the_same_components(sample, monkeypatch):
    monkeypatch.setattr(S, "GROUP_FINGERPRINTS", 16)
    data = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    assert rows(S.simhash_groups(sample), "doc_id", "fingerprint", "component_id") == plain_components(data)


def test_links_over_groups_equal_all_pairs(spark, monkeypatch):
    """Near fingerprints by random flips, and many that share a whole key of one
    order, so that it lies over several groups and partitions."""
    monkeypatch.setattr(S, "GROUP_FINGERPRINTS", 16)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (60, 4, 3)).astype(np.uint64)
    near = (seeds[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)).ravel()
    one_key = (np.uint64(0xABCD) << np.uint64(32)) | (rng.integers(0, 1 << 64, 150, dtype=np.uint64) & np.uint64(0xFFFF00000000000F))
    fps = np.unique(np.concatenate([seeds, near, one_key]))
    for distance in (0, 3, 6):
        linked = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance)
        wanted = S._roots(len(fps), linked[:, 0], linked[:, 1], np.arange(len(fps)))
        given = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(5)
        got = [(r.u, r.v) for r in S.links(given, distance).collect()]
        assert all(u > v for u, v in got)
        place = {int(f): k for k, f in enumerate(fps.view(np.int64))}
        a, b = (np.array([place[x[k]] for x in got], np.int64) for k in (0, 1))
        assert np.array_equal(S._roots(len(fps), a, b, np.arange(len(fps))), wanted)


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, k) for k in range(1, 60)] + [(k, k + 1) for k in range(100, 160)]
    got = dict(rows(S.components(spark.createDataFrame(edges, "u long, v long")), "node", "root"))
    assert got == {**{k: 0 for k in range(1, 60)}, **{k: 100 for k in range(101, 161)}}


def test_keep_one_and_empty(edge, empty):
    left = S.keep_one(edge, S.simhash_groups(edge))
    kept = rows(left, "doc_id")
    assert left.schema == edge.schema and set(rows(left, "key", "taken")) == {("k", 3)}
    assert kept == sorted([(1,), (2,), (5,), (7,), (8,), (None,)], key=repr)
    assert S.simhash_groups(empty).count() == 0


def test_keep_one_of_groups_with_and_without_ids(spark):
    def near(word, change):
        return " ".join([f"{word}{k}" for k in range(400)] + ([change] if change else []))
    docs = spark.createDataFrame([
        (1, near("a", "")), (None, near("a", "x")),                      # near copy of a document with an id
        (None, near("b", "")), (None, near("b", "y")), (None, near("b", "y")),  # a group without ids
        (2, near("c", "")), (2, near("c", "z")),                         # an id with two near texts
        (3, near("d", "")), (3, near("e", "")), (None, near("f", ""))], "doc_id long, text string")
    groups = S.simhash_groups(docs, distance=8)
    assert groups.select("root").distinct().count() == 6
    assert sorted((str(r.doc_id), r.text[0]) for r in S.keep_one(docs, groups).collect()) == \
        [("1", "a"), ("2", "c"), ("3", "d"), ("3", "e"), ("None", "b"), ("None", "f")]


# ---- decontamination ----

def plain_hits(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = alnum(t)
        for k in range(max(0, len(w) - window) + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, ids = alnum(t), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    hit.update(range(k, k + size))
                    ids |= {str(x) for x in wins[tuple(w[k:k + size])] if x is not None}
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def decon(docs, benchmark):
    return rows(D.decontaminate(docs, benchmark, ["doc_id"]).select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"),
                "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontaminate(edge, empty, benchmark, monkeypatch):
    data = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    assert decon(edge, benchmark) == plain_hits(data, items)
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 1)  # several blocks give the same
    monkeypatch.setattr(D, "BLOCK_WORDS", 3)
    monkeypatch.setattr(D, "GROUP_BYTES", 100)  # and several groups
    assert decon(edge, benchmark) == plain_hits(data, items)
    assert decon(empty, benchmark) == []
    assert not any(r[-1] for r in decon(edge, benchmark.where("false")))
    carried = D.decontaminate(edge, benchmark, edge.columns).where("not contaminated").select("row.*")
    assert carried.schema == edge.schema


# ---- line dedup ----

def test_shared_passage_is_removed_once(spark):
    def line(k):
        return f"line number {k} of the shared passage with several words"
    passage = [line(k) for k in range(30)]
    docs = []
    for i in range(12):
        own = [f"own {i} {k} text that no other document has" for k in range(i % 5 + 1)]
        end = [f"end {i} {k} own text again" for k in range(3)]
        docs.append((i, "\n".join([*own, *passage, *end])))
    got = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0].text == docs[0][1] and got[0].removed_chunks == 0
    for i, t in docs[1:]:
        left = got[i].text.split("\n")
        assert sum(x in passage for x in left) <= 10, "most of the passage goes"
        assert [x for x in t.split("\n") if x not in passage] == [x for x in left if x not in passage], "own lines stay"
        gone = {k for s in got[i].removed for k in range(s.line, s.line + s.lines)}
        assert left == [x for k, x in enumerate(t.split("\n")) if k not in gone]


def test_short_passages_of_many_words_go_whole(spark):
    docs, want = [], {}
    for n in range(1, 7):
        for case in range(8):
            passage = [f"passage {n} {case} line {k} " + " ".join(f"w{j}" for j in range(52 // n)) for k in range(n)]
            for copy in range(2):
                i = len(docs)
                own = [[f"own {side} {i} {k} of no other text" for k in range((case + copy * side) % 4)] for side in (1, 2)]
                docs.append((i, "\n".join([*own[0], *passage, *own[1]])))
                want[i] = docs[-1][1] if not copy else "\n".join([*own[0], *own[1]])
    loop = "\n".join(["the same ten words stand in this line over again"] * 40)
    docs.append((len(docs), loop))
    got = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: got[i] for i in want} == want
    assert 50 < len(spaced(got[len(docs) - 1])) < 80, "what repeats itself stays once"


def test_line_dedup_edges(edge, empty):
    got = L.dedup_lines(edge)
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert got.count() == edge.count() and (3, "") in texts and (2, "") in texts
    assert any(i == 1 and t.startswith("Alpha") for i, t in texts)
    assert L.dedup_lines(empty).count() == 0


# ---- tokens ----

def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 8, 11, 16, 17, 31):
        for n in (1, 7, 8, 1000):
            ids = rng.integers(0, 1 << bits, n, dtype=np.uint32)
            raw = K.pack(ids, bits)
            assert len(raw) == -(-n * bits // 8) and np.array_equal(K.unpack(raw, n, bits), ids)


def test_wide_ids_are_refused():
    for bits, wide in ((8, 256), (11, 1 << 11), (16, 70_000)):
        with pytest.raises(ValueError, match=str(wide)):
            K.pack(np.array([1, wide], np.uint32), bits)


def test_a_tokenizer_with_other_cuts_encodes_whole_texts(sample):
    from tokenizers import Tokenizer
    data = [(r.text or "").encode() for r in sample.collect()][:60]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    cuts = {}
    for name in sorted(x for x in os.listdir(os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))) if x.endswith(".json")):
        path = public_tokenizers.path(name)
        try:
            tok = Tokenizer.from_file(path)
        except Exception:  # another kind of file
            continue
        ids, counts = K.encode(offsets, b"".join(data), path, 2)
        want = [[*tok.encode(x.decode(), add_special_tokens=False).ids, 2] for x in data]
        assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want], name
        cuts[name] = K._encoder(path).cuts
    assert cuts["word_bpe_49k.json"]


def test_hadoop_store_names(monkeypatch):
    from fundlake.llm import common
    seen = []
    store = types.SimpleNamespace(from_uri=lambda uri: seen.append(uri) or (None, uri))
    monkeypatch.setattr(common, "pafs", types.SimpleNamespace(FileSystem=store))
    for uri in ("s3a://b/x", "file:/tmp/x", "hdfs://n/x"):
        common.open_store(uri)
    assert seen == ["s3://b/x", "file:///tmp/x", "hdfs://n/x"]


def test_tokens_read_back(edge, empty, sample, monkeypatch):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for docs, block in ((sample, K.BLOCK_IDS), (edge, K.BLOCK_IDS), (edge, 64)):
        monkeypatch.setattr(K, "BLOCK_IDS", block)
        manifest = K.write_tokens(docs, path, 49_408, 2)
        got, start, want = K.read_tokens(manifest).collect(), 0, []
        data = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0))
        for i, t in data:
            ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
        one = K.TokenFile(manifest.orderBy("part").first()["path"])
        assert one.document(0).tolist()[-1] == 2
    assert K.read_tokens(K.write_tokens(empty, path, 49_408, 2)).count() == 0


def test_encode_odd_texts():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = ["The. THE, don't I'll <|endoftext|> x.y, q,. \u00c9. H\u0331. \u2026. A\u030a, \x0b\ttab \ue000 a\ue000b", "", "...",
             "H\u0331 <|ENDOFTEXT|>", "a" * 5000]
    raw = "".join(texts).encode()
    ids, counts = K.encode(np.cumsum([0, *[len(t.encode()) for t in texts]]), raw, path, 2)
    assert ids.tolist() == [x for t in texts for x in [*tok.encode(t, add_special_tokens=False).ids, 2]] and counts.sum() == len(ids)


def test_carried_texts_go_to_the_search_once(edge, benchmark):
    def columns(docs, carry):
        return D.decontaminate(docs, benchmark, carry)._jdf.queryExecution().analyzed().child().output().size()
    assert columns(edge, edge.columns) == 1, "the text is in the carried row"
    assert columns(edge, ["doc_id"]) == 2


def test_decontamination_holds_one_group_at_a_time(monkeypatch):
    import weakref
    import pyarrow as pa
    monkeypatch.setattr(D, "GROUP_BYTES", 8)
    batches = iter([pa.record_batch([pa.array([f"some words of text {k}"])], names=["t"]) for k in range(6)])
    seen = []
    for runs, _ in D._groups(batches, lambda b: b.column(0)):
        assert not any(w() for w in seen)
        seen += [weakref.ref(r) for r in runs]
        runs.clear()
    assert len(seen) == 6
