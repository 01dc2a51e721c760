"""Min-max hashing: sets and components against all pairs, the estimator, hot groups."""

import random
import re

import numpy as np

from fundlake.llm import minmax as M
from fundlake.llm import simhash as S

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def plainly(rows):
    """(doc_id, n, component_id, kept) of every row, by all pairs."""
    sets = [plain_set(t) for _, t in rows]
    classes = {}
    for k, s in enumerate(sets):
        classes.setdefault(frozenset(s) if s else k, []).append(k)
    keys = list(classes)
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    real = sorted((k for k in keys if isinstance(k, frozenset)), key=len)
    for x, a in enumerate(real):
        for b in real[x + 1:]:
            if 100 * len(a) < 85 * len(b):
                break
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                parent[find(a)] = find(b)
    least = {}
    for k in keys:
        for i in classes[k]:
            if rows[i][0] is not None:
                least[find(k)] = min(least.get(find(k), rows[i][0]), rows[i][0])
    comp = {i: least.get(find(k)) for k in keys for i in classes[k]}
    return sorted(((d, len(sets[i]), comp[i], d == comp[i]) for i, (d, _) in enumerate(rows)), key=repr)


def got(docs):
    return sorted((tuple(r) for r in M.near_duplicates(docs).collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
    return " ".join(words)


def test_equals_all_pairs(spark, sample, edge, empty):
    for docs in (sample, edge):
        assert got(docs) == plainly([(r.doc_id, r.text) for r in docs.collect()])
    assert got(empty) == []


def test_short_and_odd_texts(spark):
    texts = ["a", "A", "a b", "b a", "a b c d", "a b c d e", "A B\tC\nD e", "a b c d e f", "a a a a a a a", "a a a a a", " ", "", None, "é é É"]
    texts += [" ".join(f"x{k}" for k in range(n)) for n in (10, 11, 12, 13)]
    rows = [(k % 11 if k % 5 else None, t) for k, t in enumerate(texts * 2)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plainly(rows)


def test_group_of_near_copies(spark, monkeypatch):
    """Random links within one large group, many buckets of many blocks; a chain; copies."""
    monkeypatch.setattr(M, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"v{rng.randrange(500)}" for _ in range(150)]
    rows = [(k, edited(rng, base, rng.choice([1, 1, 1, 2, 2, 3, 4]))) for k in range(260)]
    chain = [f"c{k}" for k in range(200)]
    for k in range(40):
        chain[5 * k % 200] = f"changed{k}"
        rows.append((1000 - k, " ".join(chain)))
    rows += [(2000 + k, rows[0][1]) for k in range(50)] + [(3000 + k, "wholly other words " + edited(rng, base[:30], 20)) for k in range(20)]
    want = plainly(rows)
    assert 40 < len({r[2] for r in want}) < 200
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_estimates_are_unbiased_and_vary_less():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85):
        both = int(400 * share)
        seen = []
        for _ in range(150):
            x = rng.integers(0, 1 << 63, 400, np.uint64)
            a, b = np.sort(x[:both + (400 - both) // 2]), np.sort(np.concatenate([x[:both], x[both + (400 - both) // 2:]]))
            least, most = M.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            sig = M.short_signatures(least, most)
            seen.append(((least[0] == least[1]).sum() + (most[0] == most[1]).sum()) / M.VALUES)
            assert abs((sig[0] == sig[1]).mean() - seen[-1]) < 0.05
        assert abs(np.mean(seen) - share) < 0.01
        assert np.var(seen) < 1.3 * share * (1 - share) / M.VALUES


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 200, np.uint64)
        a, b = np.sort(x[:185]), np.sort(np.concatenate([x[:170], x[185:]]))
        keys = M.bands(*M.signatures(np.concatenate([a, b]), np.array([0, 185, 370])))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_long_sets_span_chunks():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 63, 3 * M.CHUNK + 17, np.uint64)
    first = np.array([0, 0, 5, 2 * M.CHUNK + 9, 2 * M.CHUNK + 9, len(x)])
    least, most = M.signatures(x, first)
    for k in range(5):
        part = (x[first[k]:first[k + 1]] >> np.uint64(32)).astype(np.uint32)
        if len(part):
            v = part[:, None] * M._FACTORS + M._SHIFTS
            assert (least[k] == v.min(0)).all() and (most[k] == v.max(0)).all()


def test_rounds_without_new_links_walk_no_components_again(spark, monkeypatch):
    """Copies that the first round links: the later rounds add no link, and the steps
    that join components (each of them some shuffles) end with the first."""
    steps, work_path = [], S.work_path
    monkeypatch.setattr(S, "work_path", lambda session, name: steps.append(name) or work_path(session, name))
    rng = random.Random(8)
    base = [[f"g{g}w{rng.randrange(10**6)}" for _ in range(400)] for g in range(6)]
    rows = [(k, edited(rng, base[k % 6], k // 6 % 2)) for k in range(24)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plainly(rows)
    assert 2 <= len(steps) <= 3


def test_components_of_few_and_of_many_links(spark, monkeypatch):
    """A path, a hub, a cycle, repeated links and loops, added to in a second call."""
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1001 + k) for k in range(90)] + [(2000 + k, 2000 + (k + 1) % 7) for k in range(7)] + [(5, 5), (60, 59), (3001, 3000)] * 2
    more = [(rng.randrange(90), 1000 + rng.randrange(90)), (2003, 3001), (4000, 4001), (4001, 4001)]

    def plain(links):
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x
        for a, b in links:
            if a != b:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        return {x: find(x) for x in parent if find(x) != x}
    first, further = (spark.createDataFrame(e, "u long, v long") for e in (edges, more))
    for most in (0, 20, 1 << 17):
        monkeypatch.setattr(S, "BROADCAST_LINKS", most)
        roots = S.components(first)
        assert sorted(map(tuple, roots.collect())) == sorted(plain(edges).items())
        assert sorted(map(tuple, S.joined_components(roots, further).collect())) == sorted(plain(edges + more).items())
        assert S.joined_components(roots, further.where("false")) is roots
