"""Conversation repair: all edits tried by brute force, a plain search with whole
strings, edge rows, and the bound of the unresolved part."""

import hashlib
import itertools
import random
import re
import zlib

from fundlake.llm.turns import Decoder, damaged, repair, summarize

WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def tried(rows, found):
    """Every way to edit, with up to two insertions at each place."""
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    options = []
    for (role, text), fault in zip(rows, found, strict=True):
        more = fault == "truncated"
        here = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            here += [("K", more, (role, text)), ("R", 2 + more, ("user", text)), ("R", 2 + more, ("assistant", text))]
        options.append(here)
    for ways in itertools.product(*options):
        base = sum(w[1] for w in ways)
        if best and base > best[0]:
            continue
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            cost = base + 2 * sum(map(len, filled))
            if best and cost > best[0]:
                continue
            letters, out = "", []
            for k, gap in enumerate(filled):
                letters += "I" * len(gap)
                out += [(r, "") for r in gap]
                if k < len(rows):
                    letters += ways[k][0]
                    out += [ways[k][2]] if ways[k][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, out)
    return best


def searched(rows, found):
    """A plain search that carries whole strings."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    need = ["user", "user", "assistant", "user"]

    def opened(states):
        out = dict(states)
        for _ in range(3):
            for s, (c, w, t) in list(out.items()):
                to = step[s][need[s][0]]
                if to not in out or (c + 2, w + "I") < out[to][:2]:
                    out[to] = (c + 2, w + "I", [*t, (need[s], "")])
        return out

    states = {0: (0, "", [])}
    for (role, text), fault in zip(rows, found, strict=True):
        after = {}
        more = fault == "truncated"
        for s, (c, w, t) in opened(states).items():
            ways = [(s, c + 3, w + "D", t)]
            if fault not in ("blank", "duplicate"):
                if role[:1] in step[s]:
                    ways.append((step[s][role[:1]], c + more, w + "K", [*t, (role, text)]))
                ways.append((step[s][need[s][0]], c + 2 + more, w + "R", [*t, (need[s], text)]))
            for to, *way in ways:
                if to not in after or way[:2] < list(after[to][:2]):
                    after[to] = tuple(way)
        states = after
    return min((v for s, v in opened(states).items() if s in (0, 3)), key=lambda v: v[:2])


def decoded(rows, found):
    d = Decoder()
    out = []
    for (role, _), fault in zip(rows, found, strict=True):
        out += d.add(role, fault)
    return "".join(out + d.finish()), d


def some(rng, n):
    texts = ["", " \n", "Yes.", "Yes.", "No!", "well", "hm.", "what? "]
    return [(rng.choice(["user", "assistant", "user", "assistant", "system", " ", "", "tool", "u"]), rng.choice(texts) + rng.choice(["", "", "x", "x."])) for _ in range(n)]


def test_all_edits_tried():
    rng = random.Random(5)
    for n in [0, 1, 1, 1] + [2] * 25 + [3] * 25 + [4] * 4:
        rows = some(rng, n)
        found = faults(rows)
        cost, letters, out = tried(rows, found)
        assert decoded(rows, found)[0] == letters, rows
        assert searched(rows, found)[:2] == (cost, letters) and searched(rows, found)[2] == out


def test_long_conversations_and_ties():
    rng = random.Random(6)
    for n in (5, 8, 13, 40, 200):
        for _ in range(40):
            rows = some(rng, n)
            assert decoded(rows, faults(rows))[0] == searched(rows, faults(rows))[1]
    for role in ("user", "assistant", "system"):  # nothing resolves: whole suffixes tie until the end
        rows = [(role, f"line {k}.") for k in range(301)]
        assert decoded(rows, [None] * 301)[0] == searched(rows, [None] * 301)[1]


def test_survivors_coalesce():
    rng = random.Random(7)
    rows = [(("user", "assistant")[k % 2], f"line {k}.") for k in range(20_000)]
    rows = [r for r in rows if rng.random() > 0.02]
    rows = [("user" if rng.random() < 0.02 else role, "" if rng.random() < 0.02 else text) for role, text in rows]
    letters, d = decoded(rows, faults(rows))
    assert d.deepest < 400 and len(letters.replace("I", "")) == len(rows)
    _, d = decoded([("user", "")] * 5000, ["blank"] * 5000)
    assert d.deepest <= 1


def plainly(rows):
    """What summarize should say of a conversation's (turn, role, text) rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = [r[1:] for r in rows]
    found = faults(said)
    turns = {t for t, _, _ in rows if t is not None}
    cost, letters, out = searched(said, found)
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(said, said[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            yield from [(conv, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (2 if k == 3 else 1)


def edge_rows():
    rng = random.Random(8)
    out = [(c, None if rng.random() < 0.1 else rng.randrange(12), *some(rng, 1)[0]) for c in [None, *range(60)] for _ in range(rng.randrange(1, 14))]
    out += [(1, 2, None, None), (1, None, None, "x."), (2, 5, "user", "é" * 300_000 + "."), (2, 5, "user", "é" * 300_000 + "."), (None, None, None, None)]
    return out + out[:20]


def by_conversation(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


def test_equals_plain_search(spark):
    rows = edge_rows()
    given = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, fault string, edit int, digest int")
    got = {r.conv_id: tuple(r)[1:] for r in summarize(repair(given)).collect()}
    assert got == {c: plainly(rs) for c, rs in by_conversation(rows).items()}
    assert repair(given.where("false")).count() == 0 and summarize(repair(given.where("false"))).count() == 0


def test_edits_hold_the_repaired_turns(spark):
    rows = edge_rows()
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = repair(given).collect()
    for conv, rs in by_conversation(rows).items():
        mine = sorted((r for r in edits if r.conv_id == conv), key=lambda r: r.seq)
        assert [r.seq for r in mine] == list(range(len(mine))) and sum(r.edit != "I" for r in mine) == len(rs)
        kept = "".join(r.role[:1] for r in mine if r.edit != "D")
        assert re.fullmatch("(s?(ua)+)?", kept) and all(r.text == "" and r.was is None for r in mine if r.edit == "I")


def test_query_equals_plain_search(spark, tmp_path):
    from fundlake.llm.queries import QUERIES
    rows = edge_rows() + [(c, t, "user", "x.") for c in range(1000, 1040) for t in range(1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_repair_turns"](spark, str(tmp_path)).collect()}
    after = by_conversation(damage(rows))
    assert got == {c: plainly(after.get(c, [])) for c in by_conversation(rows)}
    assert any(c not in after for c in got), "a conversation that loses all its rows stays"
    assert damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).count() == sum(map(len, after.values()))
