"""Repair of conversation structure by a Viterbi search that streams.

The roles of a conversation must read ``(s?(ua)+)?`` by their initials. Each turn
is kept, given another role or deleted, and empty turns are inserted; the search
finds the cheapest edits, of equally cheap ones those whose letters D, I, K, R
come first in ASCII.

After each turn at most one survivor per state of the automaton is left: a path
in a tree of backpointers with reference counts. A survivor that another one
beats however the conversation goes on is released, and with it the nodes that
only it needed. As soon as all survivors share an ancestor, the edits up to there
are final: they are emitted and their nodes and turns dropped, so memory holds
the unresolved part of one conversation only.

Ties need the order of the complete unresolved suffixes. Two survivors after
the same turn never are prefixes of each other (letters and turns fix the cost,
and a longer one would hold more insertions), so what follows cannot change their
order. It is therefore kept as a rank per survivor: a candidate's suffix compares
by its survivor's rank, then by the letters it adds.

On the cluster, conversations are hashed to partitions and their turns sorted;
one conversation streams through one task. Earlier occurrences of a turn are found
by an aggregate and a join, not in that task.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.common import partitions_for

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

#: Automaton of (s?(ua)+)?: state -> the state after each initial. 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("user", "user", "assistant", "user")
FINAL = (0, 3)


def _insertions(state: int) -> list[tuple[str, int, int]]:
    """(letters, cost, state) of inserting turns until a state repeats."""
    out, seen, letters = [], set(), ""
    while state not in seen:
        seen.add(state)
        out.append((letters, INSERT_COST * len(letters), state))
        letters += INSERT
        state = NEXT[state][WANTED[state][0]]
    return out


INSERTIONS = tuple(_insertions(s) for s in range(len(NEXT)))


class Node:
    """One edit in the tree. ``refs`` counts its children and the survivors that end in it."""

    __slots__ = ("parent", "letter", "refs", "children")

    def __init__(self, parent: Node | None, letter: str):
        self.parent, self.letter, self.refs, self.children = parent, letter, 0, []
        if parent is not None:
            parent.refs += 1
            parent.children.append(self)


def _release(node: Node) -> None:
    """Take one reference off, and drop the nodes that nothing refers to."""
    node.refs -= 1
    while not node.refs and node.parent is not None:
        parent = node.parent
        parent.children.remove(node)
        parent.refs -= 1
        node = parent


class Decoder:
    """The search over one conversation: ``add`` takes a turn and returns the
    edits that became final, ``finish`` the rest. ``nodes`` is the unresolved tree's
    greatest depth so far."""

    def __init__(self) -> None:
        self.root = Node(None, "")
        self.root.refs = 1
        #: state -> (cost, rank, node)
        self.survivors: dict[int, tuple[int, int, Node]] = {0: (0, 0, self.root)}
        self.depth = self.deepest = 0

    def add(self, role: str, fault: str | None) -> list[str]:
        """The edits, in order, that are final after this turn."""
        forced = fault in (BLANK, DUPLICATE)
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        initial = role[:1]
        best: dict[int, tuple[int, int, str, int]] = {}  # state -> cost, rank, letters, survivor

        def offer(state: int, cost: int, rank: int, letters: str, source: int) -> None:
            at = best.get(state)
            if at is None or (cost, rank, letters) < at[:3]:
                best[state] = (cost, rank, letters, source)

        for source, (cost, rank, _) in self.survivors.items():
            for letters, extra, state in INSERTIONS[source]:
                here = cost + extra
                offer(state, here + DELETE_COST, rank, letters + DELETE, source)
                if not forced:
                    kept = NEXT[state].get(initial)
                    if kept is not None:
                        offer(kept, here + more, rank, letters + KEEP, source)
                    offer(NEXT[state][WANTED[state][0]], here + REROLE_COST + more, rank, letters + REROLE, source)
        order = {key: k for k, key in enumerate(sorted({(c[1], c[2]) for c in best.values()}))}
        ranked = {state: (c[0], order[c[1], c[2]], c) for state, c in best.items()}
        alive = [state for state in ranked if not self._beaten(state, ranked)]
        made: dict[tuple[int, str], Node] = {}  # paths that share letters share nodes
        after = {}
        for state in alive:
            cost, rank, (_, _, letters, source) = ranked[state]
            node = self.survivors[source][2]
            for k in range(len(letters)):
                key = (source, letters[:k + 1])
                node = made.get(key) or made.setdefault(key, Node(node, letters[k]))
            node.refs += 1
            after[state] = (cost, rank, node)
        for _, _, node in self.survivors.values():
            _release(node)
        self.survivors = after
        self.depth += 1
        return self._final()

    @staticmethod
    def _beaten(state: int, ranked: dict[int, tuple]) -> bool:
        """Whether another survivor ends better than this one whatever turns follow."""
        mine = ranked[state][:2]
        for other, (cost, rank, _) in ranked.items():
            if other == state:
                continue
            for _, extra, there in INSERTIONS[other]:
                # The same state by inserting; after s alone nothing is possible that is not after a.
                if (there == state or (there == 3 and state == 1)) and (cost + extra, rank) < mine:
                    return True
                # After a, a start's continuation costs at most its s: that turn deleted instead of kept.
                if there == 3 and state == 0 and cost + extra + DELETE_COST < mine[0]:
                    return True
        return False

    def _final(self) -> list[str]:
        out = []
        while self.root.refs == 1 and self.root.children:
            self.root = self.root.children[0]
            self.root.parent = None
            out.append(self.root.letter)
        self.depth -= sum(x != INSERT for x in out)
        self.deepest = max(self.deepest, self.depth)
        return out

    def finish(self) -> list[str]:
        ends = [(cost + extra, rank, letters, node) for s, (cost, rank, node) in self.survivors.items()
                for letters, extra, state in INSERTIONS[s] if state in FINAL]
        _, _, letters, node = min(ends, key=lambda e: e[:3])
        path = []
        while node is not self.root:
            path.append(node.letter)
            node = node.parent
        return [*reversed(path), *letters]


class _Repair:
    """Turns edits into rows of one conversation, and holds the turns that wait for theirs."""

    def __init__(self, conv_id):
        self.conv_id, self.decoder, self.waiting, self.seq, self.state = conv_id, Decoder(), deque(), 0, 0
        self.last = None

    def turn(self, row: dict) -> Iterator[tuple]:
        same = (row["turn"], row["role"], row["text"])
        fault = row["fault"] or (DUPLICATE if row["again"] or same == self.last else TRUNCATED if row["cut"] else None)
        self.last = same
        self.waiting.append((row["turn"], row["role"], row["text"], fault))
        yield from self._rows(self.decoder.add(row["role"], fault))

    def end(self) -> Iterator[tuple]:
        yield from self._rows(self.decoder.finish())

    def _rows(self, edits: list[str]) -> Iterator[tuple]:
        for edit in edits:
            turn, was, text, fault = (None, None, "", None) if edit == INSERT else self.waiting.popleft()
            role = was if edit in (KEEP, DELETE) else WANTED[self.state]
            cost = {KEEP: 0, REROLE: REROLE_COST, DELETE: DELETE_COST, INSERT: INSERT_COST}[edit]
            if fault == TRUNCATED and edit != DELETE:
                cost += TRUNCATED_COST
            if edit != DELETE:
                self.state = NEXT[self.state][role[:1]]
            yield self.conv_id, self.seq, edit, cost, turn, was, role, text, fault
            self.seq += 1


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def faulty(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), ``fault`` ('blank' or null),
    ``again`` (role and text stand at a smaller turn of the conversation; of equal
    rows at one turn the caller takes all but one as repeated) and ``cut`` (the last
    character that is no blank is none of ``.!?``)."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled(F.col("role")).alias("role"),
                        _filled(F.col("text")).alias("text")).withColumn("digest", F.sha2("text", 256))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))  # nulls first
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first")) \
        .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    on = rows["conv_id"].eqNullSafe(first["_c"]) & (rows["role"] == first["_r"]) & (rows["digest"] == first["_d"])
    return rows.join(first, on).select(
        "conv_id", "turn", "role", "text", F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).alias("fault"),
        (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("again"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))


FIELDS = "seq long, edit string, cost long, turn long, was string, role string, text string, fault string"


def repair(turns: DataFrame, conv_col: str = "conv_id", batch_rows: int = 2048, batch_bytes: int = 4 << 20) -> DataFrame:
    """The cheapest edits of every conversation, one row per edit: ``conv_id``, ``seq``
    (from 0), ``edit`` (K kept, R given another role, D deleted, I inserted), its
    ``cost``, the ``turn``, role before (``was``) and after (``role``), ``text`` and
    ``fault`` (blank, duplicate, truncated or null). The repaired conversation is its
    rows that are not D, by ``seq``. Rows come out grouped by conversation and in
    order within their partition.

    Turns are taken by number, nulls first, then by role and text. Null roles and
    texts are one space, so a null text is blank. Rows without a conversation id are
    one conversation. Of repeated rows all but the first are duplicates. An empty
    table gives no rows. Columns other than conversation id, turn, role and text
    are not read. A text of any length is one value in memory."""
    rows = faulty(turns, conv_col).repartition(partitions_for(turns.sparkSession), "conv_id") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(FIELDS).fields])
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Repair | None = None
        out: list[tuple] = []
        size = 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

        def taken(rows: Iterator[tuple]) -> None:
            nonlocal size
            for r in rows:
                out.append(r)
                size += len(r[7])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for start in range(0, batch.num_rows, batch_rows):
                for row in batch.slice(start, batch_rows).to_pylist():
                    if open_ is None or row["conv_id"] != open_.conv_id:
                        if open_ is not None:
                            taken(open_.end())
                        open_ = _Repair(row["conv_id"])
                    taken(open_.turn(row))
                    if len(out) >= batch_rows or size >= batch_bytes:
                        yield flush(kind)
                        out, size = [], 0
        if open_ is not None:
            taken(open_.end())
        if out:
            yield flush(kind)

    return rows.mapInArrow(run, schema)


def summarize(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s edits, read in their order without a
    shuffle: gaps in the turn numbers, faults, illegal neighbours before the repair,
    cost, the edits' letters and the SHA-256 of the repaired ``role:text`` lines."""
    schema = T.StructType([edits.schema["conv_id"], *T.StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Summary | None = None
        kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            done = []
            for row in batch.to_pylist():
                if open_ is None or row["conv_id"] != open_.conv_id:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = _Summary(row["conv_id"])
                open_.add(row)
            if done:
                yield rows_of(done, kind)
        if open_ is not None:
            yield rows_of([open_.row()], kind)

    def rows_of(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=schema.names)

    return edits.mapInArrow(run, schema)


class _Summary:
    LEGAL = ("su", "ua", "au")

    def __init__(self, conv_id):
        self.conv_id, self.faults, self.illegal, self.cost, self.letters = conv_id, dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0), 0, 0, []
        self.least = self.turn = self.before = None
        self.turns = 0
        self.hash, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        self.letters.append(row["edit"])
        self.cost += row["cost"]
        if row["edit"] != INSERT:
            if row["fault"]:
                self.faults[row["fault"]] += 1
            initial = row["was"][:1]
            self.illegal += self.before is not None and self.before + initial not in self.LEGAL
            self.before = initial
            if row["turn"] is not None and row["turn"] != self.turn:  # turns come in order
                self.least = row["turn"] if self.least is None else self.least
                self.turn = row["turn"]
                self.turns += 1
        if row["edit"] != DELETE:
            self.hash.update((("\n" if self.any else "") + f"{row['role']}:{row['text']}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return self.conv_id, gaps, *self.faults.values(), int(self.illegal), self.cost, "".join(self.letters), self.hash.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a
    user's. Nulls count as one space, in the key too."""
    key = F.pmod(F.crc32(F.concat(_filled(F.col("conv_id")), F.lit(":"), _filled(F.col("turn"))).cast("binary")), F.lit(20))
    text, role = _filled(F.col("text")), _filled(F.col("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), key.alias("_k")).where("_k <> 0").select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
