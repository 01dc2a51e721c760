"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints are sorted by their rank in the reflected Gray code, so that
neighbours share most bits, and cut into groups. A group's node keeps a mask of
the bits that all its members share and their pattern; a parent holds what its
children have in common, and each child only its further shared bits. A search
walks down from the roots, adds the differences it meets at each node, and
leaves a whole group as soon as the sum exceeds the allowed distance.

On a cluster, one such order would leave nearly every pair of groups open: their
upper nodes share few bits. So there is one order for each of ``distance`` + 1
blocks of bits, rotated to the top. Two linked fingerprints agree on one block
whole, and in that order they stand under one key; a group is searched in itself
by the task that sorted it. Only a key that lies over several groups needs pairs
of them, each an independent row of work that the nodes' shared bits may prune.
A search returns a spanning forest of its links, never all of them, and the
forests are joined into components by alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import BY_SPACE, Words, partitions_for, remove_path, text_slices, work_path, write_once

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
#: Fingerprints per group.
GROUP_FINGERPRINTS = 8192
#: Sorted partitions at most; beyond them a task searches several groups in turn.
MAX_PARTITIONS = 1 << 14
LEAF = 16
FANOUT = 8
#: Candidate pairs examined at once by a search; bounds its memory.
SEARCH_PAIRS = 1 << 21
#: Links whose nodes' least ones (two rows a link at most) are broadcast.
BROADCAST_LINKS = 1 << 17


# ---- fingerprints -----------------------------------------------------------

def _fingerprints(offsets: np.ndarray, data: bytes, shingle: int) -> np.ndarray:
    w = Words(offsets, data, BY_SPACE)
    b = np.frombuffer(w.data, np.uint8)
    keep = w.inside.copy()
    keep[1:] |= w.inside[:-1]  # each word and one separator after it
    place = np.concatenate([[0], np.cumsum(keep)])
    text = memoryview(b[keep].tobytes())
    starts, ends = place[w.starts], place[w.ends]
    counts = np.diff(w.doc_first)
    n_sh = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(np.int64))
    first = np.repeat(w.doc_first[:-1], n_sh) + _within(n_sh)
    last = first + np.repeat(np.minimum(counts, shingle) - 1, n_sh)
    h = xxhash.xxh64_intdigest
    out = np.zeros(len(counts), np.uint64)
    doc_of, base = np.repeat(np.arange(len(counts)), n_sh), 0
    ones = np.zeros((len(counts), 64), np.int64)
    for base in range(0, len(first), 1 << 17):
        part = slice(base, base + (1 << 17))
        hashes = np.array([h(text[s:e], SEED) for s, e in zip(starts[first[part]].tolist(), ends[last[part]].tolist(), strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs = doc_of[part]
        heads = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        ones[docs[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    has = n_sh > 0
    set_bits = (2 * ones > n_sh[:, None]) & has[:, None]
    out[:] = np.packbits(set_bits, axis=1, bitorder="little").reshape(-1, 8).copy().view(np.uint64).ravel()
    return out


def _within(counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp long, digest): the 64-bit SimHash of each text's word shingles and
    the text's SHA-256. A text of fewer words is one shingle; a text without words
    has fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                fp = _fingerprints(offsets, data, shingle_words).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(fp)), pa.array(fp), batch.column(2).slice(at, len(fp))],
                                                 names=["doc_id", "fp", "digest"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), text_digest(F.col(text_col))) \
        .mapInArrow(run, "doc_id long, fp long, digest binary")


def text_digest(text: Column) -> Column:
    """SHA-256 of a text; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


# ---- the index --------------------------------------------------------------

def gray_rank(fp: Column) -> Column:
    """Rank of a fingerprint in the reflected Gray code, as a signed long that
    sorts like the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


class GrayIndex:
    """Nodes over fingerprints given in Gray order. Level 0 are the
    fingerprints, level k+1 groups of consecutive nodes of level k."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        low = high = fps
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # mask, pattern, first child
        width = LEAF
        while True:
            cut = np.arange(0, len(low), width)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            self.levels.append((~(low ^ high), low, np.append(cut, len(self.levels and self.levels[-1][0]) if self.levels else len(fps))))
            if len(low) <= FANOUT:
                break
            width = FANOUT
        # A node keeps only the shared bits that its parent does not have.
        self.extra = []
        for k, (mask, _, _) in enumerate(self.levels):
            if k + 1 < len(self.levels):
                up, _, first = self.levels[k + 1]
                self.extra.append(mask & ~np.repeat(up, np.diff(first)))
            else:
                self.extra.append(mask)

    def search(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query positions, fingerprint positions) within ``distance``. Works
        depth first over slices of the frontier, so memory stays bounded."""
        top = len(self.levels) - 1
        tops = len(self.levels[top][0])
        step = max(1, SEARCH_PAIRS // tops)
        stack = []
        for at in range(0, len(queries), step):
            n = min(step, len(queries) - at)
            stack.append((top, np.repeat(np.arange(at, at + n), tops), np.tile(np.arange(tops), n), np.zeros(n * tops, np.int16)))
            while stack:
                level, q, node, diff = stack.pop()
                _, pattern, first = self.levels[level]
                diff = diff + _popcount((queries[q] ^ pattern[node]) & self.extra[level][node])
                ok = diff <= distance
                q, node, diff = q[ok], node[ok], diff[ok]
                if not len(q):
                    continue
                counts = first[node + 1] - first[node]
                ends = np.cumsum(counts)
                for lo in range(0, len(q), max(1, SEARCH_PAIRS // (LEAF if level == 0 else FANOUT))):
                    hi = min(len(q), lo + max(1, SEARCH_PAIRS // (LEAF if level == 0 else FANOUT)))
                    c = counts[lo:hi]
                    children = np.repeat(first[node[lo:hi]], c) + _within(c)
                    if level:
                        stack.append((level - 1, np.repeat(q[lo:hi], c), children, np.repeat(diff[lo:hi], c)))
                    else:
                        asked = np.repeat(q[lo:hi], c)
                        rest = ~np.repeat(self.levels[0][0][node[lo:hi]], c)
                        near = np.repeat(diff[lo:hi], c) + _popcount((queries[asked] ^ self.fps[children]) & rest) <= distance
                        if near.any():
                            yield asked[near], children[near]
                del ends


def _roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Merge links a-b into a forest given as each node's root (a smaller position)."""
    while True:
        ra, rb = parent[a], parent[b]
        hi, lo = np.maximum(ra, rb), np.minimum(ra, rb)
        open_ = hi != lo
        if not open_.any():
            return parent
        np.minimum.at(parent, hi[open_], lo[open_])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _links(targets: np.ndarray, sources: np.ndarray, same: bool, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as (fingerprint, root), of the links between two groups."""
    nodes = targets if same else np.concatenate([targets, sources])
    shift = 0 if same else len(targets)
    parent = np.arange(len(nodes))
    for q, t in GrayIndex(targets).search(sources, distance):
        parent = _roots(len(nodes), q + shift, t, parent)
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]


def key_blocks(distance: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of ``distance`` + 1 blocks of the 64 bits:
    fingerprints within ``distance`` bits agree on the whole of at least one."""
    cuts = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _rotated(fps: np.ndarray, by: int) -> np.ndarray:
    return (fps << np.uint64(by)) | (fps >> np.uint64(64 - by)) if by % 64 else fps


_PIECE = "tbl int, key long, grp long, mask long, pattern long, fps binary, u long, v long"


def _searched(distance: int):
    """Task function over (tbl, fp) in Gray order: the links inside each group
    (u, v), and each group's fingerprints of its first and last key (pieces),
    which other groups may hold too. Every key between lies in one group whole."""
    widths = [width for _, width in key_blocks(distance)]
    firsts = [first for first, _ in key_blocks(distance)]
    size = GROUP_FINGERPRINTS

    def rows(n: int, **given: pa.Array) -> pa.RecordBatch:
        kinds = {"tbl": pa.int32(), "fps": pa.binary()}
        names = [f.split()[0] for f in _PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(n, kinds.get(c, pa.int64()))) for c in names], names=names)

    def group(tbl: int, grp: int, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = _links(fps, fps, True, distance)
        if len(a):
            a, b = (_rotated(x, 64 - firsts[tbl]).view(np.int64) for x in (a, b))
            yield rows(len(a), u=pa.array(np.maximum(a, b)), v=pa.array(np.minimum(a, b)))
        keys = fps >> np.uint64(64 - widths[tbl])
        for key in {int(keys[0]), int(keys[-1])}:
            mine = fps[keys == key]
            low, high = np.bitwise_and.reduce(mine), np.bitwise_or.reduce(mine)
            node = np.array([key, ~(low ^ high) & np.uint64(0xFFFFFFFFFFFFFFFF), low], np.uint64).view(np.int64)
            yield rows(1, tbl=pa.array([tbl], pa.int32()), key=pa.array(node[:1]), grp=pa.array([grp]), mask=pa.array(node[1:2]),
                       pattern=pa.array(node[2:]), fps=pa.array([mine.tobytes()], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        grp = TaskContext.get().partitionId() << 32
        tbl, held = -1, np.zeros(0, np.uint64)
        for batch in batches:
            tables = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.flatnonzero(np.diff(tables)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(fps)], strict=True):
                if hi == lo:
                    continue
                if tables[lo] != tbl:
                    if len(held):
                        yield from group(tbl, grp, held)
                        grp += 1
                    tbl, held = int(tables[lo]), np.zeros(0, np.uint64)
                held = np.concatenate([held, fps[lo:hi]])
                while len(held) >= size:
                    yield from group(tbl, grp, held[:size])
                    grp, held = grp + 1, held[size:]
        if len(held):
            yield from group(tbl, grp, held)

    return run


def links(classes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (u, v), u > v, that join all distinct fingerprints ``fp`` of
    ``classes`` exactly as their pairs within ``distance`` bits do."""
    blocks = key_blocks(distance)
    n = classes.count() * len(blocks)
    partitions = min(MAX_PARTITIONS, max(1, -(-n // GROUP_FINGERPRINTS)))
    spread = F.explode(F.array(*[
        F.struct(F.lit(i).alias("tbl"), (F.shiftleft("fp", at).bitwiseOR(F.shiftrightunsigned("fp", 64 - at)) if at else F.col("fp")).alias("fp"))
        for i, (at, _) in enumerate(blocks)]))
    turned = classes.select(spread.alias("x")).select("x.tbl", "x.fp")
    rank = gray_rank(F.col("fp"))
    found = write_once(turned.repartitionByRange(partitions, "tbl", rank).sortWithinPartitions("tbl", rank)
                       .mapInArrow(_searched(distance), _PIECE), "simhash-groups")

    # Only keys that lie over several groups: pairs of their pieces, first as
    # nodes; the shared bits of two nodes prune the pair before any fingerprint moves.
    pieces = found.where("grp is not null")
    a, b = (pieces.select("tbl", "key", F.col("grp").alias(f"{c}_grp"), F.col("mask").alias(f"{c}_mask"),
                          F.col("pattern").alias(f"{c}_pattern")) for c in "ab")
    apart = F.bit_count(F.col("a_pattern").bitwiseXOR(F.col("b_pattern")).bitwiseAND(F.col("a_mask")).bitwiseAND(F.col("b_mask")))
    pairs = a.join(b, ["tbl", "key"]).where((F.col("a_grp") < F.col("b_grp")) & (apart <= distance)) \
        .select("tbl", "key", "a_grp", "b_grp")
    for c in "ab":
        pairs = pairs.join(pieces.select("tbl", "key", F.col("grp").alias(f"{c}_grp"), F.col("fps").alias(f"{c}_fps")), ["tbl", "key", f"{c}_grp"])
    work = pairs.select("tbl", "a_grp", "b_grp", "a_fps", "b_fps").repartition(partitions_for(classes.sparkSession) * 2, "tbl", "a_grp", "b_grp")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tbl, mine, theirs in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4)), strict=True):
                u, v = _links(np.frombuffer(theirs, np.uint64), np.frombuffer(mine, np.uint64), False, distance)
                if len(u):
                    u, v = (_rotated(x, 64 - blocks[tbl][0]).view(np.int64) for x in (u, v))
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    return found.where("u is not null").select("u", "v").union(work.mapInArrow(meet, "u long, v long")).distinct()


# ---- components -------------------------------------------------------------

def components(edges: DataFrame, salt: int = 8) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node that
    it reaches. Alternating large-star and small-star steps; each step is
    written to the shared folder. A hub's links are spread over salted keys; up to
    BROADCAST_LINKS links stay where they are, and each node's least one travels."""
    spark = edges.sparkSession
    width = spark.sparkContext.defaultParallelism

    def star(pairs: DataFrame, keep: Column, few: bool) -> DataFrame:
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        if few:
            moved, own = F.struct(F.when(keep, F.col("b")).otherwise(F.col("a")).alias("u"), F.col("m").alias("v")), F.struct(F.col("a").alias("u"), F.col("m").alias("v"))
            return pairs.join(F.broadcast(least.coalesce(width)), "a").select(F.inline(F.array(moved, own))).where("u <> v")
        spread = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        salted = pairs.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(salt)).cast("int"))
        return salted.join(spread, ["a", "s"]).where(keep).select(F.col("b").alias("u"), F.col("m").alias("v")) \
            .union(least.select(F.col("a").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()

    def written(df: DataFrame) -> tuple[str, DataFrame, tuple]:
        path = work_path(spark, "star")
        df.write.parquet(path)
        back = spark.read.schema("u long, v long").parquet(path)
        return path, back, tuple(back.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    path, now, seal = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while seal[0]:
        few = seal[0] <= BROADCAST_LINKS
        both = now.selectExpr("u as a", "v as b").union(now.selectExpr("v as a", "u as b"))
        large = star(both, F.col("b") > F.col("a"), few).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = star(large.selectExpr("u as a", "v as b"), F.lit(True), few)
        new_path, after, new_seal = written(small.distinct().coalesce(width) if few else small)
        if new_seal == seal:
            remove_path(spark, new_path)
            break
        remove_path(spark, path)
        path, now, seal = new_path, after, new_seal
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def joined_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of what gave ``roots`` (node, root) and of further ``links`` (u, v):
    components already known enter as one link for each node, not as all of theirs."""
    if links.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """Near-duplicate groups: one row per row of ``docs`` with ``doc_id``,
    ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that
    links of at most ``distance`` bits reach; besides ``root``, a fingerprint that
    names the group also where no row of it has an id, and the text's ``digest``.

    Null texts count as empty; all texts without words share fingerprint 0 and
    are one fingerprint class. Repeated rows stay, one output row each. Rows
    with a null id keep it; a component whose ids are all null has a null
    component_id. An empty table gives no rows. Other columns are not read."""
    fps = write_once(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fps")
    classes = write_once(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    roots = components(links(classes, distance))
    of_class = classes.join(roots, classes["fp"] == roots["node"], "left") \
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    members = write_once(of_class.join(least, "root").select(F.col("fp").alias("_fp"), "component_id", "root"), "simhash-members")
    return fps.join(members, fps["fp"] == members["_fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", "digest")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` for each group of ``groups`` (``simhash_groups``
    of these rows): that of the smallest id, rows without an id last; of rows that
    share the id, that of the least text digest; of equal ones any."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    stay = groups.groupBy("root").agg(least.alias("row")).select("row.no_id", F.coalesce("row.doc_id", F.lit(0)).alias("id"), "row.digest")
    # The row as one column: no name of its own can clash, and only the digest is compared.
    given = docs.select(F.struct("*").alias("row"), F.col("doc_id").isNull().alias("no_id"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), text_digest(F.col("text")).alias("digest"))
    return given.join(stay, ["no_id", "id", "digest"], "left_semi").dropDuplicates(["no_id", "id", "digest"]).select("row.*")
