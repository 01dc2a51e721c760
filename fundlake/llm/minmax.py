"""Near-duplicates by min-max hashing.

Under each permutation of the shingle hashes a document keeps both its smallest
and its largest value: two values of a signature for one evaluation. Each of them
agrees between two documents with the probability of their Jaccard similarity, and
as a set's minimum and maximum are distinct shingles drawn without replacement, the
share of agreeing values estimates the similarity without bias and with less
variance than as many independent minima.

Documents with the same set are one class. Six values (of three permutations) make
a band; classes that share a band meet in a bucket. Two sets at the similarity
sought share none of the 32 bands with probability below 3e-7. Buckets link classes
in rounds, so that a large group of near copies never becomes all its pairs:

1. every class asks the bucket's smallest class that it shares most bands with;
2. where a bucket still holds several components, each class asks the class of another
   component whose signature agrees most with its own, found block by block;
3. what then still differs in component and agrees enough by signature is asked; here
   whole sets meet in pairs of blocks, so no row stands for a single pair.

Every link is confirmed on the full sets. Of pairs at the similarity sought, the
signature test of rounds 2 and 3 (five standard errors below) loses fewer than 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import BY_SPACE, Words, partitions_for, ranges, text_slices, write_once
from fundlake.llm.simhash import components, joined_components, text_digest

SHINGLE_WORDS = 5
LEAST_PERCENT = 85
BANDS = 32
BAND_PERMUTATIONS = 3
PERMUTATIONS = BANDS * BAND_PERMUTATIONS
VALUES = 2 * PERMUTATIONS
SEED = 12
#: Shingles hashed at once under all permutations; bounds the temporary arrays.
CHUNK = 8192
#: Classes of a bucket in one block; pairs of blocks are independent rows of work.
BLOCK = 256
#: Shingles of a block; bounds what a task holds where sets are long.
BLOCK_SHINGLES = 1 << 20
#: Pairs compared at once inside a task.
PAIRS = 1 << 16
#: Standard errors that a signature may fall short of the similarity sought.
MARGIN = 5.0

_rng = np.random.default_rng(SEED)
_FACTORS = (_rng.integers(0, 1 << 31, PERMUTATIONS, np.uint64) * 2 + 1).astype(np.uint32)
_SHIFTS = _rng.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(columns: list[np.ndarray], start: int) -> np.ndarray:
    """64-bit hash of the rows of some columns, as a polynomial."""
    out = np.full(len(columns[0]), start, np.uint64)
    for c in columns:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + c)
    return out


def shingle_sets(offsets: np.ndarray, data: bytes, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of some texts as sorted 64-bit hashes, text after text,
    and where each text's begin. A text of fewer words is one shingle."""
    words = Words(offsets, data, BY_SPACE)
    codes, distinct = words.coded()
    h = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()], np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
    counts = np.diff(words.doc_first)
    n_sh = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(n_sh)])
    out = np.zeros(int(first[-1]), np.uint64)
    for size in range(1, width + 1):
        docs = np.flatnonzero(counts >= width if size == width else counts == size)
        if len(docs):
            at = ranges(words.doc_first[docs], n_sh[docs])
            out[ranges(first[docs], n_sh[docs])] = _joined([h[at + k] for k in range(size)], size)
    for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out[s:e].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[first[:-1][n_sh > 0]] = True
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[first]


def signatures(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each set under each permutation."""
    n = len(first) - 1
    least = np.full((n, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    most = np.zeros((n, PERMUTATIONS), np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    set_of = np.repeat(np.arange(n), np.diff(first))
    for at in range(0, len(x), CHUNK):
        sets = set_of[at:at + CHUNK]
        heads = np.flatnonzero(np.concatenate([[True], sets[1:] != sets[:-1]]))
        values = _FACTORS[:, None] * x[None, at:at + CHUNK] + _SHIFTS[:, None]
        mine = sets[heads]
        least[mine] = np.minimum(least[mine], np.minimum.reduceat(values, heads, axis=1).T)
        most[mine] = np.maximum(most[mine], np.maximum.reduceat(values, heads, axis=1).T)
    return least, most


def bands(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band."""
    out = np.empty((len(least), BANDS), np.uint64)
    for b in range(BANDS):
        part = range(b * BAND_PERMUTATIONS, (b + 1) * BAND_PERMUTATIONS)
        out[:, b] = _joined([v[:, k].astype(np.uint64) for k in part for v in (least, most)], b + 1)
    return out


def short_signatures(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A byte of each signature value. Differing values share it once in 256."""
    v = np.concatenate([least, most], axis=1)
    return (((v ^ (v >> np.uint32(16))) * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _bytes_column(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows))])


def signed_rows(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, text_digest, n (distinct shingles), set_digest, bands and the short
    signature of every row; a text without words has n 0, no digest and no bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                hashes, first = shingle_sets(offsets, data, width)
                n = np.diff(first)
                least, most = signatures(hashes, first)
                keys = bands(least, most)[n > 0].view(np.int64)
                raw = memoryview(hashes.view(np.uint8))
                digests = [xxhash.xxh3_128_digest(raw[8 * s:8 * e]) if e > s else None for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(n)), batch.column(2).slice(at, len(n)), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     lists, _bytes_column(short_signatures(least, most))],
                    names=["doc_id", "text_digest", "n", "set_digest", "bands", "signature"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), text_digest(F.col(text_col))) \
        .mapInArrow(run, "doc_id long, text_digest binary, n long, set_digest binary, bands array<long>, signature binary")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """cls, n and the whole set of each class of ``wanted`` (cls, rep), from the text
    of the row that stands for it."""
    given = docs.select(F.col(id_col).cast("long").alias("_id"), text_digest(F.col(text_col)).alias("_digest"), F.col(text_col).cast("string").alias("_text"))
    on = given["_id"].eqNullSafe(F.col("rep.doc_id")) & (given["_digest"] == F.col("rep.text_digest"))
    # Rows that repeat id and text count once.
    texts = given.join(wanted.select("cls", "rep"), on).groupBy("cls").agg(F.first("_text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                hashes, first = shingle_sets(offsets, data, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(first) - 1), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))], names=["cls", "n", "items"])

    return texts.mapInArrow(run, "cls long, n long, items array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("cls").alias("u"), F.col("n").alias("_nu"), F.col("items").alias("_iu"))
    b = sets.select(F.col("cls").alias("v"), F.col("n").alias("_nv"), F.col("items").alias("_iv"))
    both = pairs.join(a, "u").join(b, "v").where(100 * F.least("_nu", "_nv") >= percent * F.greatest("_nu", "_nv"))
    shared = F.size(F.array_intersect("_iu", "_iv"))
    return both.withColumn("_s", shared).where(100 * F.col("_s") >= percent * (F.col("_nu") + F.col("_nv") - F.col("_s"))).select("u", "v")


def _agreeing(cls, comp, n, sig, side, start: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group, of different components, lengths and
    signatures that allow the similarity: (row, row, agreeing values). ``start``
    holds for each row where the next group begins."""
    least = percent / 100
    least -= MARGIN * np.sqrt(least * (1 - least) / VALUES)
    need = VALUES * (least + (1 - least) / 256)
    counts = start - np.arange(len(cls)) - 1
    bound = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(cls):
        to = max(at + 1, int(np.searchsorted(bound, bound[at] + PAIRS, "right")) - 1)
        rows = np.arange(at, to)
        a, b = np.repeat(rows, counts[at:to]), ranges(rows + 1, counts[at:to])
        ok = (comp[a] != comp[b]) & ((side[a] < 0) | (side[a] != side[b]))
        ok &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        a, b = a[ok], b[ok]
        if len(a):
            same = np.count_nonzero(sig[a] == sig[b], axis=1)
            ok = same >= need
            yield a[ok], b[ok], same[ok]
        at = to


def _blocks(members: DataFrame, classes: DataFrame, extra: list[str]) -> DataFrame:
    """The members of the buckets that hold several components, dealt to pairs of
    blocks (key, i, j) and sorted by them. ``side`` is -1 within one block, else the
    member's block. A block has about BLOCK classes and BLOCK_SHINGLES shingles.
    Only members of such buckets take signatures (and ``extra``) from ``classes``."""
    spark = members.sparkSession
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    open_ = members.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), blocks).where("_a <> _b").select("key", "blocks")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    told = classes.select(F.col("cls").alias("_cls"), "signature", *extra)
    return members.join(open_, "key").withColumn("own", own).join(told, F.col("cls") == F.col("_cls")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"),
                "cls", "comp", "n", "signature", *extra) \
        .repartition(partitions_for(spark) * 2, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of whole groups (the first three columns): table, first rows and ends of its groups."""
    def told(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held)
        keys = [t.column(k).to_numpy() for k in range(3)]
        heads = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
        return t, heads, np.append(heads[1:], t.num_rows)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in range(3)):
            yield told(held)
            held = []
        if len(cut):
            yield told([*held, batch.slice(0, int(cut[-1]))])
            held = [batch.slice(int(cut[-1]))]
        else:
            held.append(batch)
    if held:
        yield told(held)


def _pairs(t: pa.Table, heads: np.ndarray, ends: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    side, cls, comp, n = (t.column(k).to_numpy() for k in range(3, 7))
    sig = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint8).reshape(t.num_rows, VALUES)
    yield from _agreeing(cls, comp, n, sig, side, np.repeat(ends, ends - heads), percent)


def best_partners(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """For each class at most one pair (u, v), u > v: with the class of another
    component whose signature agrees most with its own in some bucket of ``members``
    (key, cls, comp, n); ``classes`` has the signatures."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, heads, ends in _groups(batches):
            cls = t.column(4).to_numpy()
            for a, b, same in _pairs(t, heads, ends, percent):
                u, v, same = np.concatenate([cls[a], cls[b]]), np.concatenate([cls[b], cls[a]]), np.concatenate([same, same])
                order = np.lexsort((v, -same, u))
                if len(order):
                    order = order[np.concatenate([[True], u[order][1:] != u[order][:-1]])]
                    yield pa.RecordBatch.from_arrays([pa.array(u[order]), pa.array(v[order]), pa.array(same[order].astype(np.int32))], names=["u", "v", "same"])

    found = _blocks(members, classes, []).mapInArrow(meet, "u long, v long, same int")
    found = found.groupBy("u").agg(F.max(F.struct("same", (-F.col("v")).alias("v"))).alias("x")).select("u", (-F.col("x.v")).alias("v"))
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def remaining_links(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v), u > v, that join the components of ``members`` (key, cls, comp, n)
    as all links between classes that share a bucket would; ``classes`` has the
    signatures and bands.

    A pair is asked in its first shared band only. Sets travel once for each pair of
    blocks in which they are asked, not once for each pair of classes, and of the
    links found in a pair of blocks only a spanning forest comes out."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, heads, ends in _groups(batches):
            keys = t.column(0).to_numpy()
            shared = t.column(8).combine_chunks().flatten().to_numpy().reshape(t.num_rows, BANDS)
            rows, partners = [], []
            for a, b, _ in _pairs(t, heads, ends, percent):
                same = shared[a] == shared[b]
                first = same.argmax(axis=1)
                here = shared[a, first] == keys[a]
                rows.append(a[here])
                partners.append(b[here])
            a, b = np.concatenate([*rows, [0][:0]]).astype(np.int64), np.concatenate([*partners, [0][:0]]).astype(np.int64)
            if not len(a):
                continue
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            told = np.union1d(a, b)
            counts = np.bincount(np.searchsorted(told, a), minlength=len(told))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(t.column(4).to_numpy()[b]))
            part = t.take(pa.array(told))
            yield pa.RecordBatch.from_arrays([*(part.column(k).combine_chunks() for k in (0, 1, 2, 4, 5)), lists], names=["key", "i", "j", "cls", "comp", "partners"])

    asked = _blocks(members, classes, ["bands"]).mapInArrow(ask, "key long, i int, j int, cls long, comp long, partners array<long>")
    told = asked.join(sets.select("cls", "items"), "cls").select("key", "i", "j", "cls", "comp", "partners", "items") \
        .repartition(partitions_for(members.sparkSession) * 2, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, heads, ends in _groups(batches):
            cls, comp = t.column(3).to_numpy(), t.column(4).to_numpy()
            first, flat = _flat(t.column(5))
            starts, items = _flat(t.column(6))
            u, v = [], []
            for s, e in zip(heads.tolist(), ends.tolist(), strict=True):
                place = {c: k for k, c in enumerate(cls[s:e].tolist(), s)}
                parent: dict[int, int] = {}

                def root(c: int) -> int:
                    while c in parent:
                        c = parent[c]
                    return c

                for k in range(s, e):
                    mine = items[starts[k]:starts[k + 1]]
                    for other in flat[first[k]:first[k + 1]].tolist():
                        x, y = root(int(comp[k])), root(int(comp[place[other]]))
                        if x == y:
                            continue
                        theirs = items[starts[place[other]]:starts[place[other] + 1]]
                        both = len(np.intersect1d(mine, theirs, assume_unique=True))
                        if 100 * both >= percent * (len(mine) + len(theirs) - both):
                            parent[x] = y
                            u.append(int(cls[k]))
                            v.append(other)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    return told.mapInArrow(settle, "u long, v long").distinct()


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    lists = column.combine_chunks()
    lists = lists.cast(pa.large_list(lists.type.value_type))
    return lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                    least_percent: int = LEAST_PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (distinct shingles),
    ``component_id`` (the smallest id that links of at least ``least_percent`` Jaccard
    similarity reach) and ``kept`` (it is the row's own).

    A text of fewer words than a shingle is one shingle; null and empty texts and texts
    without words have none and stand alone. Repeated rows stay, one output row each.
    A null id is never smaller than another; a component of null ids only has a null
    component_id, and its rows are kept. Rows that share an id but not a text link by
    their texts. An empty table gives no rows. Other columns are not read."""
    rows = write_once(signed_rows(docs, id_col, text_col, shingle_words), "minmax-rows")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_digest")).alias("rep")
    grouped = rows.where("n > 0").groupBy("set_digest").agg(rep, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    classes = write_once(grouped.withColumn("cls", F.monotonically_increasing_id()), "minmax-classes")

    spread = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.min("cls").alias("pivot"), F.max("cls").alias("_top")).where("pivot <> _top").select("key", "pivot")
    members = write_once(spread.join(shared, "key"), "minmax-members")
    wanted = classes.select("cls", "rep").join(members, "cls", "left_semi")
    sets = write_once(full_sets(docs, wanted, id_col, text_col, shingle_words), "minmax-sets")

    votes = members.where("cls <> pivot").groupBy("cls", "pivot").count()
    asked = votes.groupBy("cls").agg(F.max(F.struct("count", (-F.col("pivot")).alias("v"))).alias("x")).select(F.col("cls").alias("u"), (-F.col("x.v")).alias("v"))
    asked = write_once(asked, "minmax-asked")
    roots = components(write_once(confirmed(asked, sets, least_percent), "minmax-links"))

    def by_component() -> DataFrame:
        return members.join(roots, members["cls"] == roots["node"], "left").select("key", "cls", F.coalesce("root", "cls").alias("comp"), "n")

    best = write_once(best_partners(by_component(), classes, least_percent).join(asked, ["u", "v"], "left_anti"), "minmax-asked")
    roots = joined_components(roots, write_once(confirmed(best, sets, least_percent), "minmax-links"))
    roots = joined_components(roots, write_once(remaining_links(by_component(), classes, sets, least_percent), "minmax-links"))

    of_class = classes.join(roots, classes["cls"] == roots["node"], "left").select("set_digest", "rep.doc_id", F.coalesce("root", "cls").alias("root"))
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "root").select(F.col("set_digest").alias("_digest"), F.col("component_id").alias("_least"))
    component = F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id"))
    return rows.join(named, rows["set_digest"] == named["_digest"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
