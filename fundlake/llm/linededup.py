"""Line deduplication by content-defined chunks of lines.

A text's lines are hashed, and a rolling hash over ``WINDOW`` line hashes ends a
chunk where it is divisible by ``DIVISOR``: what stands before a shared passage
moves no cut inside it. A chunk has at least ``LEAST_LINES`` lines. The parts of a
passage before its first cut and after its last are found by the smallest chunks,
the rolling windows themselves: every two neighbouring lines with words (blank lines
between them included). Where windows overlap, the whole equal run goes, so a passage
of two lines or more goes whole wherever it is cut. Besides, a run of lines of over
``PASSAGE_WORDS`` words goes even if it is one line, or if it repeats within its
document only.

Chunks of the whole corpus are grouped by a digest of their lines' digests; of each
group found twice or more (of fewer words: in two documents or more), the first stays
(least document id, then place in the text) and the lines of the rest are removed. Before
anything is removed for good, bytes are compared: of all that shares a digest, the
least and the greatest content must be the same, for chunks (as sequences of line
digests) and for lines (as text). Each task sends each content once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import text_slices, write_once

WINDOW = 2
DIVISOR = 2
LEAST_LINES = 2
LINE_DIGEST = 16
#: Bytes of a chunk's digest; contents are compared before anything is removed.
CHUNK_DIGEST = 16
#: Shorter chunks (bytes without the line ends) stay: blank lines, rules.
LEAST_BYTES = 32
#: Repeated passages of more words go whole.
PASSAGE_WORDS = 50
_BASE = np.uint64(0x9E3779B97F4A7C15)


def line_spans(offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (without line end) of all lines, and each text's first
    line. A text of n line ends has n + 1 lines."""
    b = np.frombuffer(data, np.uint8)
    breaks = np.flatnonzero(b == 10)
    n = len(offsets) - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    text_s = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    by = np.lexsort((starts, text_s))
    by_end = np.lexsort((ends, text_s))
    first = np.searchsorted(text_s[by], np.arange(n + 1))
    return starts[by], ends[by_end], first


def line_digests(starts: np.ndarray, ends: np.ndarray, data: bytes) -> bytes:
    """LINE_DIGEST bytes for each line."""
    h, view = xxhash.xxh3_128_digest, memoryview(data)
    return b"".join([h(view[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])


def rolling(first: np.ndarray, digests: bytes) -> np.ndarray:
    """Hash of each line and the WINDOW - 1 lines before it in its text."""
    lines = np.frombuffer(digests, np.uint64)[::LINE_DIGEST // 8]
    place = np.arange(len(lines)) - np.repeat(first[:-1], np.diff(first))
    out = lines.copy()
    for back in range(1, WINDOW):
        earlier = np.zeros_like(lines)
        earlier[back:] = lines[:-back]
        out = out * _BASE + np.where(place >= back, earlier, np.uint64(0))
    return out


def chunks(first: np.ndarray, digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First line of each chunk and line after it."""
    cut = ((rolling(first, digests) * _BASE) >> np.uint64(40)) % np.uint64(DIVISOR) == 0
    lo, hi = [], []
    for t in range(len(first) - 1):
        a, z = int(first[t]), int(first[t + 1])
        begin = a
        for c in (np.flatnonzero(cut[a:z]) + a + 1).tolist():
            if c - begin >= LEAST_LINES and (z - c >= LEAST_LINES or c == z):
                lo.append(begin), hi.append(c)
                begin = c
        if begin < z:
            lo.append(begin), hi.append(z)
    return np.array(lo, np.int64), np.array(hi, np.int64)


def word_counts(offsets: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of each line."""
    b = np.frombuffer(data, np.uint8)
    inside = (b != 0x20) & ((b < 0x09) | (b > 0x0D))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(b)]
    begins[at] = inside[at]
    before = np.concatenate([[0], np.cumsum(begins)])
    return before[ends] - before[starts]


def windows(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after of every two neighbouring lines with words."""
    has = np.flatnonzero(n)
    text = np.searchsorted(first, has, "right")
    same = text[1:] == text[:-1]
    return has[:-1][same], has[1:][same] + 1


def passages(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after of the shortest runs of over ``PASSAGE_WORDS``
    words that begin or end with each line that has words."""
    total = np.concatenate([[0], np.cumsum(n)])
    has = np.flatnonzero(n)
    size = np.diff(first)
    text_lo, text_hi = np.repeat(first[:-1], size)[has], np.repeat(first[1:], size)[has]
    on = np.searchsorted(total, total[has] + PASSAGE_WORDS, "right")
    back = np.searchsorted(total, total[has + 1] - PASSAGE_WORDS, "left") - 1
    fits, leads = on <= text_hi, back >= text_lo
    return np.concatenate([has[fits], back[leads]]), np.concatenate([on[fits], has[leads] + 1])


def _spans(offsets: np.ndarray, data: bytes):
    """Line starts, ends and digests, first line of each text, chunks of each text, and
    (text, first line, line after, whether it may repeat within its document) of all
    that may go if it is repeated."""
    starts, ends, first = line_spans(offsets, data)
    digests = line_digests(starts, ends, data)
    n = word_counts(offsets, data, starts, ends)
    c_lo, c_hi = chunks(first, digests)
    n_chunks = np.diff(np.searchsorted(c_lo, first))
    w_lo, w_hi = windows(first, n)
    p_lo, p_hi = passages(first, n)
    lo, hi = np.concatenate([c_lo, p_lo, w_lo]), np.concatenate([c_hi, p_hi, w_hi])
    total = np.concatenate([[0], np.cumsum(n)])
    whole = total[hi] - total[lo] > PASSAGE_WORDS
    ok = (hi - lo >= LEAST_LINES) & (ends[hi - 1] - starts[lo] - (hi - lo - 1) >= LEAST_BYTES)
    ok[len(c_lo):len(c_lo) + len(p_lo)] = True
    keys, at = np.unique(lo[ok] * (len(starts) + 1) + hi[ok], return_inverse=True)
    alone = np.zeros(len(keys), bool)
    np.logical_or.at(alone, at, whole[ok])
    lo, hi = keys // (len(starts) + 1), keys % (len(starts) + 1)
    return starts, ends, digests, first, n_chunks, np.searchsorted(first, lo, "right") - 1, lo, hi, alone


def _key(digests: bytes, lo: int, hi: int) -> bytes:
    return sha256(digests[LINE_DIGEST * lo:LINE_DIGEST * hi]).digest()[:CHUNK_DIGEST]


def _rows(docs: DataFrame) -> DataFrame:
    """One row per text and different chunk in it: doc_id, th, digest, n (times), alone
    (whether it may repeat within its document)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in text_slices(batch.column(2)):
                _, _, digests, _, _, text, lo, hi, alone = _spans(offsets, data)
                seen: dict[tuple[int, bytes], tuple[int, bool]] = {}
                for t, a, z, whole in zip(text.tolist(), lo.tolist(), hi.tolist(), alone.tolist(), strict=True):
                    key = (t, _key(digests, a, z))
                    n, before = seen.get(key, (0, False))
                    seen[key] = (n + 1, before or whole)
                if seen:
                    ids = pa.array([row + t for t, _ in seen], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(ids), batch.column(1).take(ids), pa.array([d for _, d in seen], pa.binary()),
                         pa.array([n for n, _ in seen.values()], pa.int64()), pa.array([x for _, x in seen.values()], pa.bool_())],
                        names=["doc_id", "th", "digest", "n", "alone"])
    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, digest binary, n long, alone boolean")


def _runs(gone: np.ndarray) -> list[tuple[int, int, bool]]:
    """(first, after, gone) of the runs of equal values."""
    at = [0, *(np.flatnonzero(gone[1:] != gone[:-1]) + 1).tolist(), len(gone)]
    return [(a, z, bool(gone[a])) for a, z in zip(at, at[1:])]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_chunks, removed_chunks
    (runs of removed lines), removed (array of first line, from 0, and lines) and
    the text without the removed lines.

    Null texts count as empty (one line, no chunk to remove) and come back
    empty. Rows that repeat an id count as one document: each keeps the first
    occurrence of a chunk that the id owns, and what overlaps that occurrence is
    no second one. A chunk found only under null ids stays where it is;
    otherwise null ids are the last to own a chunk. Every removed line stays
    where its first copy stands. An empty table gives no rows."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("th", F.hash("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("long"))
    # ``th`` keeps apart rows that share an id. Texts that share both get each other's
    # digests too, of which each uses only those found in it: 31 bits do.
    # Equal chunks of a task meet before the shuffle.
    repeated = write_once(
        _rows(base).groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.sum("n").alias("n"),
                                          F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.bool_or("alone").alias("alone"))
        .where("owner is not null and (owner < last or nulls > 0 or (alone and n > 1))").select("digest", "owner"), "line-chunks")
    found = _rows(base).join(repeated, "digest") \
        .groupBy("doc_id", "th").agg(F.collect_set(F.struct("digest", (F.col("owner").eqNullSafe(F.col("doc_id"))).alias("own"))).alias("cut"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "cut")
    paired = base.join(found, base["doc_id"].eqNullSafe(found["_id"]) & (base["th"] == found["_th"]), "left").select("doc_id", "cut", "text")
    clashing: set[bytes] = set()
    while True:
        done = write_once(_removed(paired, frozenset(clashing)), "line-dedup", "zstd")
        proof = done.select(F.explode("proof").alias("p")).groupBy("p.key").agg(F.min("p.content").alias("a"), F.max("p.content").alias("b"))
        # One row for each collision of a digest over the whole corpus.
        new = {bytes(r["key"]) for r in proof.where("a <> b").select("key").collect()}
        if not new - clashing:
            return done.drop("proof")
        clashing |= new


def _removed(paired: DataFrame, clashing: frozenset[bytes]) -> DataFrame:
    """The result rows, and as ``proof`` the digests and contents of the repeated chunks
    and lines of each text. What holds a digest of ``clashing`` stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in text_slices(batch.column(2)):
                n = len(offsets) - 1
                cuts = batch.column(1).slice(row, n).to_pylist()
                starts, ends, digests, first, n_chunks, text, lo, hi, alone = _spans(offsets, data)
                of_text = np.searchsorted(text, np.arange(n + 1))
                out, removed, proofs = [], [], []
                for t in range(n):
                    own = {x["digest"]: x["own"] for x in cuts[t] or ()}
                    a = int(first[t])
                    gone, kept_till = np.zeros(int(first[t + 1]) - a, bool), {}
                    proof: dict[bytes, bytes] = {}
                    for k in range(int(of_text[t]), int(of_text[t + 1])) if own else ():
                        b, z = int(lo[k]), int(hi[k])
                        d = _key(digests, b, z)
                        if d not in own:
                            continue
                        lines = [digests[LINE_DIGEST * i:LINE_DIGEST * (i + 1)] for i in range(b, z)]
                        if clashing and (d in clashing or not clashing.isdisjoint(lines)):
                            continue
                        proof[d] = digests[LINE_DIGEST * b:LINE_DIGEST * z]
                        for i, x in enumerate(lines, b):
                            if x not in proof:
                                proof[x] = data[starts[i]:ends[i]]
                        if not own[d] or (alone[k] and b >= kept_till.setdefault(d, z)):
                            gone[b - a:z - a] = True
                    runs = _runs(gone)
                    out.append(b"\n".join(data[starts[a + b]:ends[a + z - 1]] for b, z, g in runs if not g))
                    removed.append([{"line": b, "lines": z - b} for b, z, g in runs if g])
                    proofs.append([{"key": x, "content": y} for x, y in proof.items()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(np.diff(first)), pa.array(n_chunks), pa.array([len(g) for g in removed], pa.int64()),
                     pa.array(removed, pa.list_(pa.struct([("line", pa.int64()), ("lines", pa.int64())]))),
                     pa.array(out, pa.binary()).cast(pa.string()), pa.array(proofs, pa.list_(pa.struct([("key", pa.binary()), ("content", pa.binary())])))],
                    names=["doc_id", "n_lines", "n_chunks", "removed_chunks", "removed", "text", "proof"])

    return paired.mapInArrow(run, "doc_id long, n_lines long, n_chunks long, removed_chunks long, removed array<struct<line: long, lines: long>>, "
                                  "text string, proof array<struct<key: binary, content: binary>>")
