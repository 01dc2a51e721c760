"""Token ids as fixed-width bit-packed files.

File layout (little-endian numbers)::

    header   "TOKBITS1", bits u32, ids per block u32
    blocks   ids of ``bits`` bits each, most significant bit first; a block
             begins on a byte and holds ``ids per block`` ids (the last fewer)
    index    byte offset of each block (u64), then per document: id (i64),
             first id in the file (u64), 1 if the id is null (u8)
    trailer  index offset u64, blocks u64, documents u64, ids u64, "TOKBITS1"

Any id is at a computed bit of a block at a stored offset, so documents are
read by range, and blocks unpack as whole numpy arrays. One partition writes
one file of a name of its own; only files in the manifest, which Spark commits
after the task, count. Lost or repeated tasks leave files that nothing reads.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Words, open_store, partitions_for, ranges, text_slices, work_path, write_once

MAGIC = b"TOKBITS1"
BLOCK_IDS = 1 << 16
#: Words whose ids a worker remembers, and the longest of them in bytes.
CACHE_WORDS, CACHE_BYTES = 250_000, 64
#: Ids read and unpacked at once.
READ_BLOCKS = 16
#: Texts are cut at these bytes before encoding. The tokenizer splits at white
#: space and drops it, so the pieces encode as the whole text does.
_CUT = bytes(0x20 if c in b" \n" else c for c in range(256))


def id_bits(vocabulary: int) -> int:
    """The fewest bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each; a wider id raises."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} does not fit in {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits:].ravel()).tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits:] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


#: Text that a tokenizer must encode as the sum of its pieces, for texts to be cut.
_SAMPLE = "The Quick brown fox, jumps.  Éte ÀB, x1. (a.b) don't\tstop\n\n  End-of line, 3.5. für Straße. 日本 語, \U0001f600 ok."
#: Stands between pieces that are encoded together (a private-use character).
_MARK = "\ue000"


class _Encoder:
    """The tokenizer and the ids of the words met lately, in two generations:
    a full younger one becomes the older, and words met again move back."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._ids(_MARK)
        self.cuts = self._cuts_agree()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _cuts_agree(self) -> bool:
        """Whether the tokenizer cuts a sample where ``_pieces`` does, lower-cases as it
        does, and keeps marks apart; else texts are encoded whole."""
        data = _SAMPLE.encode()
        w = _pieces(np.array([0, len(data)]), data)
        pieces = [w.data[a:z] for a, z in zip(w.starts.tolist(), w.ends.tolist(), strict=True)]
        apart = [self._ids(p.decode("utf-8", "replace")) for p in pieces]
        return bool(len(self.mark)) and np.array_equal(np.concatenate(apart), self._ids(_SAMPLE)) \
            and b"".join(self._together(pieces)) == b"".join(x.tobytes() for x in apart)

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, encoded as one text with marks between them. The
        mark's ids decode to the mark alone, so pieces without it cannot hold them."""
        ids = self._ids(f"\n{_MARK}\n".join([p.decode("utf-8", "replace") for p in pieces]))
        k = len(self.mark)
        at = np.flatnonzero(np.logical_and.reduce([ids[j:len(ids) - k + 1 + j] == self.mark[j] for j in range(k)])) if len(ids) >= k else ids[:0]
        raw = ids.tobytes()
        ends = [*(4 * at).tolist(), len(raw)]
        begins = [0, *(4 * (at + k)).tolist()]
        return [raw[x:y] for x, y in zip(begins, ends, strict=True)]

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian bytes."""
        young, old = self.young, self.old
        got = [young.get(p) for p in pieces]
        new = []
        for k, x in enumerate(got):
            if x is None:
                p = pieces[k]
                if (x := old.get(p)) is None:
                    new.append(k)
                else:
                    got[k] = young[p] = x
        odd = [k for k in new if b"\xee\x80\x80" in pieces[k]]
        for k in odd:
            got[k] = self._ids(pieces[k].decode("utf-8", "replace")).tobytes()
        new = [k for k in new if got[k] is None]
        for lo in range(0, len(new), 2048):
            part = new[lo:lo + 2048]
            for k, x in zip(part, self._together([pieces[k] for k in part]), strict=True):
                got[k] = x
                if len(pieces[k]) <= CACHE_BYTES:
                    young[pieces[k]] = x
        if len(young) > CACHE_WORDS:
            self.young, self.old = {}, young
        return got


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _pieces(offsets: np.ndarray, data: bytes) -> Words:
    """The texts cut at spaces and line ends, and before a full stop or comma
    that ends a piece after an ASCII letter: the tokenizer cuts there as well.
    It also lower-cases, so ASCII capitals are lowered first, except before a
    non-ASCII byte (which might combine) and beside marks of special tokens."""
    b = np.frombuffer(data, np.uint8)
    if b"<|" not in data and len(b):
        upper = (b >= 65) & (b <= 90)
        upper[:-1] &= b[1:] < 128
        data = (b + (upper.view(np.uint8) << 5)).astype(np.uint8).tobytes()
    w = Words(offsets, data, _CUT)
    b = np.frombuffer(w.data, np.uint8)
    last, prior = b[w.ends - 1], b[np.maximum(w.ends - 2, 0)] | 32
    at = np.flatnonzero((w.ends - w.starts > 1) & ((last == 46) | (last == 44)) & (prior >= 97) & (prior <= 122))
    stops = w.ends[at] - 1
    w.starts = np.insert(w.starts, at + 1, stops)
    w.ends = np.insert(w.ends, at, stops)
    w.doc_first = np.searchsorted(w.starts, offsets, "left")
    return w


def encode(offsets: np.ndarray, data: bytes, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each), ``end_id`` after each text.
    Each distinct piece between spaces is encoded once."""
    encoder = _encoder(path)
    if not encoder.cuts:
        each = [encoder._ids(data[a:z].decode("utf-8", "replace")) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return np.concatenate([np.append(x, end_id) for x in each]).astype("<u4"), np.array([len(x) + 1 for x in each], np.int64)
    w = _pieces(offsets, data)
    codes, words = w.coded()
    got = encoder(words.to_pylist())
    size = np.array([len(x) for x in got], np.int64) >> 2
    flat = np.frombuffer(b"".join(got), "<u4")
    first = np.cumsum(size) - size
    counts = size[codes]
    ids = flat[ranges(first[codes], counts)]
    ends = np.concatenate([[0], np.cumsum(counts)])[w.doc_first]
    return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


class TokenFile:
    """Random access to one packed file."""

    def __init__(self, uri: str):
        fs, path = open_store(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        tail = struct.Struct("<QQQQ8s")
        self.f.seek(size - tail.size)
        index, blocks, docs, self.n_ids, magic = tail.unpack(self.f.read(tail.size))
        self.f.seek(0)
        head, self.bits, self.block_ids = struct.unpack("<8sII", self.f.read(16))
        if magic != MAGIC or head != MAGIC:
            raise ValueError(f"not a packed token file: {uri}")
        self.f.seek(index)
        raw = self.f.read(size - tail.size - index)
        self.blocks = np.frombuffer(raw, "<u8", blocks)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, blocks * 8)
        self.starts = np.append(np.frombuffer(raw, "<u8", docs, blocks * 8 + docs * 8), np.uint64(self.n_ids)).astype(np.int64)
        self.null = np.frombuffer(raw, np.uint8, docs, blocks * 8 + docs * 16).astype(bool)

    def read(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the file."""
        if hi <= lo:
            return np.zeros(0, "<u4")
        a, b = lo // self.block_ids, -(-hi // self.block_ids)
        n = min(b * self.block_ids, self.n_ids) - a * self.block_ids
        self.f.seek(int(self.blocks[a]))
        got = unpack(self.f.read(-(-n * self.bits // 8)), n, self.bits)
        return got[lo - a * self.block_ids:hi - a * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def write_tokens(docs: DataFrame, tokenizer: str, vocabulary: int | None, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None, partitions: int | None = None) -> DataFrame:
    """Encode all texts and write them in ascending id order (null ids first;
    rows of one id by a hash of their text). Null texts are empty; every text
    ends with ``end_id``. The ids' width is that of ``vocabulary``, or of the tokenizer's
    own where that is None; an id that is wider raises. Returns the manifest: part, path, n_docs, n_ids, and
    start, the ids of all parts before. An empty table gives no files."""
    spark = docs.sparkSession
    folder = folder or work_path(spark, "tokens")
    fs, path = open_store(folder)
    fs.create_dir(path, recursive=True)
    if vocabulary is None:
        vocabulary = _encoder(tokenizer).tokenizer.get_vocab_size()
    bits = id_bits(vocabulary)
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    arranged = ordered.repartitionByRange(partitions or partitions_for(spark), *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out, uri = None, f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tokens"
        blocks, ids, sizes, waiting, n_ids, at = [], [], [], np.zeros(0, "<u4"), 0, 16
        for batch in batches:
            for row, offsets, data in text_slices(batch.column(1)):
                if out is None:
                    fs, path = open_store(uri)
                    out = fs.open_output_stream(path)
                    out.write(struct.pack("<8sII", MAGIC, bits, BLOCK_IDS))
                got, counts = encode(offsets, data, tokenizer, end_id)
                ids.append(batch.column(0).slice(row, len(counts)))
                sizes.append(counts)
                n_ids += len(got)
                waiting = np.concatenate([waiting, got])
                full = len(waiting) // BLOCK_IDS * BLOCK_IDS
                for lo in range(0, full, BLOCK_IDS):
                    raw = pack(waiting[lo:lo + BLOCK_IDS], bits)
                    blocks.append(at)
                    at += out.write(raw) or len(raw)
                waiting = waiting[full:]
        if out is None:
            return
        if len(waiting):
            blocks.append(at)
            raw = pack(waiting, bits)
            at += out.write(raw) or len(raw)
        all_ids = pa.chunked_array(ids)
        size = np.concatenate(sizes)
        out.write(np.array(blocks, "<u8").tobytes())
        out.write(all_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
        out.write((np.cumsum(size) - size).astype("<u8").tobytes())
        out.write(np.asarray(all_ids.is_null()).astype(np.uint8).tobytes())
        out.write(struct.pack("<QQQQ8s", at, len(blocks), len(size), n_ids, MAGIC))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([uri]), pa.array([len(size)]), pa.array([n_ids])],
                                         names=["part", "path", "n_docs", "n_ids"])

    parts = write_once(arranged.mapInArrow(run, "part int, path string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return parts.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from
    the files of ``manifest``; start counts the ids of all documents before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t = TokenFile(uri)
                n = len(t.doc_ids)
                crc = np.zeros(n, np.int64)
                step = t.block_ids * READ_BLOCKS
                for lo in range(0, t.n_ids, step):
                    hi = min(t.n_ids, lo + step)
                    raw = memoryview(t.read(lo, hi).astype("<u4").tobytes())
                    a, b = int(np.searchsorted(t.starts, lo, "right")) - 1, int(np.searchsorted(t.starts, hi, "left"))
                    s, e = np.maximum(t.starts[a:b], lo) - lo, np.minimum(t.starts[a + 1:b + 1], hi) - lo
                    for k, x, y in zip(range(a, b), (4 * s).tolist(), (4 * e).tolist(), strict=True):
                        crc[k] = zlib.crc32(raw[x:y], int(crc[k]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.doc_ids, mask=t.null), pa.array(t.starts[:-1] + base), pa.array(np.diff(t.starts)), pa.array(crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = partitions or partitions_for(manifest.sparkSession)
    return manifest.select("path", "start").repartition(n, "path") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
