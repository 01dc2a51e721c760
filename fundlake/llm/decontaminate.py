"""Benchmark decontamination as a prefix-filtered set join on word windows.

A benchmark item gives windows of ``WINDOW`` consecutive words (one shorter
window if it has fewer). The words of a window are ordered by rarity in the
documents; since all of a window must be contained, its necessary prefix is the
one rarest word. A document word equal to it is a candidate: the window must
then begin ``offset`` words before it, inside the same document (positional and
length bounds), and is verified word by word.

The windows are a stated query set. They are cut into blocks of at most
``BLOCK_WINDOWS``, written as files in the shared folder, and every task runs
groups of about ``GROUP_BYTES`` of its texts against one block after the other.
A group's words are numbered and their places listed once, so a block costs its
loading, once a group, and work by the candidates that it has there. Nothing is
broadcast, texts are not shuffled, and a hot passage costs no more than its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.common import BY_ALNUM, Words, open_store, ranges, text_slices, work_path

WINDOW = 10
BLOCK_WINDOWS = 200_000
BLOCK_WORDS = 1_000_000
#: Text bytes that one reading of a block serves; a longer text is a group of its own.
GROUP_BYTES = 12 << 20
#: Candidates verified at once.
CANDIDATES = 1 << 20


class Coded:
    """A run of texts as word numbers, with the places of each word."""

    def __init__(self, rows: pa.Array | None, offsets: np.ndarray, data: bytes):
        w = Words(offsets, data, BY_ALNUM)
        codes, self.words = w.coded()
        self.rows, self.doc_first = rows, w.doc_first
        # Numpy sorts 16-bit numbers by radix.
        self.codes = codes.astype(np.uint16 if len(self.words) <= 1 << 16 else np.int32)
        self.counts = np.bincount(self.codes, minlength=len(self.words))
        self.number = np.zeros(0, np.int64)  # of each word in its group

    def places(self, words: np.ndarray) -> np.ndarray:
        """Where the given words stand, word after word."""
        order = self._order
        return order[ranges(self._first[words], self.counts[words])]

    @cached_property
    def _order(self) -> np.ndarray:
        return np.argsort(self.codes, kind="stable").astype(np.int32)

    @cached_property
    def _first(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def _groups(batches: Iterator[pa.RecordBatch], texts: Callable[[pa.RecordBatch], pa.Array],
            rows: int | None = None) -> Iterator[tuple[list[Coded], pa.Array]]:
    """Runs of texts of about GROUP_BYTES together, and their distinct words. The taker
    empties the list when it is done, so that one group is held at a time."""
    def numbered(runs: list[Coded]) -> tuple[list[Coded], pa.Array]:
        d = pa.concat_arrays([r.words for r in runs]).dictionary_encode()
        numbers = np.split(d.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([len(r.words) for r in runs])[:-1])
        for r, n in zip(runs, numbers, strict=True):
            r.number = n
        return runs, d.dictionary

    held, size = [], 0
    for batch in batches:
        for at, offsets, data in text_slices(texts(batch)):
            held.append(Coded(None if rows is None else batch.column(rows).slice(at, len(offsets) - 1), offsets, data))
            size += len(data)
            if size >= GROUP_BYTES:
                yield numbered(held)
                held, size = [], 0
    if held:
        yield numbered(held)


def windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item string, words array<binary>): every window of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                w = Words(offsets, data, BY_ALNUM)
                counts = np.diff(w.doc_first)
                n = np.where(counts >= window, counts - window + 1, (counts > 0).astype(np.int64))
                first = ranges(w.doc_first[:-1], n)
                size = np.repeat(np.minimum(counts, window), n)
                item = np.repeat(np.arange(len(counts)) + at, n)
                for lo in range(0, len(first), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    flat = w.strings().cast(pa.binary()).take(pa.array(ranges(first[part], size[part])))
                    ends = np.concatenate([[0], np.cumsum(size[part])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(item[part])), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["item", "words"])
    return benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")) \
        .mapInArrow(run, "item string, words array<binary>")


def _files(df: DataFrame, name: str) -> list[str]:
    """Write ``df`` to the shared folder, one file a partition."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return sorted(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())


def _load(path: str) -> pa.Table:
    fs, p = open_store(path)
    with fs.open_input_file(p) as f:
        return pq.read_table(f)


@lru_cache(maxsize=2)
def _word_block(path: str) -> tuple[pa.Array, np.ndarray]:
    t = _load(path).combine_chunks()
    if not t.num_rows:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    words = t.column("word").combine_chunks().cast(pa.large_binary())
    return words, t.column("n").combine_chunks().to_numpy(zero_copy_only=False)


def word_counts(docs: DataFrame, text_col: str, vocabulary: DataFrame) -> DataFrame:
    """(word, n): occurrences in all texts of each word of ``vocabulary``."""
    n = vocabulary.count()
    files = _files(vocabulary.select("word", F.lit(0).cast("long").alias("n")).repartition(max(1, -(-n // BLOCK_WORDS)), "word"), "vocabulary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, words in _groups(batches, lambda batch: batch.column(0)):
            seen = np.zeros(len(words), np.int64)
            for r in runs:
                seen[r.number] += r.counts
            for path in files:
                here = pc.is_valid(pc.index_in(words, value_set=_word_block(path)[0]))
                yield pa.RecordBatch.from_arrays([words.filter(here).cast(pa.binary()), pa.array(seen).filter(here)], names=["word", "n"])
            runs.clear()

    seen = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word binary, n long")
    return vocabulary.select("word", F.lit(0).cast("long").alias("n")).union(seen).groupBy("word").agg(F.sum("n").alias("n"))


class Block:
    """One block of windows, ready for search: the words as numbers, and for
    each word the windows that it anchors."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        lists = t.column("words").combine_chunks() if t.num_rows else pa.array([], pa.list_(pa.binary()))
        flat = lists.flatten().cast(pa.large_binary()).dictionary_encode()
        self.vocabulary = flat.dictionary
        codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.words = codes
        self.offset = t.column("anchor").to_numpy().astype(np.int64) if t.num_rows else np.zeros(0, np.int64)
        items = t.column("item").combine_chunks() if t.num_rows else pa.array([], pa.string())
        enc = items.dictionary_encode()
        self.item = pc.fill_null(enc.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.items = enc.dictionary.to_pylist()
        anchor = codes[self.first + self.offset] if len(self.size) else codes
        self.by_anchor = np.argsort(anchor, kind="stable")
        self.anchored = np.append(np.bincount(anchor, minlength=len(self.vocabulary)), 0)  # the last: unknown words
        self.anchor_first = np.cumsum(self.anchored) - self.anchored

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The block's number of each word; one past the last for unknown words."""
        return pc.fill_null(pc.index_in(words, value_set=self.vocabulary), len(self.vocabulary)).to_numpy(zero_copy_only=False)

    def occurrences(self, run: Coded, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, first word, window) of every occurrence. ``known``: the
        block's number of each word of the run."""
        hot = np.flatnonzero(self.anchored[known])
        at = run.places(hot) if len(hot) else hot
        anchor = np.repeat(known[hot], run.counts[hot])
        counts = self.anchored[anchor]
        ends = np.cumsum(counts)
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, "right")))
            c = counts[lo:hi]
            win = self.by_anchor[ranges(self.anchor_first[anchor[lo:hi]], c)]
            pos = np.repeat(at[lo:hi], c).astype(np.int64)
            lo = hi
            doc = np.searchsorted(run.doc_first, pos, "right") - 1
            begin = pos - self.offset[win]
            ok = (begin >= run.doc_first[doc]) & (begin + self.size[win] <= run.doc_first[doc + 1])
            doc, begin, win = doc[ok], begin[ok], win[ok]
            for j in range(int(self.size[win].max()) if len(win) else 0):
                short = self.size[win] <= j
                step = np.where(short, 0, j)
                ok = short | (known[run.codes[begin + step]] == self.words[self.first[win] + step])
                doc, begin, win = doc[ok], begin[ok], win[ok]
            if len(win):
                yield doc, begin, win


@lru_cache(maxsize=2)
def _block(path: str) -> Block:
    return Block(_load(path))


def index_blocks(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 docs_text: str = "text", window: int = WINDOW) -> list[str]:
    """The window files. Each row: item, words, anchor (place of the rarest word)."""
    spark = docs.sparkSession
    wins = windows(benchmark, id_col, text_col, window).distinct()
    vocabulary = wins.select(F.explode("words").alias("word")).distinct()
    counts = word_counts(docs, docs_text, vocabulary)
    n_words = vocabulary.count()
    count_files = _files(counts.repartition(max(1, -(-n_words // BLOCK_WORDS)), "word"), "word-counts")

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().cast(pa.large_binary())
            seen = np.zeros(len(flat), np.int64)
            for path in count_files:
                words, n = _word_block(path)
                place = pc.index_in(flat, value_set=words)
                here = pc.is_valid(place).to_numpy(zero_copy_only=False)
                seen[here] = n[place.drop_null().to_numpy(zero_copy_only=False)]
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            win = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((np.arange(len(flat)), seen, win))
            first = np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array((order[first] - first).astype(np.int32))], names=["item", "words", "anchor"])

    n = wins.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    anchored = wins.mapInArrow(anchor, "item string, words array<binary>, anchor int")
    return _files(anchored.repartition(blocks, "words") if blocks > 1 else anchored.coalesce(1), "windows")


def decontaminate(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the carried columns), ``n_words``,
    ``n_hit`` (words inside an occurrence of a window), ``n_items`` and
    ``items_sha256`` (of the item ids with an occurrence, sorted as strings and
    joined by commas) and ``contaminated``.

    Null and empty texts have no words; items without words have no windows. A
    null item id hits words but is no item. Repeated documents give equal rows;
    repeated items count once. With no items nothing is contaminated."""
    files = index_blocks(docs, benchmark, item_col, item_text, text_col, window)

    fields = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(text_col).cast("string").alias("text"))
    # Carried texts travel once.
    inside = carry.index(text_col) if text_col in carry and docs.schema[text_col].dataType == T.StringType() else None
    if inside is not None:
        given = given.select("row")
    schema = T.StructType([given.schema["row"], *T.StructType.fromDDL(fields).fields])
    none = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, words in _groups(batches, lambda batch: batch.column(1) if inside is None else batch.column(0).field(inside), 0):
            edges = [np.zeros(len(r.codes) + 1, np.int32) for r in runs]
            items: list[dict[int, set[str]]] = [{} for _ in runs]
            for path in files:
                block = _block(path)
                known = block.numbers(words)
                for r, edge, found in zip(runs, edges, items, strict=True):
                    for doc, begin, win in block.occurrences(r, known[r.number]):
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, begin + block.size[win], -1)
                        named = block.item[win] >= 0
                        pairs = np.unique(doc[named] * (len(block.items) + 1) + block.item[win[named]])
                        for d, k in zip(*(x.tolist() for x in np.divmod(pairs, len(block.items) + 1)), strict=True):
                            found.setdefault(d, set()).add(block.items[k])
            for r, edge, found in zip(runs, edges, items, strict=True):
                hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
                n_hit = hit[r.doc_first[1:]] - hit[r.doc_first[:-1]]
                n = len(r.rows)
                yield pa.RecordBatch.from_arrays([
                    r.rows, pa.array(np.diff(r.doc_first)), pa.array(n_hit), pa.array([len(found.get(d, ())) for d in range(n)], pa.int64()),
                    pa.array([hashlib.sha256(",".join(sorted(found[d])).encode()).hexdigest() if d in found else none for d in range(n)]),
                    pa.array(n_hit > 0)], names=schema.names)
            runs.clear(), edges.clear(), items.clear()

    return given.mapInArrow(run, schema)
