"""Fill-in-the-middle examples through piece tables.

A document becomes a list of descriptors (buffer, start, length) over two
buffers that never change: its UTF-8 text and the sentinels. A cut splits the
descriptor it falls into, an arrangement permutes the descriptors and puts
sentinel descriptors between them, and the inverse permutation restores the
document. Text is copied once, when an example is written; hashes read the
descriptors one after the other.

Where a document is cut, and its form, come from a hash of its id alone, so
reruns and lost executors change nothing. Every document is one row of narrow
work: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.common import text_slices

TEXT, SENTINEL = 0, 1
#: The sentinels of prefix, suffix and middle, one buffer. Fixed values of the format.
SENTINELS = b"<P><S><M>"
MARKS = {"P": (SENTINEL, 0, 3), "S": (SENTINEL, 3, 3), "M": (SENTINEL, 6, 3)}
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
#: The order in which a form writes the three pieces of a document: 0 prefix, 1 middle, 2 suffix.
ARRANGED = {"psm": ("P", 0, "S", 2, "M", 1), "spm": ("S", 2, "P", 0, "M", 1)}

Piece = tuple[int, int, int]


class PieceTable:
    """Descriptors over a text and the sentinel buffer."""

    def __init__(self, text: bytes | memoryview, pieces: Sequence[Piece] | None = None):
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.pieces: list[Piece] = [(TEXT, 0, len(text))] if pieces is None else list(pieces)

    def cut(self, at: int) -> None:
        """Split the descriptor that covers byte ``at`` of the table's content. A
        cut at the end of a descriptor leaves an empty one after it."""
        for k, (buffer, start, length) in enumerate(self.pieces):
            if at <= length:
                self.pieces[k:k + 1] = [(buffer, start, at), (buffer, start + at, length - at)]
                return
            at -= length
        raise ValueError("cut beyond the end")

    def arrange(self, order: Sequence[str | int]) -> None:
        """Take the descriptors in another order, with sentinels where it names them."""
        self.pieces = [MARKS[x] if isinstance(x, str) else self.pieces[x] for x in order]

    def invert(self, order: Sequence[str | int]) -> None:
        """Undo ``arrange(order)``: sentinels go, the others return to their places."""
        places = {x: k for k, x in enumerate(order) if not isinstance(x, str)}
        self.pieces = [self.pieces[places[k]] for k in range(len(places))]

    def views(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def content(self) -> bytes:
        return b"".join(self.views())

    def sha256(self) -> str:
        h = hashlib.sha256()
        for view in self.views():
            h.update(view)
        return h.hexdigest()


def arranged(text: bytes | memoryview, first: int, second: int, form: str) -> PieceTable:
    """The table of one document, cut at two byte positions and put into ``form``."""
    table = PieceTable(text)
    if form != "plain":
        table.cut(first)
        table.cut(second)
        table.arrange(ARRANGED[form])
    return table


def parsed(output: bytes, form: str) -> PieceTable:
    """The document's table again, from an example and its form: the sentinels are
    found in order, and the inverse permutation puts the pieces back. A sentinel
    holds '<' at its start only, so text before one cannot make up an earlier one."""
    if form == "plain":
        return PieceTable(output)
    order = ARRANGED[form]
    marks = [SENTINELS[MARKS[x][1]:MARKS[x][1] + 3] for x in order[::2]]
    at = [0]
    for mark in marks[1:]:
        at.append(output.index(mark, at[-1] + 3))
    ends = [*at[1:], len(output)]
    pieces: list[Piece] = []
    for x, begin, end in zip(order[::2], at, ends, strict=True):
        pieces += [MARKS[x], (TEXT, begin + 3, end - begin - 3)]
    table = PieceTable(output, pieces)
    table.invert(order)
    return table


def _units(offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts of the units ``[A-Za-z]+|[^A-Za-z]`` (a unit per other code
    point), the first unit of each text, and the code points before each byte."""
    b = np.frombuffer(data, np.uint8)
    folded = b | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A) & (b < 0x80)
    point = (b & 0xC0) != 0x80
    inner = np.zeros(len(b), bool)
    inner[1:] = letter[1:] & letter[:-1]
    begins = offsets[:-1]
    inner[begins[begins < len(b)]] = False
    starts = np.flatnonzero(point & ~inner)
    return starts, np.searchsorted(starts, offsets, "left"), np.concatenate([[0], np.cumsum(point)])


def _draws(doc_id: int | None, salt: str) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))


FIELDS = "n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer:int,start:long,length:long>>, output string, output_sha256 string"


def fill_in_middle(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", salt: str = "1",
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """One fill-in-the-middle example per row: ``row`` (the carried columns as a
    struct, so that no name can clash), ``n`` units, ``form`` (plain, psm, spm),
    code points of prefix and middle (null if plain), the descriptors ``pieces``,
    the example itself as ``output``, and its SHA-256.

    Null texts count as empty; an empty text, and one that holds a sentinel, is
    plain. A null id draws as an empty string. Repeated rows give equal rows, an
    empty table none. Whole texts are used, however long."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(text_col).cast("string").alias("text"),
                        F.col(id_col).cast("long").alias("id"))
    extra = T.StructType.fromDDL(FIELDS)
    pieces_type = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                count = len(offsets) - 1
                starts, first_unit, points = _units(offsets, data)
                whole = memoryview(data)
                cols: list[list] = [[] for _ in extra.fields]
                for k, doc_id in enumerate(batch.column(2).slice(at, count).to_pylist()):
                    begin, end = int(offsets[k]), int(offsets[k + 1])
                    n = int(first_unit[k + 1] - first_unit[k])
                    h1, h2, h3, h4 = _draws(doc_id, salt)
                    plain = begin == end or h3 % 100 >= plain_from or any(data.find(SENTINELS[s:s + 3], begin, end) >= 0 for s in (0, 3, 6))
                    form = "plain" if plain else "spm" if h4 % 100 < spm_below else "psm"
                    low, high = (int(starts[first_unit[k] + u]) if u < n else end for u in sorted((h1 % (n + 1), h2 % (n + 1))))
                    table = arranged(whole[begin:end], low - begin, high - begin, form)
                    sizes = (None, None) if plain else (int(points[low] - points[begin]), int(points[high] - points[low]))
                    pieces = [dict(zip(("buffer", "start", "length"), p, strict=True)) for p in table.pieces]
                    for col, value in zip(cols, (n, form, *sizes, pieces, table.content(), table.sha256()), strict=True):
                        col.append(value)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pieces_type, pa.binary(), pa.string())
                arrays = [pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)]
                arrays[5] = arrays[5].cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, count), *arrays], names=["row", *extra.names])

    return given.mapInArrow(run, T.StructType([given.schema["row"], *extra.fields]))


def restore(examples: DataFrame, carry: list[str], output_col: str = "output", form_col: str = "form") -> DataFrame:
    """The documents again, from examples and their forms alone: ``row`` (the carried
    columns), ``restored`` and ``restored_sha256``. A null form or output counts as
    plain or empty; an example that lacks a sentinel of its form raises."""
    given = examples.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(output_col).cast("string").alias("text"),
                            F.coalesce(F.col(form_col), F.lit("plain")).alias("form"))
    schema = T.StructType([given.schema["row"], *T.StructType.fromDDL("restored string, restored_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                count = len(offsets) - 1
                forms = batch.column(2).slice(at, count).to_pylist()
                tables = [parsed(data[s:e], form) for s, e, form in zip(offsets[:-1].tolist(), offsets[1:].tolist(), forms, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, count), pa.array([t.content() for t in tables], pa.binary()).cast(pa.string()),
                     pa.array([t.sha256() for t in tables], pa.string())], names=schema.names)

    return given.mapInArrow(run, schema)
