"""Quality classifier: ordinal cumulative-link regression on graded ratings.

With grades 0 < 1 < ... < K-1, a text x has P(grade > k) = sigmoid(w.x - t_k):
one vector of weights over hashed text features, shared by all grades, and
ordered thresholds t_0 < t_1 < ... The sum of these tails is the expected grade;
the last tail is the probability of the best grade. Both select documents.

Features: the distinct words of a text (ASCII letters lower-cased) and the
distinct shapes of its space-separated tokens (letter case, digits, marks), by
hash into ``FEATURES`` slots. Words give 1 each, whatever the text's length, so
a few telling words weigh as much in a long text; shapes, and tokens that repeat
the one before, give their share of the tokens in steps.

The fit uses at most ``TRAIN_ROWS`` labelled rows, those of least hashed id; the
scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import BY_ALNUM, BY_SPACE, Words, map_texts, text_slices

FEATURES = 1 << 18
#: The first slots are for style (shapes, repeats), which is not shrunk by L2.
STYLE = 1 << 12
TRAIN_ROWS = 20_000
#: Features seen in fewer training rows get no weight.
LEAST_ROWS = 6
EPOCHS, RATE, L2 = 40, 0.04, 3e-4
#: Small samples get more epochs, up to so many steps.
BATCH, LEAST_STEPS = 512, 600
SEED = 11
#: Shares of tokens at which a shape counts once more.
SHARES = (0.03, 0.1, 0.2, 0.4, 0.7)

_SHAPE = bytearray(b"#" * 128 + b"a" * 128)
for _c in range(128):
    if 0x61 <= _c <= 0x7A:
        _SHAPE[_c] = ord("a")
    elif 0x41 <= _c <= 0x5A:
        _SHAPE[_c] = ord("A")
    elif 0x30 <= _c <= 0x39:
        _SHAPE[_c] = ord("9")
    elif _c == 0x20 or 0x09 <= _c <= 0x0D:
        _SHAPE[_c] = 0x20
    elif _c in b".,;:'\"-()?":
        _SHAPE[_c] = _c
_SHAPE = bytes(_SHAPE)


def _slots(words: list[bytes], low: int, high: int, seed: int) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.array([low + h(x, seed) % (high - low) for x in words], np.int64)


def _collapse(shape: bytes) -> bytes:
    return bytes(c for i, c in enumerate(shape[:32]) if not i or shape[i - 1] != c)


def features(offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) pairs, ordered, each once."""
    n = len(offsets) - 1
    w = Words(offsets, data, BY_ALNUM)
    codes, words = w.coded()
    doc = np.repeat(np.arange(n), np.diff(w.doc_first))
    pairs = [doc * FEATURES + _slots(words.to_pylist(), STYLE, FEATURES, 1)[codes]] if len(codes) else []
    s = Words(offsets, data, _SHAPE)
    codes, shapes = s.coded()
    if len(codes):
        names = [_collapse(x) for x in shapes.to_pylist()]
        kinds = {x: i for i, x in enumerate(dict.fromkeys(names))}
        of = np.array([kinds[x] for x in names], np.int64)
        tokens = np.diff(s.doc_first)
        of_doc = np.repeat(np.arange(n), tokens)
        key, seen = np.unique(of_doc * len(kinds) + of[codes], return_counts=True)
        d, k = np.divmod(key, len(kinds))
        whole = Words(offsets, data, BY_SPACE).coded()[0]  # the same tokens, by their text
        again = np.bincount(of_doc[1:][(whole[1:] == whole[:-1]) & (of_doc[1:] == of_doc[:-1])], minlength=n)
        for step, share in enumerate(SHARES):
            ok = seen >= share * tokens[d]
            pairs.append(d[ok] * FEATURES + _slots(list(kinds), len(SHARES), STYLE, 2 + step)[k[ok]])
            ok = np.flatnonzero((again >= share * tokens) & (tokens > 1))
            pairs.append(ok * FEATURES + step)
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.divmod(np.unique(np.concatenate(pairs)), FEATURES)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class OrdinalModel:
    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    def tails(self, n: int, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and k."""
        score = np.bincount(doc, self.weights[slot], minlength=n)
        return _sigmoid(score[:, None] - self.cuts[None, :])

    @classmethod
    def fit(cls, firsts: np.ndarray, slots: np.ndarray, grade: np.ndarray, grades: int) -> OrdinalModel:
        """Minibatch gradient steps on the log likelihood of the grades. The
        thresholds are the first plus positive gaps, so they stay ordered.
        ``slots[firsts[i]:firsts[i+1]]`` are the features of row i."""
        rows = np.bincount(slots, minlength=FEATURES)
        used = rows >= LEAST_ROWS
        n = len(grade)
        weights = np.zeros(FEATURES)
        share = np.array([np.clip((grade > k).mean(), 0.01, 0.99) for k in range(grades - 1)])
        cuts = np.maximum.accumulate(np.log((1 - share) / share) + np.arange(grades - 1) * 1e-3)
        first, gaps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-2))
        slow_w, fast_w = np.zeros(FEATURES), np.zeros(FEATURES)
        shrink = np.where(np.arange(FEATURES) < STYLE, 0.0, L2)
        rng, step = np.random.default_rng(SEED), 0
        size = np.diff(firsts)
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // n))
        total = epochs * -(-n // BATCH)
        for _ in range(epochs):
            order = rng.permutation(n)
            for lo in range(0, n, BATCH):
                pick = order[lo:lo + BATCH]
                c = size[pick]
                at = np.repeat(firsts[pick] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
                f, doc = slots[at], np.repeat(np.arange(len(pick)), c)
                ok = used[f]
                f, doc = f[ok], doc[ok]
                cuts = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
                tail = _sigmoid(np.bincount(doc, weights[f], minlength=len(pick))[:, None] - cuts)
                edge = np.concatenate([np.ones((len(pick), 1)), tail, np.zeros((len(pick), 1))], axis=1)
                slope = edge * (1 - edge)
                g, r = grade[pick], np.arange(len(pick))
                p = np.maximum(edge[r, g] - edge[r, g + 1], 1e-9)
                to_score = (slope[r, g] - slope[r, g + 1]) / p
                to_cut = np.zeros((len(pick), grades + 1))
                to_cut[r, g] -= slope[r, g] / p
                to_cut[r, g + 1] += slope[r, g + 1] / p
                cut_grad = to_cut[:, 1:-1].mean(0)
                grad = np.bincount(f, to_score[doc], minlength=FEATURES) / len(pick) - shrink * weights
                rate = RATE * (1 - step / total)  # falls to zero, so that the last steps settle
                step += 1
                slow_w += 0.1 * (grad - slow_w)
                fast_w += 0.002 * (grad * grad - fast_w)
                weights += rate * slow_w / (1 - 0.9 ** step) / (np.sqrt(fast_w / (1 - 0.998 ** step)) + 1e-8) * used
                first += rate * cut_grad.sum()
                gaps = gaps + rate * np.array([cut_grad[k + 1:].sum() for k in range(grades - 2)]) * np.exp(gaps)
        cuts = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        return cls(weights, cuts)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", grades: int = 3, rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` rows of ``labels`` (doc_id, grade) that have a
    document: those of least hashed id, then grade. Rows without id or grade and
    grades outside 0..grades-1 are left out. Features are made where the texts
    lie; one task then gets the bounded sample and returns the weights."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1)) \
        .select(F.col("doc_id").cast("long"), F.col("grade").cast("int")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(2 * rows)
    sample = docs.select(F.col("doc_id").cast("long"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(usable), "doc_id")

    def work(offsets: np.ndarray, data: bytes) -> list[pa.Array]:
        doc, slot = features(offsets, data)
        firsts = np.searchsorted(doc, np.arange(len(offsets)))
        return [pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(slot.astype(np.int32)))]

    made = map_texts(sample, "text", ["doc_id", "grade"], "slots array<int>", work) \
        .orderBy(F.xxhash64("row.doc_id"), "row.doc_id", "row.grade").limit(rows).coalesce(1) \
        .select(F.xxhash64("row.doc_id").alias("h"), "row.doc_id", "row.grade", "slots")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).sort_by([("h", "ascending"), ("doc_id", "ascending"), ("grade", "ascending")]).combine_chunks()
        lists = t.column("slots").combine_chunks()
        firsts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        model = OrdinalModel.fit(firsts, lists.flatten().to_numpy().astype(np.int64), t.column("grade").to_numpy().astype(np.int64), grades)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.cuts.tolist()])],
                                         names=["weights", "cuts"])

    # The model: FEATURES numbers, whatever the corpus.
    got = made.mapInArrow(fit, "weights binary, cuts array<double>").collect()
    if not got:
        return OrdinalModel(np.zeros(FEATURES), np.arange(grades - 1) - 30.0)
    return OrdinalModel(np.frombuffer(bytes(got[0]["weights"]), "<f4").astype(np.float64), np.array(got[0]["cuts"]))


def classify(docs: DataFrame, model: OrdinalModel, carry: list[str], text_col: str = "text", least_tail: float = 0.7,
             least_grade: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the carried columns),
    ``expected_grade`` (0 to K-1), ``tail`` (probability of the best grade) and
    ``kept``: both reach their least values. Null and empty texts have no
    features and get the grade of the thresholds alone."""
    def work(offsets: np.ndarray, data: bytes) -> list[pa.Array]:
        tails = model.tails(len(offsets) - 1, *features(offsets, data))
        grade, tail = np.round(tails.sum(1), 6), np.round(tails[:, -1], 6)
        return [pa.array(grade), pa.array(tail), pa.array((tail >= least_tail) & (grade >= least_grade))]

    return map_texts(docs, text_col, carry, "expected_grade double, tail double, kept boolean", work)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of 0/1 labels: toxic 0, poor 1, good 2. A document rated
    more than once has its least grade."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
