"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

Grades are ordered, 0 to K - 1. One weight vector is shared by all grades and K - 1 ordered thresholds cut its score:
P(grade >= k) = sigmoid(score - threshold k). That gives an expected grade and the tail probability by which
documents are selected. Features are hashed into 2^18 slots: words, pairs of words, word endings, word shapes
("Aa!", "0", "|"), pairs of shapes, and repeats of the word before; a text's score is their weights' sum over the
square root of its words. Whole words and whole texts count.

Training takes a bounded sample: the labelled rows with the least hashes of their ids, `train_rows` at most (8,000 by
default), and of their texts, in the order of the hashes, as many as have `train_words` words together (4,000,000 by
default), those of more than `text_words` words (200,000 by default) left out before. They are joined by id with a broadcast of that many ids, turned into features where they lie, and fitted in
one task; everything else runs over all rows. Scoring is one pass without a shuffle.

Defined results: a text without words (or a null) has grade 0 and tail probability 0, so it is rejected; without
labelled rows all weights are zero and the tails are evenly spaced, so texts with words stay; a label with a null
grade or id is ignored; a grade that an id has in several labels counts once, different grades of an id each count;
of several documents with a labelled id the one with the least hash of its features is learned from; a tail
probability equal to the threshold is kept; very long texts are scored whole, in one piece; a text of more than
text_words or train_words words is not learned from, and takes nothing from the others' share; rows with a null id and repeated rows are scored like any other; an empty table
gives no rows; other columns, whatever their names, are ignored by score() and passed through by keep_good().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._tables import drop_path, materialize_at
from quarry.llm._text import coded, filled, sliced, split_words
from quarry.llm.chunks import release_tables

SLOT_BITS = 18
_SLOTS = 1 << SLOT_BITS
_RUNS = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """The word with letters as A or a, digits as 0, and runs shortened: "Hello!!" is "Aa!!"."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(lambda m: m[1] if m[1] in "Aa0" else m[1] * 2, kinds)


def _hash(kind: bytes, value: str) -> int:
    return xxhash.xxh3_64_intdigest(kind + value.encode())


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """A hash of two hashes, in this order."""
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(salt))
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed >> np.uint64(64 - SLOT_BITS)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text six feature slots a word, all texts one after the other, and each text's number of words."""
    words, bounds = split_words(texts)
    codes, table = coded(words)
    known = table.to_pylist()
    shapes = [shape(w) for w in known]
    word_hash = np.array([_hash(b"w", w) for w in known], np.uint64)
    shape_hash = np.array([_hash(b"s", s) for s in shapes], np.uint64)
    ending = np.array([_hash(b"e", w[-3:].lower()) for w in known], np.uint64)
    down = np.uint64(64 - SLOT_BITS)
    out = np.empty((len(codes), 6), np.int32)
    if len(codes):
        before = np.concatenate([[-1], codes[:-1]])
        before[bounds[:-1][np.diff(bounds) > 0]] = -1  # the first word of a text has none before it
        has = before >= 0
        w, s = word_hash[codes], shape_hash[codes]
        w_before = np.where(has, word_hash[before], np.uint64(1))
        s_before = np.where(has, shape_hash[before], np.uint64(1))
        out[:, 0], out[:, 1], out[:, 2] = w >> down, s >> down, ending[codes] >> down
        out[:, 3], out[:, 4] = _pair(w_before, w, 3), _pair(s_before, s, 5)
        out[:, 5] = np.where(before == codes, 1, 0)
    return out.ravel(), np.diff(bounds)


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) for k = 1 .. K - 1, one row for each text, and the texts' numbers of words."""
        slots, n_words = features(texts)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[slots], dtype=np.float64)])
        ends = 6 * np.cumsum(n_words)
        score = (sums[ends] - sums[ends - 6 * n_words]) / np.sqrt(np.maximum(n_words, 1))
        tails = 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))
        tails[n_words == 0] = 0.0
        return tails, n_words


def blank_model(grades: int) -> OrdinalModel:
    """Zero weights; the grades are equally likely."""
    k = np.arange(1, grades)
    return OrdinalModel(np.zeros(_SLOTS, np.float32), np.log(k / (grades - k)))


def fit(slots: list[np.ndarray], grades: np.ndarray, n_grades: int, epochs: int = 8, least_steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> OrdinalModel:
    """Minibatch Adam on the negative log likelihood of the grades, at least `epochs` times over the rows.

    Few rows are gone through more often, until least_steps steps of 32 rows are done.
    """
    rng = np.random.default_rng(0)
    n = len(slots)
    if not n:
        return blank_model(n_grades)
    weights = np.zeros(_SLOTS)
    # thresholds start at the grades' own frequencies; all but the first are kept as logs of their gaps
    tail = np.clip([(grades >= k).mean() for k in range(1, n_grades)], 1e-3, 1 - 1e-3)
    start = -np.log(tail / (1 - tail))
    gaps = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    epochs = max(epochs, -(-least_steps * 32 // n))
    m_w, v_w, m_g, v_g, step = np.zeros(_SLOTS), np.zeros(_SLOTS), np.zeros_like(gaps), np.zeros_like(gaps), 0
    sizes = np.array([len(s) for s in slots])
    scale = 1 / np.sqrt(np.maximum(sizes / 6, 1))
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * (1 - epoch / epochs)
        for lo in range(0, n, 32):
            some = order[lo : lo + 32]
            flat = np.concatenate([slots[i] for i in some])
            own = np.repeat(np.arange(len(some)), sizes[some])
            score = np.bincount(own, weights[flat], len(some)) * scale[some]
            theta = np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
            s = 1 / (1 + np.exp(-(score[:, None] - theta[None, :])))
            above = np.concatenate([np.ones((len(some), 1)), s], 1)[np.arange(len(some)), grades[some]]
            below = np.concatenate([s, np.zeros((len(some), 1))], 1)[np.arange(len(some)), grades[some]]
            p = np.maximum(above - below, 1e-9)
            d_above, d_below = above * (1 - above) / p, below * (1 - below) / p
            d_score = -(d_above - d_below)
            g_w = np.bincount(flat, (d_score * scale[some])[own], _SLOTS) / len(some) + decay * weights
            d_theta = np.zeros(n_grades - 1)
            np.add.at(d_theta, grades[some][grades[some] > 0] - 1, d_above[grades[some] > 0])
            np.add.at(d_theta, grades[some][grades[some] < n_grades - 1], -d_below[grades[some] < n_grades - 1])
            later = np.cumsum(d_theta[::-1])[::-1] / len(some)
            g_g = np.concatenate([later[:1], later[1:] * np.exp(gaps[1:])])
            step += 1
            m_w, v_w = 0.9 * m_w + 0.1 * g_w, 0.999 * v_w + 0.001 * g_w**2
            m_g, v_g = 0.9 * m_g + 0.1 * g_g, 0.999 * v_g + 0.001 * g_g**2
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            weights -= lr * (m_w / c1) / (np.sqrt(v_w / c2) + 1e-8)
            gaps -= lr * (m_g / c1) / (np.sqrt(v_g / c2) + 1e-8)
    theta = np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
    return OrdinalModel(weights.astype(np.float32), theta)


def train(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    n_grades: int,
    train_rows: int = 8_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_words: int = 4_000_000,
    text_words: int = 200_000,
) -> OrdinalModel:
    """Fit on a bounded sample of the labelled rows; grade is an expression over the labels, from 0 to n_grades - 1."""
    graded = labels.select(F.col("doc_id").cast("long").alias("l_id"), grade.cast("int").alias("grade"))
    usable = graded.filter(F.col("l_id").isNotNull() & F.col("grade").between(0, n_grades - 1)).distinct()
    sample = usable.orderBy(F.xxhash64("l_id"), "l_id", "grade").limit(train_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("l_id")).select("doc_id", "grade", "text")

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, "text", 2 << 20):
            slots, n_words = features(filled(batch.column("text")))
            ends = 6 * np.cumsum(n_words)
            packed = [slots[b - 6 * n : b].astype("<i4").tobytes() for b, n in zip(ends.tolist(), n_words.tolist())]
            digests = np.array([xxhash.xxh3_64_intdigest(p) for p in packed], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(n_words.astype(np.int64)), pa.array(digests), pa.array(packed, pa.binary())],
                ["doc_id", "grade", "n_words", "digest", "slots"],
            )

    made, path = materialize_at(joined.mapInArrow(to_features, "doc_id long, grade int, n_words long, digest long, slots binary"), "ordinal-features")
    # rows that repeat an id are merged before the shuffle; what is left is a row for each (id, grade) of the sample
    one = made.groupBy("doc_id", "grade").agg(F.min(F.struct("digest", "n_words")).alias("m")).select("doc_id", "grade", "m.digest", "m.n_words")
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").rowsBetween(Window.unboundedPreceding, 0)  # train_rows rows at most
    usable_texts = one.filter(F.col("n_words") <= min(text_words, train_words))  # before the running sum, which they would use up
    taken = usable_texts.withColumn("words", F.sum("n_words").over(in_order)).filter((F.col("words") <= train_words) | (F.col("n_words") == 0))
    learned = made.join(F.broadcast(taken.select("doc_id", "grade", "digest")), ["doc_id", "grade", "digest"], "left_semi")

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        rows = {}
        for batch in batches:
            for i, g, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "grade", "slots"))):
                rows[i, g] = packed  # equal features, if an id has them twice
        ordered = sorted(rows)
        model = fit([np.frombuffer(rows[k], "<i4") for k in ordered], np.array([g for _, g in ordered], np.int64), n_grades)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.astype("<f8").tobytes()]})

    # one task, for train_rows rows of train_words words at most
    once = learned.select("doc_id", "grade", "slots").dropDuplicates(["doc_id", "grade"])
    row = once.repartition(1).mapInArrow(fit_all, "weights binary, thresholds binary").first()
    drop_path(docs.sparkSession, path)
    return OrdinalModel(np.frombuffer(row["weights"], "<f4"), np.frombuffer(row["thresholds"], "<f8")) if row else blank_model(n_grades)


def score(docs: DataFrame, model: OrdinalModel, at_least: int = 1, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept): kept if P(grade >= at_least) reaches the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, "text", 2 << 20):
            tails, _ = sent.value.tails(filled(batch.column("text")))
            tail = tails[:, at_least - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= threshold)],
                ["doc_id", "expected_grade", "tail_probability", "kept"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: OrdinalModel, at_least: int = 1, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents whose tail probability reaches the threshold, all columns as they were; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, text_col, 2 << 20):
            tails, _ = sent.value.tails(filled(batch.column(text_col)))
            yield batch.filter(pa.array(tails[:, at_least - 1] >= threshold))

    return docs.mapInArrow(run, docs.schema)


def graded_by_labels() -> Column:
    """Grades of the `labels` table: 0 poor, 1 good but toxic, 2 good and clean."""
    return F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
