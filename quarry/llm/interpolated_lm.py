"""Language-model scores by deleted interpolation of n-gram estimates.

Maximum-likelihood estimates of orders 1 to n and a uniform floor are mixed. The weights of the mixture depend on how
often the token's contexts were seen (buckets of the counts' bit lengths) and are learned by expectation-maximisation
on counts that were held out: one fold of the training documents is deleted from the counts, the weights are fitted
to that fold, and the model then uses the counts of all training documents. A word no training document has gets the
floor alone.

How it runs. Documents are cut into blocks of some megabytes; a block is one row that holds its tokens as codes into
its own word table (words as 64-bit hashes). For each order, every block sends its distinct n-grams (hash and counts)
to buckets of the hash range; a bucket adds up the counts of all blocks and answers each block in the order it asked.
So no n-gram is sent once for each time it stands in the text, a frequent one counts once for each block, and buckets
are even because they are ranges of hashes. Blocks then join their answers, once for the weights and once for the
scores. The orders go one after the other, so that their shuffles do not share the disk.

A block asks only the buckets that it has n-grams for. A bucket gets about tokens_per_bucket n-grams however large the
corpus is, and a frequent one once for each block. Cells (a block's n-grams in a bucket) get smaller as the corpus
grows, about block_bytes * tokens_per_bucket / corpus: at 30 GB a hundred n-grams. For much larger corpora raise both
parameters with the executors' memory, so that cells stay above some tens of n-grams.

Two n-grams with the same 64-bit hash would share their counts; for 10^9 distinct n-grams the chance of any such
pair is about 3 in 100.

Defined results: a null text counts as empty and is one token, the end; a null id counts as the text "" in the fold
rule; a very long text is scored whole, in a block of its own; repeated rows are scored, and counted, as often as they
stand there; with no training document the scores come from the floor alone; an empty table gives no rows; there are no
ties to break; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._tables import drop_path, materialize_at
from quarry.llm._text import coded, filled, sliced, split_words

HELD_OUT, DELETED, FOLDS = 1, 0, 5
_BEGIN, _END = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
_LEVELS = 16


def _packed(*arrays: np.ndarray) -> bytes:
    """Unsigned 32-bit arrays of one length, by byte planes, compressed."""
    planes = [a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(data: bytes, number: int) -> list[np.ndarray]:
    """The `number` arrays that _packed() packed, as int64."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(number, 4, -1)
    return [np.ascontiguousarray(r.T).view("<u4").ravel().astype(np.int64) for r in raw]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an n-gram's hash and the next word's."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@dataclass
class Block:
    """A block's tokens: word hashes by position, each document ending with the end token."""

    ids: pa.Array
    folds: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def fold_of_token(self) -> np.ndarray:
        return np.repeat(self.folds, self.sizes)

    def grams(self, order: int) -> np.ndarray:
        """The n-gram that ends at each position; places before a document's start hold the begin mark."""
        out = self.tokens
        for k in range(1, order):
            # grow to the left: the n-gram at i is the (n-1)-gram at i - 1 and the token at i
            before = np.concatenate([[_BEGIN], out[:-1]])
            before[self.starts] = _BEGIN + np.uint64(k)
            out = _mixed(before, self.tokens)
        return out


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """One row for each block of documents: (block, doc_ids, folds, sizes, codes, words, n_train)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", block_bytes):
            words, bounds = split_words(pc.ascii_lower(filled(batch.column("text"))))
            codes, table = coded(words)
            hashes = [xxhash.xxh3_64_intdigest(w) for w in table.cast(pa.large_binary()).to_pylist()]
            codes = np.insert(codes, bounds[1:], len(hashes))  # the end token of each document
            sizes = np.diff(bounds) + 1
            folds = np.asarray(batch.column("fold"))
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([uuid.uuid4().int >> 65], pa.int64()),
                    "doc_ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    "folds": [folds.astype(np.uint8).tobytes()],
                    "sizes": [sizes.astype("<u4").tobytes()],
                    "codes": [_packed(codes)],
                    "words": [np.array([*hashes, int(_END)], "<u8").tobytes()],
                    "n_train": pa.array([int(sizes[folds != HELD_OUT].sum())], pa.int64()),
                    "n_kept": pa.array([int(sizes[(folds != HELD_OUT) & (folds != DELETED)].sum())], pa.int64()),
                    "d_train": pa.array([int((folds != HELD_OUT).sum())], pa.int64()),
                    "d_kept": pa.array([int(((folds != HELD_OUT) & (folds != DELETED)).sum())], pa.int64()),
                    "n_tokens": pa.array([len(codes)], pa.int64()),
                }
            )

    schema = (
        "block long, doc_ids array<long>, folds binary, sizes binary, codes binary, words binary, "
        "n_train long, n_kept long, d_train long, d_kept long, n_tokens long"
    )
    return rows.mapInArrow(run, schema)


def _block_of(row: dict) -> Block:
    words = np.frombuffer(row["words"], "<u8")
    return Block(
        pa.array(row["doc_ids"], pa.int64()),
        np.frombuffer(row["folds"], np.uint8),
        np.frombuffer(row["sizes"], "<u4").astype(np.int64),
        words[_unpacked(row["codes"], 1)[0]],
    )


_BLOCK_COLUMNS = ["block", "doc_ids", "folds", "sizes", "codes", "words"]


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Which of the equal ranges of hashes each one is in; sorted hashes have sorted buckets."""
    return ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _count(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(block, order, bucket, answer, n_distinct): the counts of each block's distinct n-grams over all blocks.

    An answer holds two counts for each n-gram, in the order of the hashes: kept folds, and the deleted fold.
    n_distinct is the bucket's number of n-grams that training documents have, in one of its rows.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _block_of(row)
                grams, where = np.unique(block.grams(order), return_inverse=True)
                fold = block.fold_of_token
                deleted = np.bincount(where[fold == DELETED], minlength=len(grams))
                kept = np.bincount(where[(fold != DELETED) & (fold != HELD_OUT)], minlength=len(grams))
                own, first = np.unique(_bucket(grams, buckets), return_index=True)  # the buckets that this block has n-grams for
                cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(grams)]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(own, pa.int32()),
                        "block": pa.array([row["block"]] * len(own), pa.int64()),
                        "grams": pa.array([grams[a:b].astype("<u8").tobytes() for a, b in cuts], pa.binary()),
                        "counts": pa.array([_packed(kept[a:b], deleted[a:b]) for a, b in cuts], pa.binary()),
                    }
                )

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(g, "<u8") for g in table.column("grams").to_pylist()]
        grams = np.concatenate(parts)
        counts = [_unpacked(c, 2) for c in table.column("counts").to_pylist()]
        distinct, where = np.unique(grams, return_inverse=True)
        kept = np.bincount(where, np.concatenate([c[0] for c in counts]), len(distinct)).astype(np.int64)[where]
        deleted = np.bincount(where, np.concatenate([c[1] for c in counts]), len(distinct)).astype(np.int64)[where]
        trained = np.zeros(len(distinct), bool)
        trained[where] = kept + deleted > 0
        ends = np.cumsum([len(p) for p in parts])
        n = table.num_rows
        return pa.table(
            {
                "block": table.column("block"),
                "order": pa.array([order] * n, pa.int32()),
                "bucket": table.column("bucket"),
                "answer": pa.array([_packed(kept[b - len(p) : b], deleted[b - len(p) : b]) for p, b in zip(parts, ends.tolist())], pa.binary()),
                "n_distinct": pa.array([int(trained.sum())] + [0] * (n - 1), pa.int64()),
            }
        )

    asked = blocks.select(*_BLOCK_COLUMNS).mapInArrow(ask, "bucket int, block long, grams binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "block long, order int, bucket int, answer binary, n_distinct long")


def _answered(table: pa.Table, block: Block, orders: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For orders 1 .. n the counts at each position: in the kept folds, and in all training folds."""
    kept, train = [], []
    order, bucket = np.asarray(table.column("order")), np.asarray(table.column("bucket"))
    for n in range(1, orders + 1):
        own = np.flatnonzero(order == n)
        own = own[np.argsort(bucket[own])]
        answers = [_unpacked(a, 2) for a in table.column("answer").take(pa.array(own)).to_pylist()]
        where = np.unique(block.grams(n), return_inverse=True)[1]
        k = np.concatenate([a[0] for a in answers])[where]
        kept.append(k)
        train.append(k + np.concatenate([a[1] for a in answers])[where])
    return kept, train


def estimates(counts: list[np.ndarray], starts: np.ndarray, n_docs: int, n_tokens: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Relative frequencies of each position by order (floor first), and the number of its bucket.

    The context of a position's n-gram is the (n-1)-gram one place before; a document's first token has the begin mark.
    """
    size = len(counts[0])
    parts, bucket = [np.full(size, floor), counts[0] / max(n_tokens, 1)], np.zeros(size, np.int64)
    for lower, own in zip(counts, counts[1:]):
        context = np.concatenate([[0], lower[:-1]])
        context[starts] = n_docs
        parts.append(np.divide(own, context, out=np.zeros(size), where=context > 0))
        bits = np.minimum(np.frexp(context.astype(np.float64))[1], _LEVELS - 1)
        bucket = bucket * _LEVELS + bits
    return np.stack(parts), bucket


def first_weights(orders: int) -> np.ndarray:
    """Equal weights for every bucket; an order whose context was never seen has none."""
    weights = np.ones((_LEVELS ** (orders - 1), orders + 1))
    for b in range(len(weights)):
        rest = b
        for n in range(orders, 1, -1):
            rest, bits = divmod(rest, _LEVELS)
            if bits == 0:
                weights[b, n] = 0
    return weights / weights.sum(axis=1, keepdims=True)


def expected(parts: np.ndarray, bucket: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The E step: how much each component accounts for, by bucket."""
    shares = parts * weights[bucket].T
    shares /= np.maximum(shares.sum(axis=0), 1e-300)
    return np.stack([np.bincount(bucket, s, len(weights)) for s in shares], axis=1)


def score_texts(
    docs: DataFrame,
    orders: int = 3,
    rounds: int = 8,
    block_bytes: int = 4 << 20,
    tokens_per_bucket: int = 1_500_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document."""
    spark = docs.sparkSession
    as_text = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (F.crc32(as_text) % FOLDS).cast("int").alias("fold")
    )
    blocks, blocks_path = materialize_at(_blocks(rows, block_bytes), "lm-blocks")
    sums = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_train", "n_kept", "d_train", "d_kept", "n_tokens")]).first()
    buckets = max(4, -(-sums["n_tokens"] // tokens_per_bucket))
    counted = [materialize_at(_count(blocks, n, buckets), f"lm-counts-{n}") for n in range(1, orders + 1)]
    vocabulary = counted[0][0].agg(F.coalesce(F.sum("n_distinct"), F.lit(0))).first()[0]
    floor = 1 / (vocabulary + 1)
    answers = counted[0][0]
    for more, _ in counted[1:]:
        answers = answers.unionByName(more)
    pairs = blocks.select(*_BLOCK_COLUMNS).groupBy("block").cogroup(answers.drop("n_distinct").groupBy("block"))

    def deleted(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _block_of(left.to_pylist()[0])
        kept, _ = _answered(right, block, orders)
        own = block.fold_of_token == DELETED
        return pa.table({"sizes": [block.sizes[block.folds == DELETED].astype("<u4").tobytes()], "counts": pa.array([_packed(*(k[own] for k in kept))], pa.binary())})

    held, held_path = materialize_at(pairs.applyInArrow(deleted, "sizes binary, counts binary"), "lm-deleted")
    weights = first_weights(orders)
    for _ in range(rounds):
        now = weights

        def e_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(now)
            for batch in batches:
                for row in batch.to_pylist():
                    sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                    if len(sizes):
                        parts, bucket = estimates(_unpacked(row["counts"], orders), np.cumsum(sizes) - sizes, sums["d_kept"], sums["n_kept"], floor)
                        total += expected(parts, bucket, now)
            at = np.flatnonzero(total.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, j]) for j in range(orders + 1))], ["bucket", *(f"w{j}" for j in range(orders + 1))])

        names = [f"w{j}" for j in range(orders + 1)]
        # 16 ^ (orders - 1) rows at most
        found = held.mapInArrow(e_step, "bucket long, " + ", ".join(f"{n} double" for n in names)).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).collect()
        gained = first_weights(orders)  # one imaginary token for each bucket keeps every weight above zero
        for r in found:
            gained[r["bucket"]] += [r[n] for n in names]
        weights = gained / gained.sum(axis=1, keepdims=True)
    drop_path(spark, held_path)
    sent = spark.sparkContext.broadcast(weights)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _block_of(left.to_pylist()[0])
        _, counts = _answered(right, block, orders)
        parts, bucket = estimates(counts, block.starts, sums["d_train"], sums["n_train"], floor)
        logs = np.log10((parts * sent.value[bucket].T).sum(axis=0))
        base = np.log10((counts[0] + 0.5) / (sums["n_train"] + 0.5 * (vocabulary + 1)))
        by_doc = lambda x: np.add.reduceat(x, block.starts)
        return pa.table(
            {
                "doc_id": block.ids,
                "held_out": pa.array(block.folds == HELD_OUT),
                "n_tokens": pa.array(block.sizes),
                "n_known": pa.array(by_doc((counts[0] > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(block.sizes), sums["n_train"], np.int64)),
                "base_score": pa.array(by_doc(base)),
                "score": pa.array(by_doc(logs)),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored, _ = materialize_at(pairs.applyInArrow(score, schema), "lm-scores")
    for path in (blocks_path, *(p for _, p in counted)):
        drop_path(spark, path)
    return scored
