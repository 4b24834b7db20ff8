"""Phrase collocation mining over vertical positional inverted lists.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and into words at blanks. Every word, and
every phrase, has a list of the positions where it stands; a list's length is its exact frequency. Phrases grow one word
at a time: the positions of a frequent phrase, moved on by its length, are merge-joined with the postings of the words
next to them, which gives the lists of the longer phrases. As no phrase is more frequent than its parts, only lists of
frequent phrases are extended. Everything is per language.

How it runs. The lists are cut by blocks of documents, some megabytes each, so that no list is ever in one task; a
frequency is the sum of a phrase's list lengths over all blocks. Level by level, blocks send the phrases that they
have, once each with their list's length, and learn which ones are frequent. Level 1 is a grouping and a join of words
(both sum before they shuffle or split hot keys). Level 2 goes by ranges of mixed keys: a range adds up the blocks'
lengths and answers each block with a bit for each phrase. Level 3 is a grouping of what is left. Words get dense
numbers, so two words are one exact 64-bit key.

A range gets about words_per_range phrases however large the corpus is, and a very frequent phrase once from each block.
A block's share of a range gets smaller as the corpus grows; for much more than 10 TB raise block_bytes and
words_per_range with the executors' memory. More than 2^32 frequent words are an error.

Scores: a candidate is a phrase of 2 or 3 words with a frequency a >= least. Cut after its first k words into parts of
frequencies l and r it scores floor(scale * a * a / (l * r)); the lowest-scoring cut counts, the smallest k at a tie.
A candidate whose words lie inside a longer candidate with at least `inside` percent of its frequency is dropped.

Defined results: a null text counts as empty; a null language counts as `und`; an empty text has no words; very long
texts are counted whole, in a block of their own; repeated rows count as often as they stand there; null or repeated
ids do not matter; ties of score go by frequency, then by the phrase's UTF-8 bytes; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._bytes import mix, pack, pack_sorted, ranges, runs, unmix, unpack, unpack_sorted
from quarry.llm._tables import drop_path, materialize, materialize_at
from quarry.llm._text import coded, filled, owners, sliced, split_words
from quarry.llm.chunks import release_tables

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
#: Lower case, and a space for everything between words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[_KIND > 0] = 0x20


def words_and_places(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of all texts, their places, and n + 1 offsets of the texts' words.

    Words next to each other in one piece have places that differ by one; a piece's end leaves a gap.
    """
    size = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, size + 1)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8, offsets[-1])
    kind = _KIND[data]
    first = kind == 0
    first[1:] &= kind[:-1] != 0
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = kind[starts] == 0
    plain = pa.Array.from_buffers(pa.large_string(), size, [None, pa.py_buffer(offsets), pa.py_buffer(_PLAIN[data])])
    words, bounds = split_words(plain)
    places = np.cumsum(kind == _BREAK)[first] + np.arange(len(words)) + owners(bounds)
    return words, places, bounds


class _Gathered:
    """Words of several batches, on their way into one block."""

    def __init__(self):
        self.codes, self.tables, self.langs, self.names, self.places = [], [], [], [], []
        self.bytes, self.next_place, self.words, self.known = 0, 0, 0, 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = filled(batch.column("text"))
        words, places, bounds = words_and_places(texts)
        codes, table = coded(words)
        names = batch.column("lang").dictionary_encode()
        self.codes.append((codes + self.words).astype(np.int32))
        self.tables.append(table)
        self.words += len(table)
        self.langs.append((np.asarray(names.indices)[owners(bounds)] + self.known).astype(np.int32))
        self.names.append(names.dictionary)
        self.known += len(names.dictionary)
        self.places.append(places + self.next_place)
        self.next_place += int(places[-1]) + 2 if len(places) else 0
        self.bytes += int(np.asarray(pc.binary_length(texts)).sum())

    def row(self) -> pa.RecordBatch:
        """The block: its distinct (language, word) pairs with counts, and their numbers and places."""
        table = pa.concat_arrays(self.tables).dictionary_encode()
        words = np.asarray(table.indices).astype(np.int64)[np.concatenate(self.codes)]
        names = pa.concat_arrays(self.names).dictionary_encode()
        langs = np.asarray(names.indices).astype(np.int64)[np.concatenate(self.langs)]
        pairs, codes, counts = _dense(langs * len(table.dictionary) + words, len(names.dictionary) * len(table.dictionary))
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))
        width = max(len(table.dictionary), 1)
        places = np.concatenate(self.places)
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([uuid.uuid4().int >> 65], pa.int64()),
                "names": one(names.dictionary, pa.string()),
                "langs": one(pa.array(pairs // width), pa.int32()),
                "words": one(table.dictionary.take(pa.array(pairs % width)), pa.string()),
                "counts": one(pa.array(counts), pa.int64()),
                "places": [pack(codes, np.diff(places, prepend=0))],
            }
        )


def _dense(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, each value's number among them, and how often each one comes."""
    if size > 1 << 24:
        return np.unique(values, return_inverse=True, return_counts=True)
    counts = np.bincount(values, minlength=size)
    distinct = np.flatnonzero(counts)
    number = np.zeros(size, np.int64)
    number[distinct] = np.arange(len(distinct))
    return distinct, number[values], counts[distinct]


_BLOCK = "block long, names array<string>, langs array<int>, words array<string>, counts array<long>, places binary"


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        held = _Gathered()
        for batch in sliced(batches, "text", 2 << 20):
            held.add(batch)
            if held.bytes >= block_bytes:
                yield held.row()
                held = _Gathered()
        if held.words:
            yield held.row()

    return rows.mapInArrow(run, _BLOCK)


def _numbered(words: DataFrame) -> tuple[DataFrame, str]:
    """The frequent words (lang, word, f) with dense numbers `id`, written to the shared folder."""
    spark = words.sparkSession
    by_part, path = materialize_at(
        words.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "phrases-words"
    )
    sizes = by_part.groupBy("part").count().orderBy("part").collect()  # one row for each partition
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["part"], total))
        total += r["count"]
    if total > 1 << 32:
        raise ValueError(f"{total} frequent words; two of them no longer fit into a key of 64 bits")
    first = spark.createDataFrame(offsets, "part int, first long")
    return by_part.join(F.broadcast(first), "part").select("lang", "word", "f", (F.col("first") + F.col("place")).alias("id")), path


def _number_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's frequent words: their numbers and places, in the order of the text."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "postings": pa.array([], pa.binary())})
    codes, gaps = unpack(left.column("places")[0].as_py(), 2)
    number = np.full(int(left.column("n")[0].as_py()), -1, np.int64)
    number[right.column("code").to_numpy()] = right.column("id").to_numpy()
    own = number[codes]
    kept = own >= 0
    places = np.cumsum(gaps.astype(np.int64))[kept]
    return pa.table({"block": left.column("own_block"), "postings": pa.array([pack(own[kept], np.diff(places, prepend=0))], pa.binary())})


class Lists:
    """Position lists of a block's two-word phrases, by ascending mixed key."""

    def __init__(self, postings: bytes):
        words, gaps = unpack(postings, 2)
        self.words, self.places = words.astype(np.uint64), np.cumsum(gaps.astype(np.int64))
        # the merge join: a word's places moved on by one, against the places of all words
        start = np.flatnonzero(np.diff(self.places) == 1)
        keys = mix(self.words[start] << np.uint64(32) | self.words[start + 1])
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts = keys[order], start[order]
        self.first, self.lengths = runs(self.keys)

    @property
    def distinct(self) -> np.ndarray:
        return self.keys[self.first]

    def extended(self, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Three-word phrases (one row of three numbers each) and their lists' lengths; both halves must be frequent."""
        number = np.full(len(self.words), -1, np.int64)  # the frequent pair that starts at a place
        number[self.starts] = np.where(np.repeat(frequent, self.lengths), np.repeat(np.arange(len(self.first)), self.lengths), -1)
        start = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0)) if len(number) else np.zeros(0, np.int64)
        # the pairs at start and start + 1 are in the lists, so three places follow each other
        keys = number[start].astype(np.uint64) << np.uint64(32) | self.words[start + 2]
        order = np.argsort(keys, kind="stable")
        first, lengths = runs(keys[order])
        at = start[order][first]
        return np.stack([self.words[at], self.words[at + 1], self.words[at + 2]], axis=1).astype(np.int64), lengths


def _ask(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, keys, lengths): each block's distinct pairs with their lists' lengths, by ranges of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, postings in zip(*(batch.column(c).to_pylist() for c in ("block", "postings"))):
                lists = Lists(postings)
                keys = lists.distinct
                own, first = np.unique(ranges(keys, buckets), return_index=True)
                cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(keys)]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(own, pa.int32()),
                        "block": pa.array([block] * len(own), pa.int64()),
                        "keys": pa.array([pack_sorted(keys[a:b]) for a, b in cuts], pa.binary()),
                        "lengths": pa.array([pack(lists.lengths[a:b]) for a, b in cuts], pa.binary()),
                    }
                )

    return blocks.mapInArrow(run, "bucket int, block long, keys binary, lengths binary")


def _answer(asked: DataFrame, least: int) -> DataFrame:
    """(bucket, block, frequent, keys, totals): a bit for each key a block asked for; the frequent keys once, without a block."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
        distinct, where = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(where, np.concatenate([unpack(c)[0] for c in table.column("lengths").to_pylist()]), len(distinct)).astype(np.int64)
        often = totals >= least
        flags, ends = often[where], np.cumsum([len(p) for p in parts]).tolist()
        bits = [np.packbits(flags[e - len(p) : e]).tobytes() for p, e in zip(parts, ends)]
        n = table.num_rows
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (n + 1), pa.int32()),
                "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
                "frequent": pa.array([*bits, None], pa.binary()),
                "n": pa.array([*(len(p) for p in parts), None], pa.int64()),
                "keys": pa.array([None] * n + [pack_sorted(distinct[often])], pa.binary()),
                "totals": pa.array([None] * n + [pack(totals[often], width=8)], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, "bucket int, block long, frequent binary, n long, keys binary, totals binary")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent pairs (w1, w2, a) out of the answers' packed rows."""
    for batch in batches:
        for keys, totals in zip(*(batch.column(c).to_pylist() for c in ("keys", "totals"))):
            own = unmix(unpack_sorted(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array((own >> np.uint64(32)).astype(np.int64)), pa.array((own & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(unpack(totals, width=8)[0].astype(np.int64))],
                ["w1", "w2", "a"],
            )


def _longer(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's three-word phrases whose halves are frequent, with their lists' lengths."""
    found, lengths = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    if left.num_rows and right.num_rows:
        order = np.argsort(right.column("bucket").to_numpy())
        bits, sizes = (right.column(c).to_pylist() for c in ("frequent", "n"))
        frequent = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8), count=sizes[i]) for i in order.tolist()]).astype(bool)
        found, lengths = Lists(left.column("postings")[0].as_py()).extended(frequent)
    return pa.table({**{f"w{i + 1}": pa.array(found[:, i]) for i in range(3)}, "n": pa.array(lengths.astype(np.int64))})


def frequent_phrases(
    docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang", block_bytes: int = 12 << 20, words_per_range: int = 2_000_000
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Frequent words (lang, word, f, id), pairs (w1, w2, a), triples (w1, w2, w3, a), and languages (lang, n)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    blocks, blocks_path = materialize_at(_blocks(rows, block_bytes), "phrases-blocks")
    spark = docs.sparkSession
    asked = blocks.select("block", "names", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("code", "own")).select(
        "block", "code", F.get("names", F.col("own.langs")).alias("lang"), F.col("own.words").alias("word"), F.col("own.counts").alias("f")
    )
    languages = materialize(asked.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-languages")
    words, _ = _numbered(asked.groupBy("lang", "word").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))
    ids = asked.join(words, ["lang", "word"]).select("block", "code", "id")
    known = blocks.select(F.col("block").alias("own_block"), "places", F.size("words").alias("n"))
    held, held_path = materialize_at(known.groupBy("own_block").cogroup(ids.groupBy("block")).applyInArrow(_number_blocks, "block long, postings binary"), "phrases-postings")
    drop_path(spark, blocks_path)
    total = languages.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(8, -(-total // words_per_range))
    answers, _ = materialize_at(_answer(_ask(held, buckets), least), "phrases-pairs")
    pairs = answers.filter("block IS NULL").select("keys", "totals").mapInArrow(_pairs, "w1 long, w2 long, a long")
    told = answers.filter("block IS NOT NULL").select("block", "bucket", "frequent", "n")
    longer = held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_longer, "w1 long, w2 long, w3 long, n long")
    triples = materialize(longer.groupBy("w1", "w2", "w3").agg(F.sum("n").alias("a")).filter(F.col("a") >= least), "phrases-triples")
    drop_path(spark, held_path)
    return words, materialize(pairs, "phrases-frequent"), triples, languages


def collocations(
    docs: DataFrame,
    least: int = 10,
    inside: int = 50,
    top: int = 2000,
    scale: int = 1_000_000,
    text_col: str = "text",
    lang_col: str = "lang",
    block_bytes: int = 12 << 20,
    words_per_range: int = 2_000_000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` collocations, best first."""
    words, pairs, triples, languages = frequent_phrases(docs, least, text_col, lang_col, block_bytes, words_per_range)
    number = lambda c: f"cast({c} AS decimal(16,0))"  # noqa: E731  exact up to 10^16: no product reaches 10^38
    score = lambda l, r: F.expr(f"cast({scale} AS decimal(7,0)) * ({number('a')} * {number('a')}) div ({number(l)} * {number(r)})")
    of = lambda i: words.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"))
    with_lang = words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("word1"), F.col("f").alias("f1"))
    # the most frequent triple around each pair
    around = triples.select("w1", "w2", "a").union(triples.select(F.col("w2"), F.col("w3"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(around, ["w1", "w2"], "left").filter(f"longer IS NULL OR 100 * longer < {inside} * a").drop("longer")
    two = two.join(with_lang, "w1").join(of(2), "w2").select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", score("l", "r"))
    head, tail = pairs.select("w1", "w2", F.col("a").alias("f12")), pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(with_lang, "w1").join(of(2).drop("f2"), "w2").join(of(3), "w3")
    three = three.withColumn("s1", score("f1", "f23")).withColumn("s2", score("f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most candidates: the best of each of its parts first, then the best of those
    parted = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = parted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("k") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(languages, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = 10, inside: int = 50, top: int = 2000, scale: int = 1_000_000) -> str:
    """DuckDB SQL for collocations() over `documents`."""
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS i
  FROM (SELECT d, lang, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS p FROM docs)
), words AS (
  SELECT d, lang, i, unnest(w) AS w1, generate_subscripts(w, 1) AS j
  FROM (SELECT d, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), seq AS (
  SELECT lang, w1, lead(w1) OVER (PARTITION BY d, i ORDER BY j) AS w2, lead(w1, 2) OVER (PARTITION BY d, i ORDER BY j) AS w3 FROM words
), langs AS (SELECT lang, count(*) AS n FROM seq GROUP BY 1
), f1 AS (SELECT lang, w1, count(*) AS f FROM seq GROUP BY ALL
), f2 AS (SELECT lang, w1, w2, count(*) AS f FROM seq WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM seq WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}
), around AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), cuts AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, 1 AS k, p.f AS a, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM f1) y USING (lang, w2) LEFT JOIN around o USING (lang, w1, w2)
  WHERE p.f >= {least} AND (o.f IS NULL OR 100 * o.f < {inside} * p.f)
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, 1, p.f, x.f, y.f
  FROM f3 p JOIN f1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM f2) y USING (lang, w2, w3)
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, 2, p.f, x.f, y.f
  FROM f3 p JOIN f2 x USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM f1) y USING (lang, w3)
), scored AS (
  SELECT *, (({scale}::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), candidates AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN langs USING (lang) WHERE rank <= {top}
"""
