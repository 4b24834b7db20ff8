"""Best-fit packing of tokenized documents into fixed-length sequences, by bin completion branch-and-bound.

Lengths are whole numbers up to the sequence length, so any corpus is a histogram of at most `capacity` lengths, however
many documents it has. The search runs on that histogram: around the longest remaining piece it enumerates, in order of
waste, all fillings that no other filling dominates, takes one as often as the counts allow (then less often), and goes
on; it prunes by the waste that an improvement could still afford and keeps the best-fit solution as the first
incumbent. It ends at the lower bound, or when its budget of steps is spent; without a budget it is exact. The outcome
is a short list of patterns. Spark ranks the pieces of each length and maps ranks to places in the patterns; no
document is gathered.

Defined results: a null text counts as empty and is one piece holding the end id only; a very long text is tokenized
whole and cut into pieces; a row with a null id and repeated rows are packed like any other; pieces of one length are
ranked by id, piece, checksum and their number in the task that cut them, and equal ones are interchangeable; an empty
table gives no sequences; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._tables import materialize
from quarry.llm._text import filled, sliced
from quarry.llm.chunks import tokenizer_table

Pattern = tuple[tuple[int, ...], int]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, by the pieces too long to share (all thresholds), and by how many
    pieces of a length share one (dual feasible weights, which add up to one at most in any sequence)."""
    sizes = np.arange(len(counts))
    best = -(-int((counts * sizes).sum()) // capacity)
    number = np.concatenate([[0], np.cumsum(counts)])
    weight = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    for k in range(half + 1):
        big = int(number[-1] - number[min(len(counts), capacity - k + 1)])
        middle = int(number[min(len(counts), capacity - k + 1)] - number[half + 1])
        middle_w = int(weight[min(len(counts), capacity - k + 1)] - weight[half + 1])
        small_w = int(weight[half + 1] - weight[k])
        spare = middle * capacity - middle_w
        best = max(best, big + middle + max(0, -(-(small_w - spare) // capacity)))
    for k in range(1, min(capacity, 128)):  # a length's weight in units of 1 / (k * capacity)
        whole, rest = np.divmod((k + 1) * sizes, capacity)
        parts = np.where(rest == 0, sizes * k, whole * capacity)
        held = sum(int(c) * int(w) for c, w in zip(counts[parts > 0], parts[parts > 0]))
        best = max(best, -(-held // (k * capacity)))
    return best


def _largest_fit(counts: np.ndarray, room: int, used: dict[int, int]) -> int:
    """The greatest available length of at most `room`, 0 if none."""
    found = np.flatnonzero(counts[: room + 1])
    for x in found[::-1].tolist():
        if x and counts[x] > used.get(x, 0):
            return x
    return 0


def _spread(bits: int, by: int) -> int:
    """The bits, each also set at the `by` places above it."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        bits |= bits << step
        done += step
    return bits


def fillings(counts: np.ndarray, longest: int, capacity: int, most_waste: int, spend: Callable[[], bool]) -> Iterator[tuple[int, ...]]:
    """All undominated ways to fill the room beside the longest piece, those with less waste first, up to most_waste.

    A filling is dominated if some of its pieces can be swapped for one spare piece that is longer than they are
    together and still fits, or for one of just their length if they are several: what then remains to be packed is
    never harder. spend() is asked at every step and ends the enumeration when it says no.

    Sets of lengths are bits of whole numbers, so a step takes the same time however many pieces a filling holds.
    """
    room = capacity - longest
    free = counts[: room + 1].copy()
    if longest <= room:
        free[longest] -= 1
    spare = free.tolist()  # pieces that are left beside those in `items`
    spare[0] = 0
    sizes = [x for x in range(1, room + 1) if spare[x]]
    least = sizes[0] if sizes else 0
    within = (1 << (room + 1)) - 1
    left = sum(1 << x for x in sizes)  # the lengths of spare pieces
    items: list[int] = []
    # what was before each item: the sums of one piece, and of several
    single, several, before = 0, 0, []

    def dominated(waste: int) -> bool:
        if waste and any(_spread(1 << x, waste) & ~(1 << x) & left for x in {*items, 0}):
            return True
        return bool(_spread(several & within, waste) & left & within)

    for waste in range(min(most_waste, room) + 1):
        if not spend():
            return
        total = room - waste
        if total == 0:
            if not dominated(waste):
                yield ()
            continue
        # depth first over multisets of that total, longest pieces first; `limits` holds the longest piece to try next
        limits = [total]
        while limits:
            x = (left & ((1 << (min(limits[-1], total) + 1)) - 1)).bit_length() - 1
            if x > 0:
                limits[-1] = x - 1
                if total - x and total - x < least:
                    continue
                if not spend():
                    return
                before.append((single, several))
                several, single = several | (several | single) << x, single | 1 << x
                spare[x] -= 1
                if not spare[x]:
                    left &= ~(1 << x)
                items.append(x)
                total -= x
                if not several & left & within:
                    if total:
                        limits.append(x)
                        continue
                    if not dominated(waste):
                        yield tuple(items)
            else:
                limits.pop()
                if not limits:
                    break
            x = items.pop()
            total += x
            spare[x] += 1
            left |= 1 << x
            single, several = before.pop()


def _descend(counts: np.ndarray, capacity: int, choose) -> list[Pattern]:
    out: list[Pattern] = []
    counts = counts.copy()
    longest = len(counts) - 1
    while longest:
        if not counts[longest]:
            longest -= 1
            continue
        items = choose(counts, longest)
        times = _times(counts, longest, items)
        for x in (longest, *items):
            counts[x] -= times
        out.append(((longest, *items), times))
    return out


def _times(counts: np.ndarray, longest: int, items: tuple[int, ...]) -> int:
    """How often a pattern can be taken with the counts that there are."""
    need: dict[int, int] = {}
    for x in (longest, *items):
        need[x] = need.get(x, 0) + 1
    return min(int(counts[x]) // n for x, n in need.items())


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """The best-fit decreasing packing: always the largest piece that still fits."""

    def choose(now: np.ndarray, longest: int) -> tuple[int, ...]:
        used, items, left = {longest: 1}, [], capacity - longest
        while left and (nxt := _largest_fit(now, min(left, longest), used)):
            items.append(nxt)
            used[nxt] = used.get(nxt, 0) + 1
            left -= nxt
        return tuple(items)

    return _descend(counts, capacity, choose)


class _Budget:
    """Counts steps down; None has no end."""

    def __init__(self, steps: int | None):
        self.left = steps

    def spend(self) -> bool:
        if self.left is None:
            return True
        self.left -= 1
        return self.left > 0


def _search(counts: np.ndarray, capacity: int, best: list[Pattern], enough: int, steps: int | None) -> list[Pattern]:
    """Depth first over the fillings around the longest remaining piece, from an incumbent on.

    A branch ends when its waste exceeds what a packing with one sequence less than the incumbent could afford. The
    search ends at `enough` sequences, or after that many steps.
    """
    total = int((counts * np.arange(len(counts))).sum())
    best_bins = sum(t for _, t in best)
    budget, path = _Budget(steps), []

    def branch(now: np.ndarray, spent: int) -> Iterator[tuple[tuple[int, ...], int]]:
        longest = int(np.flatnonzero(now)[-1])
        afford = (best_bins - 1) * capacity - total - spent
        for items in fillings(now, longest, capacity, afford, budget.spend):
            for times in range(_times(now, longest, items), 0, -1):
                yield (longest, *items), times

    stack = [(counts, 0, branch(counts, 0))]
    while stack and best_bins > enough and budget.spend():
        now, waste, ways = stack[-1]
        pattern, times = next(ways, ((), 0))
        if not times:
            stack.pop()
            if path:
                path.pop()
            continue
        spent = waste + times * (capacity - sum(pattern))
        if spent > (best_bins - 1) * capacity - total:
            continue
        after = now.copy()
        for x in pattern:
            after[x] -= times
        if after.any():
            path.append((pattern, times))
            stack.append((after, spent, branch(after, spent)))
        else:
            best = [*path, (pattern, times)]
            best_bins = sum(t for _, t in best)
    return best


def _repack(patterns: list[Pattern], capacity: int, enough: int, tries: int, steps: int) -> list[Pattern]:
    """Search again within some sequences at a time: the emptiest ones, which waste a sequence together, and random others."""
    rng = np.random.default_rng(0)
    held: dict[tuple[int, ...], int] = {}
    for items, times in patterns:
        held[items] = held.get(items, 0) + times
    while tries > 0 and sum(held.values()) > enough:
        tries -= 1
        kinds = sorted(held, key=lambda p: (sum(p), p))
        chosen: dict[tuple[int, ...], int] = {}
        spare = 0
        for items in kinds:
            while spare < capacity and chosen.get(items, 0) < held[items] and sum(items) < capacity:
                chosen[items] = chosen.get(items, 0) + 1
                spare += capacity - sum(items)
        if spare < capacity:
            break  # less than a sequence is wasted in all
        shared = [p for p in kinds if len(p) > 1]
        for i in rng.permutation(len(shared))[: int(rng.integers(4, 28))].tolist():
            if chosen.get(shared[i], 0) < held[shared[i]]:
                chosen[shared[i]] = chosen.get(shared[i], 0) + 1
        counts = np.zeros(capacity + 1, np.int64)
        for items, times in chosen.items():
            np.add.at(counts, list(items), times)
        bins = sum(chosen.values())
        found = _search(counts, capacity, best_fit(counts, capacity), bins - 1, steps)
        if sum(t for _, t in found) < bins:
            for items, times in chosen.items():
                held[items] -= times
                if not held[items]:
                    del held[items]
            for items, times in found:
                held[items] = held.get(items, 0) + times
    return list(held.items())


def complete_bins(counts: np.ndarray, capacity: int, steps: int | None = 200_000, tries: int = 60) -> list[Pattern]:
    """Patterns (lengths, how often) that hold every piece of the histogram in as few sequences as the search finds.

    One search over the whole histogram from the best-fit incumbent, of `steps` steps at most, then `tries` searches of
    steps / 60 over some of its sequences at a time; all stop at the lower bound. With steps=None there is no budget:
    the search goes through every undominated filling as often as it can be taken, and the result is optimal; that
    is for small histograms.
    """
    counts = np.asarray(counts, np.int64)
    if not counts[1:].any():
        return []
    bound = lower_bound(counts, capacity)
    found = _search(counts, capacity, best_fit(counts, capacity), bound, steps)
    if steps is None or sum(t for _, t in found) <= bound:
        return found
    return _repack(found, capacity, bound, tries, steps // 60)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, number): only documents longer than a sequence are cut; their first piece is the rest.

    number counts the pieces of a task; it tells equal rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, done = tokenizer_table(tokenizer_path), 0
        for batch in sliced(batches, "text", 2 << 20):
            ids, bounds = table.tokenize(filled(batch.column("text")), end_id)
            sizes = np.diff(bounds)
            number = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            head = sizes - (number - 1) * capacity
            start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[owner], capacity)
            data, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), 4 * (bounds[owner] + start)
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(done + np.arange(len(owner)))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "number"],
            )
            done += len(owner)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, number long")


def _places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, of them in a sequence, offset): where the pieces of a length go."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            first = taken.get(length, 0)
            taken[length] = first + each * times
            out.append((length, first, first + each * times - 1, sequence, each, offset))
            offset += each * length
        sequence += times
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_group: int = 1_000,
) -> DataFrame:
    """One row for each piece with its sequence and its offset there.

    Pieces of one length may be most of all pieces, so ranks are counted in groups of (length, salt), of about
    rows_per_group rows whatever the length's share, and shifted by the sizes of the groups before. The driver sees the histogram only
    (at most `capacity` numbers); the patterns' places (some for each length) are broadcast.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    histogram = cut.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    places = spark.createDataFrame(
        _places(complete_bins(counts, capacity)),
        "p_length long, lo long, hi long, first_sequence long, each long, first_offset long",
    )
    salts = spark.createDataFrame([(n, max(1, -(-int(c) // rows_per_group))) for n, c in enumerate(counts)], "length long, salts long")
    # one row for each length; the hash takes in all of a piece and its number, so that repeated and equal rows spread as well
    salted = cut.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "number"), F.col("salts"))).drop("salts")
    before = (
        salted.groupBy("length", "salt")
        .count()
        .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "number")
    ranked = salted.withColumn("n", F.row_number().over(order) - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("n") + F.col("before"))
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length")) & F.col("rank").between(F.col("lo"), F.col("hi")))
    within = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (within % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
