"""Structured Streaming forms: recent records, and a change log in event time."""

from __future__ import annotations

import contextlib
from array import array
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def recent_records(stream: DataFrame, key: str, at: str, delay: str = "7 days") -> DataFrame:
    """Each record once within the watermark, late ones beyond it dropped by Spark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which change logs need: on disk, not on the heap."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class ChangeLog(StatefulProcessor):
    """A key's values in event time, and what each arrival changes in its log.

    State: the value that is settled, up to when, and the observations after it, which late records may still alter. An
    event-time timer settles those that the watermark has passed, so state holds one watermark's delay of a key. It is
    packed, times and places in the list of distinct values, as the API goes over every element of a list by itself.
    Keys are many and small, so all is done on rows: a data frame takes longer to make than a key's rows to handle.
    """

    def __init__(self, key: str, value: str, kind: str):
        self.value, self.kind = value, kind
        self.row = Row(key, value, "us", "sign")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("log", f"known boolean, settled {self.kind}, until long, times binary, places binary, vals array<{self.kind}>")

    def _load(self) -> tuple[bool, object, int, dict[int, object]]:
        """Known, settled, until, and the observations in order of time."""
        held = self.state.get()
        if held is None:
            return False, None, _NEVER, {}
        known, settled, until, times, places, values = held
        values = [_canonical(v) for v in values]
        return known, _canonical(settled), until, dict(zip(_unpacked(times), [values[i] for i in _unpacked(places)]))

    def _save(self, known: bool, settled: object, until: int, seen: dict[int, object]) -> None:
        place: dict[object, int] = {}
        places = [place.setdefault(v, len(place)) for v in seen.values()]
        self.state.update((known, settled, until, array("q", seen).tobytes(), array("q", places).tobytes(), list(place)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, settled, until, held = self._load()
        passed = max(until, timerValues.getCurrentWatermarkInMs() * 1000)  # the timers of this batch come after its rows
        seen = dict(held)
        for row in rows:
            at, value = row["us"], _canonical(row[self.value])
            if at is not None and at > passed and (at not in seen or _less(value, seen[at])):
                seen[at] = value
        if seen == held:
            return
        seen = dict(sorted(seen.items(), key=itemgetter(0)))
        before, after = set(_changes(known, settled, held)), set(_changes(known, settled, seen))
        self._save(known, settled, until, seen)
        if not held:
            self.handle.registerTimer(next(iter(seen)) // 1000 + 1)
        for gone, sign in ((before - after, -1), (after - before, 1)):
            for at, value in gone:
                yield self.row(key[0], value, at, sign)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known, settled, until, seen = self._load()
        until = max(until, timerValues.getCurrentWatermarkInMs() * 1000)
        for at in [at for at in seen if at <= until]:
            known, settled = True, seen.pop(at)
        self._save(known, settled, until, seen)
        if seen:
            self.handle.registerTimer(next(iter(seen)) // 1000 + 1)
        return iter([])

    def close(self) -> None:
        pass


_NEVER = -(1 << 63)
#: One object for all NaN, so that they are equal to each other, in tuples and sets too.
_NAN = float("nan")


def _canonical(value: object) -> object:
    return value if value == value else _NAN


def _less(a: object, b: object) -> bool:
    """Whether the value goes before the other one, as in Spark: NaN is beyond all numbers; a null only where there is no other."""
    if a is None or b is None:
        return a is not None and b is None
    return b is _NAN and a is not _NAN or a < b


def _unpacked(numbers: bytes) -> array:
    out = array("q")
    out.frombytes(numbers)
    return out


def _changes(known: bool, settled: object, seen: dict[int, object]) -> Iterator[tuple[int, object]]:
    """Moments whose value differs from the one before."""
    last, any_before = settled, known
    for at, value in seen.items():
        if not any_before or value is not last and value != last:
            yield at, value
        last, any_before = value, True


def changes(stream: DataFrame, key: str, value: str, at: str, delay: str = "7 days") -> DataFrame:
    """(key, value, valid_from, sign): what each arrival adds to (1) and takes from (-1) the log of a key's changes.

    Records may come in any order within the delay: a late one enters the log where it belongs, and a row that is no
    change any more is taken back. Rows that the watermark has passed when they come are dropped, rows without a time too;
    of several values at one moment the least counts; nulls are a value. settled_log() folds the rows. Start the
    query inside keyed_state(). Times go to the tasks and back as microseconds, whatever their time zone.
    """
    rows = stream.select(key, value, F.col(at).cast("timestamp").alias(at))
    kinds = dict(rows.dtypes)
    log = (
        rows.withWatermark(at, delay)
        .select(key, value, F.unix_micros(at).alias("us"))
        .groupBy(key)
        .transformWithState(ChangeLog(key, value, kinds[value]), f"{key} {kinds[key]}, {value} {kinds[value]}, us long, sign int", "append", "EventTime")
    )
    return log.select(key, value, F.timestamp_micros("us").alias("valid_from"), "sign")


def settled_log(written: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, valid_from): the rows of the log that were added more often than taken back."""
    folded = written.groupBy(key, value, "valid_from").agg(F.sum("sign").alias("n"))
    return folded.filter("n > 0").drop("n")


def change_log(rows: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """The same log of a table, by a window over each key."""
    one = rows.filter(F.col(at).isNotNull()).groupBy(key, at).agg(F.min(value).alias(value))
    before = Window.partitionBy(key).orderBy(at)
    marked = one.withColumn("__first", F.row_number().over(before) == 1).withColumn("__before", F.lag(value).over(before))
    return marked.filter(F.col("__first") | ~F.col(value).eqNullSafe(F.col("__before"))).select(key, value, F.col(at).alias("valid_from"))
