"""The change log of a stream equals that of the table, however the records are dealt to files and whatever their order."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from quarry.streaming import incremental

START = datetime(2024, 1, 1)
SCHEMA = "k string, v string, at timestamp, other long"


def streamed(spark, folder, files, delay):
    """The folded log of a stream that reads the files one a batch."""
    for i, rows in enumerate(files):
        spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
        (folder / f"in/{i}").touch()
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    log = incremental.changes(stream, "k", "v", "at", delay)
    with incremental.keyed_state(spark):
        run = log.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/log")
    run.awaitTermination()
    written = spark.read.schema(log.schema).parquet(f"{folder}/log")
    return sorted(map(tuple, incremental.settled_log(written, "k", "v").collect()), key=str)


def brute(rows):
    out, by_key = [], {}
    for k, v, t in rows:
        if t is not None:
            at = by_key.setdefault(k, {})
            at[t] = v if at.get(t) is None else at[t] if v is None else min(v, at[t])
    for k, at in by_key.items():
        last = object()
        for t in sorted(at):
            if at[t] != last:
                out.append((k, at[t], t))
            last = at[t]
    return sorted(out, key=str)


def events(seed, n=300):
    rng = np.random.default_rng(seed)
    rows = [(["a", "b", None][min(int(rng.integers(0, 5)), 2)], ["x", "y", "z", None][int(rng.integers(0, 4))], START + timedelta(seconds=int(rng.integers(0, 90)))) for _ in range(n)]
    return rows + [("a", "x", None), ("b", "y", START), ("b", "x", START)]


@pytest.mark.parametrize("files", [1, 4])
def test_any_order_and_split(spark, tmp_path, files):
    rows = events(files)
    order = np.random.default_rng(files + 10).permutation(len(rows))
    parts = [[rows[i] for i in order[k::files]] for k in range(files)]
    assert streamed(spark, tmp_path, parts, "1 hour") == brute(rows)


def test_the_table_gives_the_same(spark):
    rows = events(5)
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, incremental.change_log(table, "k", "v", "at").collect()), key=str) == brute(rows)


def test_late_records_correct_the_log_until_the_watermark(spark, tmp_path):
    t = lambda s: START + timedelta(seconds=s)
    files = [
        [("a", "x", t(10)), ("a", "x", t(30))],
        [("a", "y", t(20))],  # between two equal values: y and x again are changes now
        [("a", "x", t(100))],  # moves the watermark to 60 s
        [("a", "late", t(15)), ("a", "z", t(70))],  # the first is beyond the watermark, the second is not
        [("a", "z", t(80)), ("a", "x", t(90))],  # z stays as it is
    ]
    assert streamed(spark, tmp_path, files, "40 seconds") == [("a", "x", t(10)), ("a", "x", t(30)), ("a", "x", t(90)), ("a", "y", t(20)), ("a", "z", t(70))]


def test_nan_is_a_value_of_its_own(spark, tmp_path):
    """As in the table's log: NaN is not null, equals itself and goes behind all numbers."""
    nan, t = float("nan"), lambda s: START + timedelta(seconds=s)
    rows = [("a", 1.0, t(1)), ("a", nan, t(2)), ("a", nan, t(3)), ("a", None, t(4)), ("a", nan, t(5)), ("a", nan, t(5)), ("a", 2.0, t(6)), ("a", nan, t(6)), ("b", None, t(1)), ("b", nan, t(1))]
    schema = "k string, v double, at timestamp"
    for i in range(2):
        spark.createDataFrame(rows[i::2], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    log = incremental.changes(stream, "k", "v", "at", "1 hour")
    with incremental.keyed_state(spark):
        run = log.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/log")
    run.awaitTermination()
    got = incremental.settled_log(spark.read.schema(log.schema).parquet(f"{tmp_path}/log"), "k", "v")
    want = incremental.change_log(spark.createDataFrame(rows, schema), "k", "v", "at")
    assert want.count() == 6 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
