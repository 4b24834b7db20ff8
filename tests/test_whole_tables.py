"""Queries over whole tables: every row of the input is in the output."""

import pytest
from pyspark.sql import functions as F

from quarry import catalog
from quarry.functions import text
from quarry.operators import temporal
from quarry.plans import graph_queries
from quarry.session import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("name", "source"),
    [("parameter_count_format", "orders"), ("scaled_numbers", "customer"), ("arxiv_like_extract", "pages"), ("translation_join", "customer"), ("translation_array", "supplier"), ("translation_join_all", "customer"), ("translation_array_all", "supplier")],
)
def test_no_row_is_left_out(spark, name, source):
    assert catalog.QUERIES[name](spark, SF).count() == table(spark, SF, source).count()


def test_full_outer_maps_all_counts_everyone(spark):
    rows = catalog.QUERIES["full_outer_maps_all"](spark, SF).collect()
    assert sum(r.customers for r in rows) == table(spark, SF, "customer").count()
    assert sum(r.suppliers for r in rows) == table(spark, SF, "supplier").count()
    assert any(not r.suppliers for r in rows) and any(not r.customers for r in rows)
    plain = catalog.QUERIES["full_outer_maps"](spark, SF).collect()
    assert sum(r.customers for r in plain) == sum(r.customers for r in rows) and sum(r.suppliers for r in plain) == sum(r.suppliers for r in rows)


def test_half_way_counts_round_away_from_zero(spark):
    df = spark.createDataFrame([(1005,), (1015,), (2_675_000,), (1_005_000_000,), (999_995,), (999,), (1000,)], "v long")
    assert [r.s for r in df.select(text.format_count(df.v).alias("s")).collect()] == ["1.01K", "1.02K", "2.68M", "1.01B", "1000K", "999", "1K"]


def test_history_states_equal_brute_force(spark):
    store = graph_queries.user_intervals(spark, SF).collect()
    want = {}
    for g in range(10):
        own = [r for r in store if r.user_id % 10 == g]
        for moment in {r.valid_from for r in own}:
            live = [r.event_type for r in own if r.valid_from <= moment and (r.valid_to is None or r.valid_to > moment)]
            want[g, f"{moment:%Y-%m-%d %H:%M:%S}"] = (len(live), len(set(live)))
    got = catalog.QUERIES["history_states"](spark, SF).collect()
    assert {(r.g, r.moment): (r.held, r.kinds) for r in got} == want and len(got) == len(want)


def test_history_counts_equal_history(spark):
    rows = [("a", "x", 1, 5), ("a", "x", 2, 2), ("a", None, 3, 9), ("a", "y", 86_400, None), ("a", "x", 5, 86_401), ("b", "x", 7, None), ("b", "x", 7, 8), ("b", "y", 200_000, None)]
    store = spark.createDataFrame(rows, "k string, v string, a long, b long").selectExpr("k", "v", "timestamp_seconds(a) AS valid_from", "timestamp_seconds(b) AS valid_to")
    want = temporal.history(store, "k").groupBy("k", "moment").agg(F.count(F.lit(1)).alias("held"), F.countDistinct("v").alias("kinds"))
    assert sorted(map(tuple, temporal.history_counts(store, "k", "v").collect())) == sorted(map(tuple, want.collect()))
