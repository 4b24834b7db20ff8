"""Property snapshots with validity intervals: change-only writes, point-in-time states, histories.

A snapshot is (model_uri, predicate_iri, value, value_uri, extraction_method, confidence, notes, snapshot_hash); the
store adds valid_from and valid_to. Intervals are closed at the start and open at the end. A snapshot that comes back
after it was closed gets a new interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.idents import is_iri, shorten_predicate, snapshot_hash
from quarry.operators.triples import objects, tagged

FIELDS = ["model_uri", "predicate_iri", "value", "value_uri", "extraction_method", "confidence", "notes", "snapshot_hash"]


def extract_snapshots(models: DataFrame, uri: str, predicates: dict[str, str], meta: str | None = None) -> DataFrame:
    """Snapshots of every value of the mapped columns (column -> predicate).

    meta names a map column from predicate (or its short name) to struct(extraction_method, confidence, notes);
    what it lacks is method "unknown" with confidence 1.
    """
    maps = [F.transform(objects(models, c), tagged(p, "p", "v")) for c, p in predicates.items()]
    keep = [F.col(uri).alias("model_uri"), F.explode(F.flatten(F.array(*maps))).alias("t")] + ([F.col(meta).alias("meta")] if meta else [])
    rows = models.select(*keep)
    p, v = F.col("t.p"), F.col("t.v")
    if meta:
        own = F.coalesce(F.try_element_at("meta", p), F.try_element_at("meta", shorten_predicate(p)))
        method, confidence, notes = F.coalesce(own["extraction_method"], F.lit("unknown")), F.coalesce(own["confidence"], F.lit(1.0)), own["notes"]
    else:
        method, confidence, notes = F.lit("unknown"), F.lit(1.0), F.lit(None).cast("string")
    split = rows.select(
        "model_uri", p.alias("predicate_iri"), F.when(~is_iri(v), v).alias("value"), F.when(is_iri(v), v).alias("value_uri"),
        method.alias("extraction_method"), confidence.cast("double").alias("confidence"), notes.alias("notes"),
    )
    hashed = snapshot_hash(*[F.col(c) for c in ("predicate_iri", "value", "value_uri", "extraction_method", "confidence", "notes")])
    return split.withColumn("snapshot_hash", hashed).distinct()


def write_batch(store: DataFrame, batch: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """The store after a batch, and the intervals that are new.

    Open snapshots of the batch's models that the batch no longer has are closed; snapshots that are not open are
    opened; all else stays. Two anti joins on (model_uri, snapshot_hash); models outside the batch are not touched.
    """
    key = ["model_uri", "snapshot_hash"]
    now = batch.select(*FIELDS).dropDuplicates(key)
    active = store.filter(F.col("valid_to").isNull())
    fresh = now.join(active.select(*key), key, "left_anti").select(*FIELDS, at.alias("valid_from"), F.lit(None).cast(store.schema["valid_to"].dataType).alias("valid_to"))
    touched = now.select("model_uri").distinct().withColumn("__touched", F.lit(True))
    seen = now.select(*key).withColumn("__seen", F.lit(True))
    kept = store.join(touched, "model_uri", "left").join(seen, key, "left")
    gone = F.col("valid_to").isNull() & F.col("__touched").isNotNull() & F.col("__seen").isNull()
    closed = kept.withColumn("valid_to", F.when(gone, at).otherwise(F.col("valid_to"))).select(*FIELDS, "valid_from", "valid_to")
    return closed.unionByName(fresh), fresh


def intervals(changes: DataFrame, key: list[str], value: str, at: str) -> DataFrame:
    """Bulk form: (key, value, valid_from, valid_to) from a log of values; only changes open an interval."""
    order = Window.partitionBy(*key).orderBy(at)
    before = F.lag(value).over(order)
    first = F.row_number().over(order) == 1
    moved = changes.withColumn("__new", first | ~before.eqNullSafe(F.col(value))).filter("__new").drop("__new")
    return moved.select(*key, value, F.col(at).alias("valid_from"), F.lead(at).over(Window.partitionBy(*key).orderBy(at)).alias("valid_to"))


def at_time(store: DataFrame, t: Column, inclusive_end: bool = False) -> DataFrame:
    """The intervals that hold at t. inclusive_end also counts those that end at t."""
    end = F.col("valid_to").isNull() | (F.col("valid_to") >= t if inclusive_end else F.col("valid_to") > t)
    return store.filter((F.col("valid_from") <= t) & end)


def reconstruct(store: DataFrame, t: Column) -> DataFrame:
    """(model_uri, predicate_iri, values): every property's values at t, sorted."""
    live = at_time(store, t)
    return live.groupBy("model_uri", "predicate_iri").agg(F.array_sort(F.collect_list(F.coalesce("value", "value_uri"))).alias("values"))


def history(store: DataFrame, key: str, inclusive_end: bool = False) -> DataFrame:
    """The store's rows once for each moment at which something of their key began and they held: adds `moment`.

    An equi join on the key with a range condition; moments are distinct starts of that key only.
    """
    moments = store.select(F.col(key).alias("__k"), F.col("valid_from").alias("moment")).distinct()
    end = F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("moment") if inclusive_end else F.col("valid_to") > F.col("moment"))
    return store.join(moments, (F.col(key) == F.col("__k")) & (F.col("valid_from") <= F.col("moment")) & end).drop("__k")


def _running(rows: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """Running sums of columns over `at` within the keys, by day first, so that no task has a key's whole history."""
    days = rows.withColumn("__day", F.to_date(at))
    by_day = days.groupBy(*keys, "__day").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    earlier = Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    before = by_day.select(*keys, "__day", *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}") for c in columns])
    within = Window.partitionBy(*keys, "__day").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    summed = days.withColumns({c: F.sum(c).over(within) for c in columns}).join(before, [*keys, "__day"])
    return summed.withColumns({c: F.col(c) + F.col(f"__{c}") for c in columns}).drop("__day", *[f"__{c}" for c in columns])


def history_counts(store: DataFrame, key: str, value: str) -> DataFrame:
    """(key, moment, held, kinds): how many rows of the key, and how many values, held at each moment of history().

    +1 at each start and -1 at each end, summed by key, value and moment before the running sums; a value counts
    while its own sum is above zero. Linear in the rows, where history() writes out every row at every moment.
    """
    moves = F.array(
        F.struct(F.col("valid_from").alias("moment"), F.lit(1).alias("step"), F.lit(1).alias("begun")),
        F.struct(F.col("valid_to").alias("moment"), F.lit(-1).alias("step"), F.lit(0).alias("begun")),
    )
    # a null is one group here but no kind, as in count(DISTINCT)
    moved = store.filter(F.col(key).isNotNull()).select(key, value, F.explode(moves).alias("m")).select(key, value, "m.*").filter(F.col("moment").isNotNull())
    steps = moved.groupBy(key, value, "moment").agg(F.sum("step").alias("step"), F.sum("begun").alias("begun"))
    own = steps.withColumns({"__value": F.to_json(F.struct(value)), "held": F.col("step")})
    own = _running(own, [key, "__value"], "moment", ["held"])
    kind = F.when(F.col(value).isNull(), 0).otherwise(F.signum(F.col("held")).cast("long") - F.signum(F.col("held") - F.col("step")).cast("long"))
    by_moment = own.groupBy(key, "moment").agg(F.sum("step").alias("held"), F.sum(kind).alias("kinds"), F.sum("begun").alias("begun"))
    return _running(by_moment, [key], "moment", ["held", "kinds"]).filter("begun > 0 AND held > 0").select(key, "moment", "held", "kinds")


def clamped_as_of(versions: DataFrame, key: str, start: str, end: str, t: Column) -> DataFrame:
    """Rows valid at t, where a t before the first or after the last version counts as the first or the last moment."""
    span = versions.groupBy(key).agg(F.min(start).alias("__lo"), F.max(end).alias("__hi"))
    moved = F.greatest(F.least(t, F.col("__hi") - F.expr("INTERVAL 1 SECOND")), F.col("__lo"))
    return versions.join(span, key).filter((F.col(start) <= moved) & (F.col(end) > moved)).drop("__lo", "__hi")


def current_metadata(store: DataFrame) -> DataFrame:
    """(model_uri, predicate_iri, extraction_method, confidence, notes): of the latest open snapshot."""
    live = store.filter(F.col("valid_to").isNull())
    last = F.max_by(F.struct("extraction_method", "confidence", "notes"), F.struct("valid_from", "snapshot_hash")).alias("m")
    return live.groupBy("model_uri", "predicate_iri").agg(last).select("model_uri", "predicate_iri", "m.extraction_method", "m.confidence", "m.notes")
