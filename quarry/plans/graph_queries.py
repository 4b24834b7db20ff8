"""Queries over triples, snapshots and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import idents
from quarry.operators import graph, temporal, triples
from quarry.session import table

_P = "https://schema.org/"
_SUPPLIER = {"s_name": _P + "name", "s_nationkey": _P + "nation", "homepage": _P + "url"}


def supplier_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn("homepage", F.format_string("https://s.example/%d", "s_suppkey"))
    rows = rows.withColumn("s", F.concat(F.lit("urn:s:"), F.col("s_suppkey").cast("string")))
    return triples.to_triples(rows, "s", _SUPPLIER, kind=_P + "Organization")


_TRIPLES = f"""
    t AS (
      SELECT 'urn:s:' || s_suppkey AS s, '{_P}name' AS p, s_name AS o, FALSE AS o_is_iri FROM supplier
      UNION SELECT 'urn:s:' || s_suppkey, '{_P}nation', s_nationkey::VARCHAR, FALSE FROM supplier
      UNION SELECT 'urn:s:' || s_suppkey, '{_P}url', 'https://s.example/' || s_suppkey, TRUE FROM supplier
      UNION SELECT 'urn:s:' || s_suppkey, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', '{_P}Organization', TRUE FROM supplier)
"""


@register("triples_unpivot", f"WITH {_TRIPLES} SELECT * FROM t")
def triples_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_triples(spark, sf_dir)


@register("triples_to_doc", f"WITH {_TRIPLES} SELECT s, string_agg(p || '=' || o, ';' ORDER BY p, o) AS doc FROM t GROUP BY s")
def triples_to_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = triples.to_documents(supplier_triples(spark, sf_dir))
    parts = F.transform(F.map_entries("doc"), lambda e: F.array_join(F.transform(e["value"], lambda o: F.concat(e["key"], F.lit("="), o)), ";"))
    return docs.select("s", F.array_join(parts, ";").alias("doc"))


@register("triples_delete", f"WITH {_TRIPLES} SELECT p, count(*)::BIGINT AS n FROM t WHERE NOT (p = '{_P}nation' AND o IN ('1', '2', '3')) GROUP BY p")
def triples_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = supplier_triples(spark, sf_dir)
    gone = store.filter((F.col("p") == _P + "nation") & F.col("o").isin("1", "2", "3"))
    return triples.delete_triples(store, gone).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@register(
    "n_triples_export",
    f"WITH {_TRIPLES} SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_is_iri THEN '<' || o || '>' ELSE '\"' || o || '\"' END || ' .' AS value FROM t",
)
def n_triples_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.n_triples(supplier_triples(spark, sf_dir))


@register("predicate_values", f"WITH {_TRIPLES} SELECT DISTINCT o FROM t WHERE contains(p, 'url') AND starts_with(o, 'https://s.example/1')")
def predicate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.mentions(supplier_triples(spark, sf_dir), "url", "https://s.example/1")


@register("predicate_short_names", f"WITH {_TRIPLES} SELECT DISTINCT CASE WHEN contains(p, '#') THEN regexp_extract(p, '#([^#]*)$', 1) ELSE regexp_extract(p, '/([^/]*)$', 1) END AS name FROM t")
def predicate_short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_triples(spark, sf_dir).select(idents.shorten_predicate(F.col("p")).alias("name")).distinct()


@register("subjects_with_object_page", f"WITH {_TRIPLES}, d AS (SELECT DISTINCT s FROM t WHERE p = '{_P}nation' AND TRY_CAST(o AS INTEGER) % 2 = 1) SELECT s, (SELECT count(*) FROM d)::BIGINT AS total FROM d ORDER BY s LIMIT 10 OFFSET 0")
def subjects_with_object_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = supplier_triples(spark, sf_dir).filter((F.col("p") == _P + "nation") & (F.col("o").try_cast("int") % 2 == 1)).select("s").distinct()
    total = found.agg(F.count(F.lit(1)).alias("total"))
    return graph.page(found, [F.col("s")], 1, 10).join(F.broadcast(total))  # one row


# --- property snapshots: the event type of a user as a property that changes over time ---


def user_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event a user and second, so that moments are distinct."""
    events = table(spark, sf_dir, "events").withColumn("at", F.date_trunc("second", "ts"))
    one = events.groupBy("user_id", "at").agg(F.min_by("event_type", "event_id").alias("event_type"))
    return temporal.intervals(one, ["user_id"], "event_type", "at")


_INTERVALS = """
    e AS (SELECT user_id, date_trunc('second', ts) AS ts_s, min_by(event_type, event_id) AS event_type FROM events GROUP BY 1, 2),
    c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts_s) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts_s) AS n FROM e),
    i AS (SELECT user_id, event_type, ts_s AS valid_from, lead(ts_s) OVER (PARTITION BY user_id ORDER BY ts_s) AS valid_to FROM c WHERE n = 1 OR b <> event_type)
"""
_TIMES = ("2024-01-05 00:00:00", "2024-01-15 12:00:00", "2024-01-28 06:30:00")


def _said(name: str) -> list:
    return [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in name.split()]


@register(
    "scd2_intervals",
    f"WITH {_INTERVALS} SELECT user_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM i",
)
def scd2_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_intervals(spark, sf_dir).select("user_id", "event_type", *_said("valid_from valid_to"))


@register(
    "reconstruct_at",
    f"WITH {_INTERVALS}, q AS (SELECT unnest([{', '.join(repr(t) for t in _TIMES)}]) AS t) "
    "SELECT t, event_type, count(*)::BIGINT AS users FROM i, q WHERE valid_from <= t::TIMESTAMP AND (valid_to IS NULL OR valid_to > t::TIMESTAMP) GROUP BY t, event_type",
)
def reconstruct_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = user_intervals(spark, sf_dir)
    moments = F.explode(F.array(*[F.lit(t) for t in _TIMES])).alias("t")  # a few stated moments
    live = temporal.at_time(store.select("*", moments), F.col("t").cast("timestamp_ntz"))
    return live.groupBy("t", "event_type").agg(F.count(F.lit(1)).alias("users"))


_HISTORY = f"""WITH {_INTERVALS}, s AS (SELECT user_id % 10 AS g, event_type AS v, valid_from, valid_to FROM i),
    m AS (SELECT g, v, moment, sum(step) AS step, sum(begun) AS begun FROM
      (SELECT g, v, valid_from AS moment, 1 AS step, 1 AS begun FROM s UNION ALL SELECT g, v, valid_to, -1, 0 FROM s WHERE valid_to IS NOT NULL) GROUP BY g, v, moment),
    k AS (SELECT *, sum(step) OVER (PARTITION BY g, v ORDER BY moment) AS live FROM m),
    t AS (SELECT g, moment, sum(step) AS step, sum(begun) AS begun, sum(sign(live) - sign(live - step)) AS kind FROM k GROUP BY g, moment),
    r AS (SELECT g, moment, begun, sum(step) OVER (PARTITION BY g ORDER BY moment) AS held, sum(kind) OVER (PARTITION BY g ORDER BY moment) AS kinds FROM t)
    SELECT g::BIGINT AS g, strftime(moment, '%Y-%m-%d %H:%M:%S') AS moment, held::BIGINT AS held, kinds::BIGINT AS kinds FROM r WHERE begun > 0 AND held > 0"""


@register("history_states", _HISTORY)
def history_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users. The SQL takes running sums as well; a test holds both against every interval at every moment."""
    store = user_intervals(spark, sf_dir).withColumn("g", F.col("user_id") % 10)
    return temporal.history_counts(store, "g", "event_type").select("g", *_said("moment"), "held", "kinds")


@register(
    "legacy_asof_clamped",
    f"""WITH {_INTERVALS}, v AS (SELECT user_id, event_type, valid_from, coalesce(valid_to, valid_from + INTERVAL 30 DAY) AS valid_to FROM i),
    s AS (SELECT user_id, min(valid_from) AS lo, max(valid_to) AS hi FROM v GROUP BY 1)
    SELECT v.user_id, event_type FROM v JOIN s USING (user_id)
    WHERE valid_from <= greatest(least(TIMESTAMP '2024-01-02 00:00:00', hi - INTERVAL 1 SECOND), lo) AND valid_to > greatest(least(TIMESTAMP '2024-01-02 00:00:00', hi - INTERVAL 1 SECOND), lo)""",
)
def legacy_asof_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions; the table has ranges with an end only, so an open one ends 30 days after its start."""
    versions = user_intervals(spark, sf_dir).withColumn("valid_to", F.coalesce("valid_to", F.col("valid_from") + F.expr("INTERVAL 30 DAY")))
    t = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return temporal.clamped_as_of(versions, "user_id", "valid_from", "valid_to", t).select("user_id", "event_type")


def _snapshots(spark: SparkSession, sf_dir: str, changed: bool) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn("uri", F.concat(F.lit("urn:s:"), F.col("s_suppkey").cast("string")))
    if changed:  # a third of the suppliers move, and every seventh loses its name
        rows = rows.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey")))
        rows = rows.withColumn("s_name", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_name")))
    return temporal.extract_snapshots(rows, "uri", {"s_name": _P + "name", "s_nationkey": _P + "nation"})


@register(
    "snapshot_hashes",
    f"""
    SELECT 'urn:s:' || s_suppkey AS model_uri,
      sha256('{{"confidence": 1.0, "extraction_method": "unknown", "notes": null, "predicate_iri": "{_P}name", "value": "' || s_name || '", "value_uri": null}}') AS snapshot_hash FROM supplier
    """,
)
def snapshot_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir, False).filter(F.col("predicate_iri") == _P + "name").select("model_uri", "snapshot_hash")


@register(
    "snapshot_change_batches",
    """
    WITH s AS (SELECT s_suppkey AS k FROM supplier),
    c AS (SELECT count(*) AS n, sum(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) AS moved, sum(CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) AS lost FROM s)
    SELECT 'first' AS batch, (2 * n)::BIGINT AS new, 0::BIGINT AS closed, (2 * n)::BIGINT AS open FROM c
    UNION ALL SELECT 'second', moved::BIGINT, (moved + lost)::BIGINT, (2 * n - lost)::BIGINT FROM c
    UNION ALL SELECT 'again', 0::BIGINT, (moved + lost)::BIGINT, (2 * n - lost)::BIGINT FROM c
    """,
)
def snapshot_change_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda d: F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz")
    schema = "model_uri string, predicate_iri string, value string, value_uri string, extraction_method string, confidence double, notes string, snapshot_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    store, out = spark.createDataFrame([], schema), None
    for name, changed, day in (("first", False, 1), ("second", True, 2), ("again", True, 3)):
        store, fresh = temporal.write_batch(store, _snapshots(spark, sf_dir, changed), at(day))
        counts = store.agg(F.count("valid_to").alias("closed"), F.sum(F.col("valid_to").isNull().cast("long")).alias("open"))
        row = fresh.agg(F.count(F.lit(1)).alias("new")).join(F.broadcast(counts)).select(F.lit(name).alias("batch"), "new", "closed", "open")  # one row
        out = row if out is None else out.unionByName(row)
    return out


# --- graphs: region <- nation <- customer / supplier ---


def edges_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    n = table(spark, sf_dir, "nation").select(text("n", "n_nationkey").alias("src"), F.lit("in_region").alias("rel"), text("r", "n_regionkey").alias("dst"))
    c = table(spark, sf_dir, "customer").select(text("c", "c_custkey").alias("src"), F.lit("customer_of").alias("rel"), text("n", "c_nationkey").alias("dst"))
    s = table(spark, sf_dir, "supplier").select(text("s", "s_suppkey").alias("src"), F.lit("supplier_of").alias("rel"), text("n", "s_nationkey").alias("dst"))
    return n.unionByName(c).unionByName(s)


_EDGES = """
    e AS (SELECT 'n' || n_nationkey AS src, 'in_region' AS rel, 'r' || n_regionkey AS dst FROM nation
          UNION ALL SELECT 'c' || c_custkey, 'customer_of', 'n' || c_nationkey FROM customer
          UNION ALL SELECT 's' || s_suppkey, 'supplier_of', 'n' || s_nationkey FROM supplier)
"""


@register("neighbourhood_1hop", f"WITH {_EDGES} SELECT src AS root, 1 AS hop, src, rel, dst FROM e WHERE src IN ('n1', 'c5', 's3')")
def neighbourhood_1hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.createDataFrame([("n1",), ("c5",), ("s3",)], "id string")
    return graph.neighbourhood(edges_of(spark, sf_dir), ids)


@register(
    "neighbourhood_2hop",
    f"""WITH {_EDGES} SELECT a.src AS root, 1 AS hop, a.src, a.rel, a.dst FROM e a WHERE a.src LIKE 'c%'
    UNION SELECT a.src, 2, b.src, b.rel, b.dst FROM e a JOIN e b ON a.dst = b.src WHERE a.src LIKE 'c%'""",
)
def neighbourhood_2hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = edges_of(spark, sf_dir)
    return graph.neighbourhood(edges, edges.filter(F.startswith("src", F.lit("c"))).select(F.col("src").alias("id")), depth=2)


@register("models_by_entity", f"WITH {_EDGES} SELECT model, min(rel) AS rel FROM (SELECT src AS model, rel FROM e WHERE dst = 'n3' UNION ALL SELECT dst, rel FROM e WHERE src = 'n3') GROUP BY model")
def models_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.touching(edges_of(spark, sf_dir), "n3")


@register(
    "grouped_facet_values",
    f"""WITH {_EDGES}, n AS (SELECT 'n' || n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name FROM region)
    SELECT rel, coalesce(name, dst) AS value, count(DISTINCT src)::BIGINT AS n FROM e LEFT JOIN n ON dst = id GROUP BY 1, 2""",
)
def grouped_facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string")).alias("id")
    nodes = table(spark, sf_dir, "nation").select(text("n", "n_nationkey"), F.col("n_name").alias("name"))
    nodes = nodes.unionByName(table(spark, sf_dir, "region").select(text("r", "r_regionkey"), F.col("r_name").alias("name")))
    return graph.grouped_values(edges_of(spark, sf_dir), nodes)


@register("entity_by_name", "SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) = lower('NaTiOn_3') ORDER BY n_nationkey LIMIT 1")
def entity_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "nation").filter(F.lower("n_name") == F.lower(F.lit("NaTiOn_3")))
    return found.orderBy("n_nationkey").limit(1).select("n_nationkey", "n_name")


@register(
    "ancestors_bounded",
    """WITH RECURSIVE a AS (SELECT p_partkey AS id, p_partkey // 2 AS ancestor, 1 AS depth FROM part WHERE p_partkey > 1
      UNION ALL SELECT id, ancestor // 2, depth + 1 FROM a WHERE ancestor > 1 AND depth < 3)
    SELECT id, ancestor, depth FROM a""",
)
def ancestors_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").filter("p_partkey > 1").select(F.col("p_partkey").alias("id"))
    parents = parts.withColumn("parent", F.expr("id div 2"))
    return graph.ancestors(parents, parts, rounds=3)


@register("rels_by_node_batch", f"WITH {_EDGES} SELECT rel, string_agg(DISTINCT dst, ',' ORDER BY dst) AS targets FROM e WHERE src IN ('c1', 'c2', 's1', 's2', 'n0') GROUP BY rel")
def rels_by_node_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.createDataFrame([("c1",), ("c2",), ("s1",), ("s2",), ("n0",)], "src string")
    found = edges_of(spark, sf_dir).join(F.broadcast(ids), "src", "left_semi")  # five stated ids
    return found.groupBy("rel").agg(F.array_join(F.array_sort(F.collect_set("dst")), ",").alias("targets"))


@register("node_degree_top", f"WITH {_EDGES} SELECT dst, count(*)::BIGINT AS n FROM e GROUP BY dst ORDER BY n DESC, dst LIMIT 10")
def node_degree_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_of(spark, sf_dir).groupBy("dst").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dst").limit(10)
