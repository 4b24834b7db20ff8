"""Queries over model lists, entity properties, versions and record cells, with parts and customers standing in for records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import dates, idents, props, text
from quarry.operators import catalogue, identify, listing, records, search, temporal, triples, versions
from quarry.session import table

GRAPH = idents.GRAPH


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as listed models: a fifth has no licence, a seventh no keywords."""
    k = F.col("p_partkey")
    mark = F.when(k % 4 == 0, "-7B").when(k % 4 == 1, "-large").when(k % 4 == 2, "-v2").otherwise("")
    return table(spark, sf_dir, "part").select(
        k.alias("id"),
        F.array(F.concat(F.lit("doi:"), k.cast("string")), F.concat(F.lit(GRAPH), k.cast("string"))).alias("db_identifier"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), mark).alias("name"),
        F.when(k % 3 == 0, F.concat(F.lit("https://huggingface.co/"), k)).when(k % 3 == 1, F.concat(F.lit("https://www.openml.org/f/"), k)).otherwise(F.concat(F.lit("https://bioimage.io/"), k)).alias("url"),
        F.col("p_brand").alias("shared_by"), F.lit("2024").alias("datecreated"), F.lit("2024").alias("datemodified"), F.col("p_type").alias("description"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " ")).alias("keywords"),
        F.when(k % 5 == 0, "Unknown").otherwise("mit").alias("license"), F.lit("r").alias("readme"),
        F.array(F.col("p_type"), F.concat(F.lit("size"), (F.col("p_size") % 3).cast("string"))).alias("ml_tasks"), F.lit("HF").alias("source"),
    )


_M = """
    m AS (SELECT p_partkey AS id, replace(p_name, ' ', '-') || CASE p_partkey % 4 WHEN 0 THEN '-7B' WHEN 1 THEN '-large' WHEN 2 THEN '-v2' ELSE '' END AS name,
                 replace(p_name, ' ', '-') AS bare, p_brand AS shared_by, p_type AS description,
                 CASE WHEN p_partkey % 7 = 0 THEN []::VARCHAR[] ELSE string_split(p_name, ' ') END AS keywords,
                 CASE WHEN p_partkey % 5 = 0 THEN 'Unknown' ELSE 'mit' END AS license, [p_type, 'size' || (p_size % 3)] AS ml_tasks FROM part),
    l AS (SELECT * FROM m WHERE len(keywords) > 0 AND license <> 'Unknown')
"""


@register("listed_models", f"WITH {_M} SELECT id, name FROM l")
def listed_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.listed(_models(spark, sf_dir)).select("id", "name")


_HIT = "(CASE WHEN contains(lower(name), 'cold') THEN 2.0 ELSE 0 END + CASE WHEN contains(lower(description), 'cold') THEN 2.5 ELSE 0 END)"


@register(
    "faceted_search_page",
    f"""WITH {_M}, f AS (SELECT *, {_HIT} AS score FROM l WHERE list_contains(ml_tasks, 'size1') AND {_HIT} > 0),
    p AS (SELECT id FROM f WHERE id % 3 <> 0 ORDER BY score DESC, id LIMIT 15),
    c AS (SELECT 'shared_by' AS facet, shared_by AS value, count(*) AS n FROM f GROUP BY shared_by UNION ALL SELECT 'ml_tasks', unnest(list_distinct(ml_tasks)) AS v, count(*) FROM f GROUP BY v),
    r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rk FROM c)
    SELECT 'page' AS part, id::VARCHAR AS value, 1::BIGINT AS n FROM p
    UNION ALL SELECT facet, value, n::BIGINT FROM r WHERE rk <= CASE facet WHEN 'shared_by' THEN 5 ELSE 3 END
    UNION ALL SELECT 'total', 'total', count(*)::BIGINT FROM f""",
)
def faceted_search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page, facets and total of one search: minimum metadata, boosted text, a filter, and rows of earlier pages left out."""
    docs = listing.listed(_models(spark, sf_dir))
    seen = docs.filter("id % 3 = 0").select("id")
    page, counts, total = listing.faceted_search(
        docs, "id", "cold", {"name": 2.0, "description": 2.5}, {"ml_tasks": ["size1"]}, seen, {"shared_by": 5, "ml_tasks": 3}, number=2, size=15
    )
    out = page.select(F.lit("page").alias("part"), F.col("id").cast("string").alias("value"), F.lit(1).cast("long").alias("n"))
    out = out.unionByName(counts.select(F.col("facet").alias("part"), "value", "n"))
    return out.unionByName(total.select(F.lit("total").alias("part"), F.lit("total").alias("value"), F.col("total").alias("n")))


@register("facet_config", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{f.field}', '{f.label}', '{f.kind}', {f.many_values}, {f.size}, {f.searchable}, {f.pinned})" for k, f in listing.FACETS.items()) + ") AS t(facet, field, label, kind, many_values, size, searchable, pinned)")
def facet_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.facet_table(spark)


@register("id_lookup", "SELECT p_partkey AS id, p_brand AS shared_by FROM part WHERE p_partkey = 17")
def id_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.by_identifier(_models(spark, sf_dir), "db_identifier", F.lit(GRAPH + "17"), "id").select("id", "shared_by")


_REF = f"WITH {_M}, r AS (SELECT * FROM m WHERE id = 3)"


@register("related_by_tasks", f"{_REF} SELECT m.id, len(list_intersect(m.ml_tasks, r.ml_tasks))::INTEGER AS shared FROM m, r WHERE m.id <> r.id AND len(list_intersect(m.ml_tasks, r.ml_tasks)) > 0")
def related_by_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    return listing.sharing(models, models.filter("id = 3"), "id", "ml_tasks").select("id", "shared")


@register("related_by_keywords", f"{_REF} SELECT m.id, len(list_intersect(list_distinct(m.keywords), r.keywords[1:5]))::INTEGER AS shared FROM m, r WHERE m.id <> r.id AND len(list_intersect(m.keywords, r.keywords[1:5])) > 0")
def related_by_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share one of the reference's first five keywords."""
    models = _models(spark, sf_dir)
    return listing.sharing(models, models.filter("id = 3"), "id", "keywords", first=5).select("id", "shared")


@register("related_by_base", "SELECT p_partkey AS id FROM part, (SELECT p_brand AS b FROM part WHERE p_partkey = 3) WHERE p_brand = b AND p_partkey <> 3")
def related_by_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir).withColumn("base", F.array("shared_by"))
    return listing.sharing(models, models.filter("id = 3"), "id", "base").select("id")


@register("related_sizes", f"{_REF} SELECT m.id, m.bare AS base FROM m, r WHERE m.id <> r.id AND contains(lower(m.name), lower(r.bare)) AND length(r.bare) > 3")
def related_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    return listing.other_sizes(models, models.filter("id = 3"), "id", "name").select("id", text.without_size(F.col("name")).alias("base"))


@register("related_filtered", f"{_REF} SELECT m.id FROM m, r WHERE m.id <> r.id AND len(list_intersect(m.ml_tasks, r.ml_tasks)) > 0 AND m.license = 'mit' AND m.shared_by IN ('Brand#5', 'Brand#13')")
def related_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    found = listing.sharing(models, models.filter("id = 3"), "id", "ml_tasks")
    return listing.only(found, {"license": ["mit"], "shared_by": ["Brand#5", "Brand#13"]}).select("id")


@register("ordered_by_name_or_id", f"WITH {_M} SELECT id, CASE WHEN id % 2 = 0 THEN name END AS name FROM m ORDER BY coalesce(CASE WHEN id % 2 = 0 THEN name END, id::VARCHAR), id LIMIT 12 OFFSET 24")
def ordered_by_name_or_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _models(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, F.col("name")).alias("name"))
    return rows.orderBy(F.coalesce("name", F.col("id").cast("string")), "id").offset(24).limit(12)


@register("keyset_by_score", "SELECT doc_id, n_chars FROM documents WHERE n_chars < 900 OR (n_chars = 900 AND doc_id > 50) ORDER BY n_chars DESC, doc_id LIMIT 20")
def keyset_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind (score 900, id 50) in the order of descending score and ascending id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    behind = docs.filter((F.col("n_chars") < 900) | ((F.col("n_chars") == 900) & (F.col("doc_id") > 50)))
    return behind.orderBy(F.desc("n_chars"), "doc_id").limit(20)


@register("epoch_date_filter", "SELECT count(*)::BIGINT AS n, count(*) FILTER (strftime(o_orderdate, '%Y-%m-%d') = '1997-01-15')::BIGINT AS on_day FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1996-03-01' AND '1997-01-15'")
def epoch_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    kept = table(spark, sf_dir, "orders").filter(listing.epoch_filter(at, "1996-03-01,1997-01-15"))
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count_if(listing.epoch_filter(at, "1997-01-15")).alias("on_day"))


# --- fixed rules over text ---

_PHRASES = ("instance segmentation", "Semantic_Segmentation", "cell segmentation", "text classification", "object-detection", "restoration", "denoising", "super resolution", "inpainted", "tracking", "registration", "counting", "detections", "resegmentation", "nothing")
_PHRASE_SQL = "[" + ", ".join(f"'{p}'" for p in _PHRASES) + "]"
_TASKS_SQL = ", ".join(f"CASE WHEN regexp_matches(lower(t), '{p}') THEN '{n}' END" for n, p in text.TASK_PATTERNS)


@register(
    "task_patterns",
    f"""WITH t AS (SELECT p_partkey, {_PHRASE_SQL}[p_partkey % 15 + 1] || ' of ' || p_name || ' and ' || {_PHRASE_SQL}[p_partkey // 15 % 15 + 1] AS t FROM part)
    SELECT p_partkey, array_to_string([x FOR x IN [{_TASKS_SQL}] IF x IS NOT NULL], ',') AS tasks FROM t""",
)
def task_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = lambda i: F.get(F.array(*[F.lit(p) for p in _PHRASES]), i)
    said = F.concat(phrase(F.col("p_partkey") % 15), F.lit(" of "), F.col("p_name"), F.lit(" and "), phrase(F.expr("p_partkey div 15 % 15")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.tasks_in(said), ",").alias("tasks"))


@register(
    "tasks_with_fallback",
    f"""WITH t AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'cell-' || replace({_PHRASE_SQL}[p_partkey % 15 + 1], ' ', '-') WHEN 1 THEN {_PHRASE_SQL}[p_partkey % 15 + 1] ELSE {_PHRASE_SQL}[(p_partkey + 4) % 15 + 1] END AS t FROM part)
    SELECT p_partkey, array_to_string(list_sort([x FOR x IN [{_TASKS_SQL.replace('lower(t)', "lower(CASE WHEN p_partkey % 3 = 0 THEN replace(t, '_', '-') ELSE t END)")}] IF x IS NOT NULL]), ',') AS tasks FROM t""",
)
def tasks_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks from tags, else from the description, else from the documentation."""
    k = F.col("p_partkey")
    phrase = lambda i: F.get(F.array(*[F.lit(p) for p in _PHRASES]), i % 15)
    tags = F.when(k % 3 == 0, F.array(F.lit(" plain "), F.concat(F.lit("cell  "), phrase(k)))).otherwise(F.array(F.lit("none")))
    found = text.tasks_of(tags, F.when(k % 3 == 1, phrase(k)), F.when(k % 3 == 2, phrase(k + 4)))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(found), ",").alias("tasks"))


_NAMES = ("Ada Vincent", "Labat Incorp", "Widget Inc", "Acme lab", "Metal Worker", "Meta AI", "University of X", "OpenAI", "Foo GmbH", "Gmbher", "Anthropic", "Rock Foundation", "Ltdson", "Bar Ltd", "Google", "Corporation Y", "Jane Instituter")


@register(
    "author_kinds",
    "WITH n AS (SELECT c_custkey, [" + ", ".join(f"'{n}'" for n in _NAMES) + "][c_custkey % 17 + 1] || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ' ' || c_custkey END AS name FROM customer) "
    "SELECT c_custkey, name, CASE WHEN " + " OR ".join(f"contains(lower(name), '{h}')" for h in text.ORGANISATIONS) + " THEN 'Organization' ELSE 'Person' END AS kind FROM n",
)
def author_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat(F.get(F.array(*[F.lit(n) for n in _NAMES]), k % 17), F.when(k % 2 == 0, "").otherwise(F.concat(F.lit(" "), k.cast("string"))))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), text.author_kind(name).alias("kind"))


@register(
    "citation_chunk",
    """WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'code' ELSE 'granular' END AS type, CASE turn % 3 WHEN 0 THEN 'Citation' WHEN 1 THEN 'How to cite: citation info' ELSE 'Citations' END AS phtext FROM conversations)
    SELECT conv_id, turn, type FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY type <> 'code', turn, phtext) AS n FROM c WHERE regexp_matches(lower(phtext), '\\bcitation\\b')) WHERE n = 1""",
)
def citation_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each card the first chunk under a heading with the word citation, code before others."""
    t = F.col("turn") % 3
    heading = F.when(t == 0, "Citation").when(t == 1, "How to cite: citation info").otherwise("Citations")
    kind = F.when(F.col("role") == "assistant", "code").otherwise("granular")
    chunks = table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("type"), heading.alias("phtext"))
    best = F.min(F.struct((F.col("type") != "code").alias("other"), "turn", "phtext", "type")).alias("b")
    return chunks.filter(F.lower("phtext").rlike(r"\bcitation\b")).groupBy("conv_id").agg(best).select("conv_id", "b.turn", "b.type")


@register(
    "weights_labels",
    """WITH c AS (SELECT o_orderkey, o_custkey::BIGINT * 1000003 AS v FROM orders),
    f AS (SELECT *, CASE WHEN v >= 1000000000 THEN 9 WHEN v >= 1000000 THEN 6 WHEN v >= 1000 THEN 3 ELSE 0 END AS p FROM c),
    h AS (SELECT *, CASE WHEN p > 0 THEN (v + 5 * (10::BIGINT ** (p - 3))::BIGINT) // (10::BIGINT ** (p - 2))::BIGINT END AS q FROM f),
    t AS (SELECT *, CASE p WHEN 0 THEN v::VARCHAR ELSE rtrim(rtrim((q // 100)::VARCHAR || '.' || lpad((q % 100)::VARCHAR, 2, '0'), '0'), '.') || CASE p WHEN 3 THEN 'K' WHEN 6 THEN 'M' ELSE 'B' END END AS label FROM h)
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'F32=' || label || ',I8=5' WHEN 1 THEN 'total=' || CASE WHEN v > 0 THEN label ELSE '' END WHEN 2 THEN 'total=' || (o_orderkey % 9 + 1) || 'B' END AS sizes FROM t""",
)
def weights_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes by weights' kind, else in all, else from the name."""
    k, v = F.col("o_orderkey") % 4, F.col("o_custkey").cast("long") * 1000003
    counts = F.when(k == 0, F.create_map(F.lit("F32"), v, F.lit("I8"), F.lit(5).cast("long")))
    name = F.when(k == 2, F.concat(F.lit("org/m-"), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("b"))).otherwise("org/plain")
    sizes = text.parameter_labels(counts, F.when(k == 1, v), name)
    said = F.array_join(F.transform(F.array_sort(F.map_entries(sizes)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ",")
    return table(spark, sf_dir, "orders").select("o_orderkey", said.alias("sizes"))


@register(
    "query_parts",
    "SELECT p_partkey, p_name AS phrases, lower(p_type) || ' model-' || p_partkey AS tokens FROM part",
)
def query_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit(' Find "'), F.initcap("p_name"), F.lit('" models, of '), F.col("p_type"), F.lit("! the Model-"), F.col("p_partkey").cast("string"), F.lit(" as"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.quoted_phrases(said), ",").alias("phrases"), text.clean_query(said).alias("tokens"))


@register("source_sites", "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'https://ror.org/02grspc61' WHEN 1 THEN 'https://www.openml.org' ELSE 'https://ai4life.eurobioimaging.eu' END AS site FROM part")
def source_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _models(spark, sf_dir).select("id", text.site_of(F.col("url")).alias("site"))


@register(
    "people_of_cells",
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name || '|https://orcid.org/0-' || c_custkey WHEN 1 THEN c_name || '|https://github.com/u' || c_custkey
      WHEN 2 THEN c_name || '|;B|' WHEN 3 THEN c_name || '|' ELSE '' END AS people FROM customer""",
)
def people_of_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author cells: objects with an ORCID or a user, names in a list, one name, nothing."""
    k, n = F.col("c_custkey") % 5, F.col("c_name")
    key = F.col("c_custkey").cast("string")
    cell = (
        F.when(k == 0, F.concat(F.lit('[{"name": "'), n, F.lit('", "orcid": "0-'), key, F.lit('", "github_user": "u"}]')))
        .when(k == 1, F.concat(F.lit('{"name": "'), n, F.lit('", "github_user": "u'), key, F.lit('"}')))
        .when(k == 2, F.concat(F.lit('["'), n, F.lit('", "B"]')))
        .when(k == 3, n)
        .otherwise("")
    )
    said = F.array_join(F.transform(text.people(cell), lambda p: F.concat(p["name"], F.lit("|"), p["url"])), ";")
    return table(spark, sf_dir, "customer").select("c_custkey", said.alias("people"))


@register(
    "croissant_picks",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'L' || c_custkey ELSE 'u:' || c_custkey END AS license, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'C' || c_custkey ELSE 'First' END AS creator,
      CASE c_custkey % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'a,b' ELSE '' END AS keywords FROM customer""",
)
def croissant_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset metadata whose fields are texts, lists or objects."""
    k, key = F.col("c_custkey") % 3, F.col("c_custkey").cast("string")
    meta = (
        F.when(k == 0, F.concat(F.lit('{"license": "mit", "creator": "'), F.col("c_name"), F.lit('", "keywords": "one"}')))
        .when(k == 1, F.concat(F.lit('{"license": ["L'), key, F.lit('", "x"], "creator": {"name": "C'), key, F.lit('"}, "keywords": ["a", "", "b"]}')))
        .otherwise(F.concat(F.lit('{"license": {"url": "u:'), key, F.lit('"}, "creator": [{"name": "First"}, {"name": "Second"}]}')))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.json_pick(meta, "$.license", "$.license[0]", "$.license.@id", "$.license.url").alias("license"),
        text.json_pick(meta, "$.creator", "$.creator.name", "$.creator.@id", "$.creator[0].name", "$.creator[0]").alias("creator"),
        F.array_join(text.json_list(meta, "$.keywords"), ",").alias("keywords"),
    )


@register("keyword_cells", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'a,b' ELSE replace(p_name, ' ', ',') END AS keywords FROM part")
def keyword_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    cell = F.when(k == 0, F.lit('["a", " b ", "a", ""]')).when(k == 1, F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(","))).otherwise(F.to_json(F.split("p_name", " ")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.keyword_cell(cell), ",").alias("keywords"))


# --- ids, runs, configuration ---


@register("id_columns", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'i' || c_custkey ELSE 'm' || c_custkey END AS key, CASE c_custkey % 3 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey + 1000 END::BIGINT AS dataset_id FROM customer")
def id_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record's id or, without one, its model id; a dataset's id as a number or wrapped as [{"data": id}]."""
    k = F.col("c_custkey")
    key = F.coalesce(F.when(k % 2 == 0, F.concat(F.lit("i"), k.cast("string"))), F.concat(F.lit("m"), k.cast("string")))
    cell = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat(F.lit('[{"data": '), (k + 1000).cast("string"), F.lit("}]"))).otherwise('[{"data": "x"}]')
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key"), identify.wrapped_id(cell).alias("dataset_id"))


@register(
    "runs_to_datasets",
    """WITH r AS (SELECT event_id AS run_id, user_id AS dataset_id FROM events WHERE event_id <> 1), d AS (SELECT c_custkey AS dataset_id, c_name AS name FROM customer WHERE c_custkey % 4 <> 0)
    SELECT dataset_id, name, count(*)::BIGINT AS runs FROM r LEFT JOIN d USING (dataset_id) WHERE dataset_id IS NOT NULL GROUP BY dataset_id, name""",
)
def runs_to_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs (without run 1) to the ids of their datasets, to what is known of these."""
    runs = table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id"), F.col("user_id").alias("dataset_id"))
    used = catalogue.usable_runs(runs, "run_id", "dataset_id").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("runs"))
    known = table(spark, sf_dir, "customer").filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("dataset_id"), F.col("c_name").alias("name"))
    return used.join(known, "dataset_id", "left").select("dataset_id", "name", "runs")


@register("listed_ids_keep_last", "SELECT user_id, max(event_id) AS event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) GROUP BY user_id")
def listed_ids_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of listed ids, the last of each."""
    ids = table(spark, sf_dir, "customer").filter("c_nationkey < 5").select(F.col("c_custkey").alias("user_id"))
    own = table(spark, sf_dir, "events").join(ids, "user_id", "left_semi")
    return records.keep_last(own, ["user_id"], [F.desc("event_id")]).select("user_id", "event_id")


@register(
    "language_lookup",
    """WITH c AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN upper(lang) || '-XX' WHEN 2 THEN CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'deu' ELSE 'qqq' END ELSE 'zz-' || lang END AS code FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 4 = 2 THEN CASE code WHEN 'eng' THEN 'English' WHEN 'deu' THEN 'German' END ELSE CASE lower(code[1:2]) WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' END END AS name,
      coalesce(1.0, 0)::DOUBLE AS confidence FROM c""",
)
def language_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of two letters, of three, or with a region; unknown ones have no name. Confidence is 1 where none is given."""
    known = spark.createDataFrame([("en", "eng", "English"), ("de", "deu", "German"), ("fr", "fra", "French"), ("es", "spa", "Spanish")], "alpha_2 string, alpha_3 string, name string")
    k, lang = F.col("doc_id") % 4, F.col("lang")
    code = F.when(k == 0, lang).when(k == 1, F.concat(F.upper(lang), F.lit("-XX"))).when(k == 2, F.when(lang == "en", "eng").when(lang == "de", "deu").otherwise("qqq")).otherwise(F.concat(F.lit("zz-"), lang))
    docs = table(spark, sf_dir, "documents").select("doc_id", code.alias("code"), F.lit(None).cast("double").alias("confidence"))
    return catalogue.language_names(docs, "code", known).select("doc_id", "name", F.coalesce("confidence", F.lit(1.0)).alias("confidence"))


# --- property maps ---


def _entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda c: F.array(F.col(c).cast("string"))
    keyword = F.array(F.concat(F.lit("https://k.example/"), (F.col("s_suppkey") % 5).cast("string")), F.concat(F.lit("https://k.example/"), (F.col("s_suppkey") % 3).cast("string")))
    gone = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("Information not found"), F.lit(""))).otherwise(F.array(F.lit("about"), F.lit(None).cast("string")))
    values = F.create_map(F.lit("schema__name"), one("s_name"), F.lit("schema__description"), gone, F.lit("schema__keywords"), keyword, F.lit("fair4ml__nation"), one("s_nationkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", values.alias("values"))


def _lines(values) -> F.Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(values)), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "/"))), ";")


@register(
    "entity_detail",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'description=about;' END || 'keywords=https://k.example/' || (s_suppkey % 5) || '/https://k.example/' || (s_suppkey % 3) || ';nation=overlaid;title=' || s_name || ';type=fair4ml__MLModel' AS detail FROM supplier""",
)
def entity_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's response: pruned properties as lists by short and renamed keys, with types, overlaid by the graph's."""
    own = props.as_lists(props.prune(F.col("values")), F.array(F.lit("Resource"), F.lit("fair4ml__MLModel")))
    short = props.renamed(props.short_keys(own), {"name": "title"})
    full = props.overlaid(short, F.create_map(F.lit("nation"), F.array(F.lit("overlaid"))))
    return _entity(spark, sf_dir).select("s_suppkey", _lines(full).alias("detail"))


@register("entity_links", "SELECT s_suppkey, CASE WHEN s_suppkey % 5 = s_suppkey % 3 THEN 'https://k.example/' || (s_suppkey % 5) ELSE 'https://k.example/' || least(s_suppkey % 5, s_suppkey % 3) || ',https://k.example/' || greatest(s_suppkey % 5, s_suppkey % 3) END AS links FROM supplier")
def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity(spark, sf_dir).select("s_suppkey", F.array_join(props.links(F.col("values")), ",").alias("links"))


@register(
    "keyword_terms",
    "SELECT s_suppkey, string_agg(DISTINCT 'term ' || k, ',' ORDER BY 'term ' || k) AS keywords FROM (SELECT s_suppkey, unnest([s_suppkey % 5, s_suppkey % 3]) AS k FROM supplier) WHERE k <> 4 GROUP BY s_suppkey",
)
def keyword_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the keyword entities that are defined terms, in lower case."""
    nodes = spark.createDataFrame([(f"https://k.example/{i}", ["schema__DefinedTerm" if i != 4 else "schema__Thing"], f"Term {i}") for i in range(5)], "id string, types array<string>, name string")
    found = catalogue.defined_terms(_entity(spark, sf_dir).select("s_suppkey", F.explode(F.col("values")["schema__keywords"]).alias("keyword")), "keyword", nodes)
    return found.groupBy("s_suppkey").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("keywords"))


# --- versions and snapshot stores ---


def _legacy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    who = F.concat(F.lit("m"), F.col("o_custkey").cast("string")).alias("subject")
    own = o.select(F.col("o_orderkey").alias("id"), who, F.lit("status").alias("predicate"), F.col("o_orderstatus").alias("object"))
    ranges = o.select(F.col("o_orderkey").alias("triplet_id"), F.col("o_orderdate").alias("use_start"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("use_end"), (F.col("o_orderkey") % 3 == 0).alias("deprecated"), (F.col("o_orderkey") % 2).cast("long").alias("extraction_info_id"))
    info = spark.createDataFrame([(0, "parsed", 1.0), (1, "inferred", 0.5)], "id long, method_description string, extraction_confidence double")
    return own, ranges, info


@register("legacy_current", "SELECT DISTINCT 'm' || o_custkey AS subject, 'status' AS predicate, o_orderstatus AS object FROM orders WHERE o_orderkey % 3 <> 0")
def legacy_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, ranges, _ = _legacy(spark, sf_dir)
    return versions.current_triples(own, ranges)


@register(
    "legacy_with_extraction",
    "SELECT 'm' || o_custkey AS subject, o_orderstatus AS object, o_orderkey % 3 = 0 AS deprecated, CASE o_orderkey % 2 WHEN 0 THEN 'parsed' ELSE 'inferred' END AS method_description, count(*)::BIGINT AS n, max(strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d')) AS last_end FROM orders GROUP BY ALL",
)
def legacy_with_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = versions.triples_with_extraction(*_legacy(spark, sf_dir))
    return rows.groupBy("subject", "object", "deprecated", "method_description").agg(F.count(F.lit(1)).alias("n"), F.date_format(F.max("use_end"), "yyyy-MM-dd").alias("last_end"))


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn("uri", F.concat(F.lit("urn:s:"), F.col("s_suppkey").cast("string")))
    batch = temporal.extract_snapshots(rows, "uri", {"s_name": "https://schema.org/name", "s_nationkey": "https://schema.org/nation"})
    return batch.select(*temporal.FIELDS, F.lit("2024-01-01 00:00:00").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))


@register("snapshot_export", "SELECT 'urn:s:' || s_suppkey AS model_uri, 2 AS n, s_name AS name FROM supplier")
def snapshot_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store as one JSON text a model, read back."""
    kind = "array<struct<predicate_iri: string, value: string, valid_from: string>>"
    out = versions.export_rows(_store(spark, sf_dir)).withColumn("s", F.from_json("snapshots", kind))
    name = F.get(F.filter("s", lambda x: F.endswith(x["predicate_iri"], F.lit("/name"))), 0)["value"]
    return out.select("model_uri", F.size("s").alias("n"), name.alias("name"))


@register("snapshot_cleanup", "SELECT count(*)::BIGINT * 2 AS n, 0::BIGINT AS repeated FROM supplier WHERE s_suppkey % 4 <> 1")
def snapshot_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store without some models, and how many of its keys break the constraint."""
    store = _store(spark, sf_dir)
    gone = store.filter(F.substring_index("model_uri", ":", -1).cast("long") % 4 == 1).select("model_uri")
    left = versions.without_models(store, gone)
    repeated = versions.repeated_keys(left, ["model_uri", "snapshot_hash"]).agg(F.count(F.lit(1)).alias("repeated"))
    return left.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(repeated))  # one row each


@register("retained_runs", "SELECT strftime(ts, '%Y-%m-%d') || '_00-00-00_x' AS run, count(*)::BIGINT AS n FROM events WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1")
def retained_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "events").select(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_00-00-00_x")).alias("run"))
    kept = versions.kept_runs(files, "run", dates.folder_date(F.col("run")), "2024-01-11")
    return kept.groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@register("triple_deltas", "SELECT 'urn:s:' || s_suppkey AS s, 1::BIGINT AS added FROM supplier")
def triple_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load with another nation for everyone: one new triple each."""
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("urn:s:"), F.col("s_suppkey").cast("string")).alias("u"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("description"))
    before = triples.entity_triples(rows, "website", "u")
    after = triples.entity_triples(rows.withColumn("description", F.concat("description", F.lit("+"))), "website", "u")
    return versions.triple_delta(before, after, ["s", "p", "o"])


def _kind_sql(kind: str, key: str, columns: dict[str, str], source: str) -> str:
    iri, predicates = triples.KINDS[kind]
    full = {p.rsplit("/", 1)[-1]: p for p in predicates}
    parts = [f"SELECT '{kind}' AS kind, {key} AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, '{iri}' AS o FROM {source}"]
    return " UNION ".join([*parts, *(f"SELECT '{kind}', {key}, '{full[c]}', {e} FROM {source}" for c, e in columns.items())])


_KIND_ROWS = {
    "model": ("'urn:p:' || p_partkey", {"name": "p_name", "sharedBy": "p_brand", "mlTask": "p_type", "dateCreated": "'2024-01-01T00:00:00'", "parameterCount": "p_size || 'B'"}, "part"),
    "article": ("'urn:o:' || o_orderkey", {"name": "o_orderpriority", "datePublished": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')", "sameAs": "'https://x.example/' || o_orderkey"}, "orders"),
    "license": ("'urn:r:' || r_regionkey", {"name": "r_name", "version": "r_regionkey::VARCHAR", "isBasedOn": "'base'"}, "region"),
    "website": ("'urn:s:' || s_suppkey", {"name": "s_name", "alternateName": "s_suppkey::VARCHAR"}, "supplier"),
    "dataset": ("'urn:c:' || c_custkey", {"name": "c_name", "conformsTo": "'c'", "citeAs": "'d'", "creator": "c_mktsegment"}, "customer"),
    "term": ("'urn:t:' || n_nationkey", {"name": "n_name", "termCode": "n_nationkey::VARCHAR", "inDefinedTermSet": "'https://x.example/set'"}, "nation"),
    "language": ("'urn:l:' || n_nationkey", {"name": "n_name", "alternateName": "n_regionkey::VARCHAR"}, "nation"),
}
_KIND_SPARK = {"strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")"}


@register("triples_by_kind", "SELECT kind, p, count(*)::BIGINT AS n, min(o) AS lo, max(o) AS hi FROM (" + " UNION ALL ".join(f"(SELECT * FROM ({_kind_sql(k, *v)}))" for k, v in _KIND_ROWS.items()) + ") GROUP BY kind, p")
def triples_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of all seven kinds of entity, counted by predicate."""
    out = None
    for kind, (key, columns, source) in _KIND_ROWS.items():
        own = lambda e: F.expr(_KIND_SPARK.get(e, e).replace("::VARCHAR", ""))
        rows = table(spark, sf_dir, source).select(own(key).alias("u"), *[own(e).cast("string").alias(c) for c, e in columns.items()], F.lit("x").alias("ignored"))
        part = triples.entity_triples(rows, kind, "u").select(F.lit(kind).alias("kind"), "p", "o")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("kind", "p").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))


@register("citation_literals", "SELECT 'urn:c:' || c_custkey AS s, '[{\"id\":\"d' || c_custkey || '\",\"name\":\"' || c_name || '\"}]' AS o FROM customer WHERE c_custkey % 2 = 0")
def citation_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of a model as one JSON literal; an empty list has none."""
    work = F.array(F.struct(F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name")))
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("urn:c:"), F.col("c_custkey").cast("string")).alias("u"), F.when(F.col("c_custkey") % 2 == 0, work).otherwise(F.slice(work, 1, 0)).alias("works"))
    return triples.entity_triples(rows, "model", "u", citation="works").filter(F.endswith("p", F.lit("/citation"))).select("s", "o")


# --- the catalogue's transforms ---


def _raw_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    at = F.expr("make_timestamp(2024, 1, 1, 0, 0, 0) + make_dt_interval(CAST(c_custkey AS INT))")
    card = F.concat(F.lit("---\nlicense: mit\n---\nAbout "), F.col("c_name"))
    tags = F.array(F.lit("license:mit"), F.concat(F.lit("dataset:"), F.lower("c_mktsegment")), F.lit("arxiv:2401.00001"), F.lit("base_model:finetune:org/base"), F.lower("c_mktsegment"), F.lit("text-classification"), F.lit("en"))
    name = F.concat(F.lit("org/model-"), k.cast("string"), F.when(k % 2 == 0, "-7B").otherwise(""))
    return table(spark, sf_dir, "customer").select(name.alias("modelId"), F.lit("org").alias("author"), at.alias("createdAt"), at.alias("last_modified"), card.alias("card"), tags.alias("tags"), F.lit("text_classification").alias("pipeline_tag"), F.lit("torch").alias("library_name"))


_HUB = "SELECT c_custkey, 'org/model-' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '-7B' ELSE '' END AS id, * FROM customer"


@register(
    "hub_models",
    f"""WITH h AS ({_HUB}) SELECT id AS model_id, '{GRAPH}' || sha256('{{"id": "' || id || '", "platform": "HF", "type": "Model"}}') AS iri, string_split(id, '/')[2] AS name, 'https://huggingface.co/' || id AS page,
      'About ' || c_name AS description, CASE WHEN c_custkey % 2 = 0 THEN '7B' END AS size, 'Parsed_from_HF_dataset' AS name_method, 13 AS n_metadata FROM h""",
)
def hub_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = catalogue.hub_models(_raw_hub(spark, sf_dir))
    meta = F.col("extraction_metadata")
    return out.select(
        "model_id", F.get("identifier", 0).alias("iri"), "name", F.col("archivedAt").alias("page"), "description", F.col("parameterCount").alias("size"),
        meta["name"]["extraction_method"].alias("name_method"), F.size(meta).alias("n_metadata"),
    )


@register(
    "hub_entities",
    f"""WITH h AS ({_HUB}) SELECT kind, value, count(*)::BIGINT AS n FROM (
      SELECT unnest(['dataset', 'article', 'base_model', 'license', 'keyword', 'keyword', 'keyword', 'shared_by', 'language', 'task']) AS kind,
             unnest([lower(c_mktsegment), '2401.00001', 'org/base', 'mit', lower(c_mktsegment), 'text-classification', 'en', 'org', 'en', 'text-classification']) AS value FROM h
      UNION ALL SELECT 'model_size', '7B' FROM h WHERE c_custkey % 2 = 0) GROUP BY ALL""",
)
def hub_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities of hub records, by kind, in one scan."""
    kinds = identify.hub_identifiers(languages=["en", "fr"], tasks=["text-classification"])
    return identify.identify(_raw_hub(spark, sf_dir), "modelId", kinds).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


@register("keywords_without_entities", f"WITH h AS ({_HUB}) SELECT id AS \"modelId\", unnest(['text-classification', 'en']) AS tag FROM h")
def keywords_without_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that are no entity of their record, neither as a whole nor behind their last colon."""
    raw = _raw_hub(spark, sf_dir)
    known = identify.identify(raw, "modelId", {k: v for k, v in identify.hub_identifiers().items() if k != "keyword"})
    return identify.keywords_without(raw.select("modelId", F.explode("tags").alias("tag")), known, "modelId")


@register(
    "image_models",
    """SELECT 'ai-' || c_custkey AS model_id, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'Ada' WHEN 1 THEN 'Plain Name' ELSE 'Team' END AS author, 'for ' || c_mktsegment AS description, 'docs' AS abstract,
      'https://a.example/' || c_custkey AS archived, CASE WHEN c_custkey % 2 = 0 THEN 'https://r.example/x' END AS readme, '2024-01-02' AS published FROM customer""",
)
def image_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, lit = F.col("c_custkey"), lambda v: F.lit(v)
    cells = {
        "modelId": F.concat(lit("ai-"), k.cast("string")), "name": F.concat(lit(" "), F.col("c_name")), "url": lit("https://u.example/"),
        "author": F.when(k % 3 == 0, '[{"name": "Ada"}, {"name": "B"}]').when(k % 3 == 1, "Plain Name").otherwise("[]"), "sharedBy": lit("Team"), "dateCreated": lit("2024-01-02"), "dateModified": lit("2024-01-03T00:00:00Z"), "datePublished": lit(""),
        "intendedUse": F.concat(lit("for "), F.col("c_mktsegment")), "documentation": lit("docs"), "archivedAt": F.concat(lit('["https://a.example/'), k.cast("string"), lit('"]')), "discussionUrl": lit(""), "issueTracker": lit(""),
        "readme_file": F.when(k % 2 == 0, "https://r.example/x").otherwise("readme.md"), "referencePublication": lit(None).cast("string"),
    }
    out = catalogue.image_models(table(spark, sf_dir, "customer").select(*[v.alias(n) for n, v in cells.items()]))
    return out.select("model_id", "name", "author", "description", "abstract", F.col("archivedAt").alias("archived"), "readme", F.date_format("datePublished", "yyyy-MM-dd").alias("published"))


@register("merged_partials", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'later' WHEN c_custkey % 2 = 0 THEN 'part' ELSE c_name END AS name, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS nation FROM customer")
def merged_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    base = c.select("c_custkey", F.col("c_name").alias("name"))
    part = c.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("part").alias("name"), F.col("c_nationkey").alias("nation"))
    later = c.filter("c_custkey % 3 = 0").select("c_custkey", F.lit("later").alias("name"))
    return identify.merge_partials(base, [part, later], "c_custkey")


@register(
    "search_documents",
    f"""WITH h AS ({_HUB}) SELECT id AS model_id, 'About ' || c_name AS description, 'org' AS shared_by, 'MIT' AS license, upper(c_mktsegment) || ',en,text-classification' AS keywords, 'text-classification' AS ml_tasks,
      'Name: ' || string_split(id, '/')[2] || '. Description: About ' || c_name || '. Tasks: text-classification. Keywords: ' || upper(c_mktsegment) || ', en, text-classification. Datasets: ' || lower(c_mktsegment) || '. License: MIT.' AS searchable_text FROM h""",
)
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows: models linked to their entities, names for IRIs."""
    raw = _raw_hub(spark, sf_dir)
    long = identify.identify(raw, "modelId", identify.hub_identifiers(languages=["en"], tasks=["text-classification"]))
    linked = catalogue.linked_models(catalogue.hub_models(raw), long, "HF")
    entities = catalogue.side_entities(long, "HF")
    named = F.when(F.col("kind") == "license", F.upper("value")).when((F.col("kind") == "keyword") & ~F.col("value").isin("en", "text-classification"), F.upper("value")).otherwise(F.col("value"))
    names = catalogue.translation([entities.withColumn("name", named)])
    out = catalogue.search_documents(linked.withColumn("keywords", F.array_sort("keywords")), names)
    joined = F.array_join(F.array_sort("keywords"), ",")
    said = F.concat(F.split_part("searchable_text", F.lit("Keywords: "), F.lit(1)), F.lit("Keywords: "), F.replace(joined, F.lit(","), F.lit(", ")), F.lit(". Datasets: "), F.split_part("searchable_text", F.lit(". Datasets: "), F.lit(2)))
    return out.select("model_id", "description", "shared_by", "license", joined.alias("keywords"), F.array_join("ml_tasks", ",").alias("ml_tasks"), said.alias("searchable_text"))


@register("model_detail", "SELECT 7::BIGINT AS model_id, 'customer_of' AS rel, 'n' || c_nationkey AS targets FROM customer WHERE c_custkey = 7")
def model_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.plans.graph_queries import edges_of

    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("model_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("iri"))
    found = catalogue.model_detail(docs, edges_of(spark, sf_dir), "c7")
    return found.select("model_id", F.explode("related").alias("rel", "t")).select("model_id", "rel", F.array_join("t", ",").alias("targets"))


@register(
    "current_metadata",
    "SELECT user_id AS model_uri, arg_max(event_type, event_id) AS extraction_method, max(event_id)::DOUBLE AS confidence FROM events GROUP BY user_id",
)
def current_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each model the metadata of its latest open snapshot; every event of a user is one, in the order of its id."""
    e = table(spark, sf_dir, "events")
    store = e.select(F.col("user_id").alias("model_uri"), F.lit("p").alias("predicate_iri"), F.col("event_type").alias("extraction_method"), F.col("event_id").cast("double").alias("confidence"), F.lit(None).cast("string").alias("notes"), F.col("event_id").alias("valid_from"), F.lit(None).cast("long").alias("valid_to"), F.col("event_id").cast("string").alias("snapshot_hash"))
    return temporal.current_metadata(store).select("model_uri", "extraction_method", "confidence")


@register(
    "model_history",
    """WITH e AS (SELECT event_id, user_id, event_type FROM events WHERE user_id = 13), s AS (SELECT *, lead(event_id) OVER (ORDER BY event_id) AS until FROM e)
    SELECT event_id AS moment, 'p' AS predicate_iri, upper(event_type) AS "values" FROM s ORDER BY event_id DESC""",
)
def model_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model's states at each change, values by name, newest first."""
    e = table(spark, sf_dir, "events")
    until = F.lead("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    store = e.select(F.col("user_id").cast("string").alias("model_uri"), F.lit("p").alias("predicate_iri"), F.col("event_type").alias("value"), F.lit(None).cast("string").alias("value_uri"), F.col("event_id").alias("valid_from"), until.alias("valid_to"))
    names = e.select(F.col("event_type").alias("iri"), F.upper("event_type").alias("name")).distinct()
    return catalogue.history_with_entities(store, names, "13").select("moment", "predicate_iri", F.array_join("values", ",").alias("values"))


@register(
    "prompt_capacity",
    "SELECT lang, greatest(1, floor(116000 * 0.85 / (avg(len(string_split_regex(trim(text), '\\s+'))) + 6 * 1000)))::BIGINT AS cards FROM documents WHERE trim(text) <> '' GROUP BY lang",
)
def prompt_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cards fit a pool of tokens at once, from the average prompt; words stand for tokens."""
    docs = table(spark, sf_dir, "documents").filter(F.trim("text") != "")
    words = F.avg(F.size(F.split(F.trim("text"), r"\s+")))
    return docs.groupBy("lang").agg(F.greatest(F.lit(1), F.floor(116000 * 0.85 / (words + 6 * 1000))).cast("long").alias("cards"))


@register("best_candidates", "SELECT user_id, arg_max(event_id, value * 1e9 - event_id) AS event_id FROM events WHERE event_type IN ('error', 'signup') GROUP BY user_id HAVING max(value) >= 50")
def best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each key the best candidate of a wanted type, if it reaches the threshold."""
    wanted = F.arrays_overlap(F.array("event_type"), F.array(F.lit("error"), F.lit("signup")))
    rows = table(spark, sf_dir, "events").filter(wanted)
    best = rows.groupBy("user_id").agg(F.max_by("event_id", F.col("value") * 1e9 - F.col("event_id")).alias("event_id"), F.max("value").alias("v"))
    return best.filter("v >= 50").select("user_id", "event_id")


@register("fuzzy_names", "SELECT p_partkey, p_name FROM part WHERE len(list_filter(string_split(p_name, ' '), lambda w: levenshtein(lower(w), 'wigdet') <= 2)) > 0 AND len(list_filter(string_split(p_name, ' '), lambda w: levenshtein(lower(w), 'cald') <= 1)) > 0")
def fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").filter(search.fuzzy_match(words, "wigdet") & search.fuzzy_match(words, "cald")).select("p_partkey", "p_name")


@register("schema_columns", "SELECT column_name AS property, lower(data_type) AS kind FROM (DESCRIBE SELECT doc_id, text, lang, source, n_chars FROM documents) t(column_name, data_type, a, b, c, d)")
def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a table and what they hold."""
    fields = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema
    kinds = {"string": "varchar"}
    return spark.createDataFrame([(f.name, kinds.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in fields], "property string, kind string")
