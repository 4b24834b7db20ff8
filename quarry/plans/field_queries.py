"""Queries over fields, identifiers, configuration rows and files of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import dates, idents, text
from quarry.operators import catalogue, fields, identify, triples
from quarry.plans.graph_queries import edges_of, supplier_triples
from quarry.session import scratch, table
from quarry.sources import readers, writers

GRAPH = idents.GRAPH


def _key(name: str) -> F.Column:
    return F.col(name).cast("string")


@register(
    "field_texts",
    f"""SELECT c_custkey AS k, 'b' || c_custkey || ',x' AS bases, '2401.' || (10000 + c_custkey) AS arxiv, 'https://ui.example/' || c_custkey AS ui,
      CASE WHEN c_custkey % 2 = 0 THEN '{GRAPH}' || c_custkey ELSE 'http://x.example/' || c_custkey END AS uri, CASE c_custkey % 3 WHEN 0 THEN 'http://t.example/' || c_custkey WHEN 1 THEN c_name ELSE 'bare' END AS term FROM customer""",
)
def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    tags = F.array(F.concat(F.lit("base_model:finetune:b"), _key("c_custkey")), F.lit("base_model:x"), F.lit("base_model:quantized:x"), F.lit("other"))
    number = F.concat(F.lit("https://arxiv.org/abs/2401."), (10000 + k).cast("string"), F.lit("v3"))
    uri = F.when(k % 2 == 0, F.concat(F.lit("<"), _key("c_custkey"), F.lit(">"))).otherwise(F.concat(F.lit(" <http://x.example/"), _key("c_custkey"), F.lit("> ")))
    term = F.when(k % 3 == 0, F.concat(F.lit("<http://t.example/"), _key("c_custkey"), F.lit(">"))).when(k % 3 == 1, F.concat(F.lit('"'), F.col("c_name"), F.lit('"@en'))).otherwise("bare")
    return table(spark, sf_dir, "customer").select(
        k.alias("k"), F.array_join(text.base_model_tags(tags), ",").alias("bases"), text.strip_arxiv_version(number).alias("arxiv"),
        text.ui_url(F.concat(F.lit(GRAPH), _key("c_custkey")), GRAPH, "https://ui.example/").alias("ui"), idents.normalise_uri(uri).alias("uri"), idents.decode_term(term).alias("term"),
    )


@register(
    "field_dates",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS shown, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
      CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS folder FROM orders""",
)
def field_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")
    said = F.when(k % 3 == 0, day).when(k % 3 == 1, F.concat(day, F.lit("T00:00:00Z"))).otherwise("soon")
    folder = F.when(k % 2 == 0, F.concat(day, F.lit("_01-02-03_abc"))).otherwise("run")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.display_date(F.concat(day, F.lit("T10:00:00"))).alias("shown"),
        F.date_format(dates.parse_iso(said), "yyyy-MM-dd").alias("parsed"), F.date_format(dates.folder_date(folder), "yyyy-MM-dd").alias("folder"),
    )


@register(
    "file_sizes",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN printf('%.2f B', (o_orderkey % 1000)::DOUBLE) WHEN 1 THEN printf('%.2f KB', (o_orderkey % 1000 + 1)::DOUBLE) ELSE printf('%.2f GB', ((o_orderkey % 9 + 1) * 1.5)::DOUBLE) END AS size FROM orders",
)
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    size = F.when(k % 3 == 0, k % 1000).when(k % 3 == 1, (k % 1000 + 1) * 1024).otherwise((k % 9 + 1) * (3 * 2**29)).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.file_size(size).alias("size"))


@register(
    "list_fields",
    """SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'a,b' ELSE 'a,b,' || n_name END AS appended, n_name AS listed, CASE WHEN n_nationkey % 3 = 0 THEN 'Ada' ELSE n_name END AS author,
      CASE WHEN n_nationkey % 2 = 0 THEN 'new' ELSE 'old' END || ':old' AS methods FROM nation""",
)
def list_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    entry = lambda m: catalogue.metadata(m, "field")
    older = F.create_map(F.lit("name"), entry("old"), F.lit("url"), entry("old"))
    newer = F.when(k % 2 == 0, F.create_map(F.lit("name"), entry("new")))
    merged = identify.merge_metadata(older, newer)
    cell = F.when(k % 3 == 0, '[{"name": "Ada"}]').otherwise(F.col("n_name"))
    added = F.when(k % 2 == 0, "a").otherwise(F.col("n_name"))
    return table(spark, sf_dir, "nation").select(
        k.alias("k"), F.array_join(text.append_unique(F.array(F.lit("a"), F.lit("b")), added), ",").alias("appended"), F.array_join(text.as_list(F.col("n_name")), ",").alias("listed"),
        catalogue.first_author(cell).alias("author"), F.concat_ws(":", merged["name"]["extraction_method"], merged["url"]["extraction_method"]).alias("methods"),
    )


@register("referenced_entities", "SELECT 'https://s.example/' || s_suppkey AS o FROM supplier")
def referenced_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.referenced(supplier_triples(spark, sf_dir), "https://s.example/")


@register("distinct_entities", "SELECT 'language' AS kind, lang AS value FROM documents UNION SELECT 'source', source FROM documents")
def distinct_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify.entities(identify.identify(docs, "doc_id", {"language": F.array("lang"), "source": F.array("source")}))


@register("triple_patterns", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey WHERE a.s_suppkey <= b.s_suppkey")
def triple_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """?a nation ?n . ?b nation ?n: triple patterns are joined on their shared variables."""
    own = supplier_triples(spark, sf_dir)
    nation = "https://schema.org/nation"
    found = fields.match_patterns(own, [("?a", nation, "?n"), ("?b", nation, "?n")])
    number = lambda c: F.substring_index(c, ":", -1).cast("long")
    return found.select(number("a").alias("a"), number("b").alias("b")).filter("a <= b")


@register("export_subjects", "SELECT s_suppkey AS k, 4::BIGINT AS lines FROM supplier WHERE s_suppkey % 3 = 0")
def export_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-Triples of some subjects."""
    wanted = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("urn:s:"), _key("s_suppkey")).alias("s"))
    lines = triples.n_triples(supplier_triples(spark, sf_dir).join(wanted, "s", "left_semi"))
    return lines.groupBy(F.regexp_extract("value", r"^<urn:s:(\d+)>", 1).cast("long").alias("k")).agg(F.count(F.lit(1)).alias("lines"))


@register("related_of_ids", "SELECT 'c' || c_custkey AS root, 'n' || c_nationkey AS target FROM customer WHERE c_custkey IN (1, 5, 9)")
def related_of_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of some ids, given in one text between commas."""
    ids = fields.ids_of(spark, "c1, c5,,c9 ,c1")
    return edges_of(spark, sf_dir).join(ids, F.col("src") == F.col("id")).select(F.col("src").alias("root"), F.col("dst").alias("target"))


@register("requested_properties", "SELECT s_suppkey, s_name AS name FROM supplier")
def requested_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only properties that are asked for and allowed."""
    rows = table(spark, sf_dir, "supplier").withColumnRenamed("s_name", "name")
    return fields.requested(rows, ["name", "s_acctbal", "nothing", "a; DROP"], allowed=["name", "s_nationkey"], always=["s_suppkey"])


@register("excluded_ids", "SELECT DISTINCT conv_id AS id FROM conversations WHERE turn < 2")
def excluded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that earlier pages had, each once."""
    pages = table(spark, sf_dir, "conversations").filter("turn < 2").groupBy("turn").agg(F.collect_set("conv_id").alias("ids"))
    return fields.seen_ids(pages, "ids")


@register("flat_records", "SELECT c_custkey AS id, c_name AS manifest_name, c_mktsegment AS manifest_kind, c_acctbal > 0 AS liked FROM customer WHERE c_custkey % 3 = 0")
def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one type, their nested parts as columns of their own."""
    nested = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, "model").otherwise("dataset").alias("type"), nested.alias("manifest"), (F.col("c_acctbal") > 0).alias("liked"))
    flat = fields.flattened(rows.filter("type = 'model'").drop("type"))
    return flat.withColumnsRenamed({"manifest.name": "manifest_name", "manifest.kind": "manifest_kind"})


@register("record_by_either_id", "SELECT n_nationkey AS k, min(s_name) AS found FROM nation LEFT JOIN supplier ON s_suppkey = n_nationkey OR s_suppkey + 100 = n_nationkey + 95 GROUP BY n_nationkey")
def record_by_either_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record whose own id or whose manifest's id is the wanted one: two equi joins, not one join by either."""
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") + 5).alias("manifest_id"), F.col("s_name").alias("name"))
    wanted = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    return fields.by_either(wanted, "k", known, ["id", "manifest_id"], "name").withColumnRenamed("name", "found")


@register(
    "platform_sites",
    f"""SELECT platform, name, url, '{GRAPH}' || sha256('{{"id": "' || url || '", "platform": "' || platform || '", "type": "WebSite"}}') AS identifier
    FROM (VALUES ('HF', 'Hugging Face', 'https://huggingface.co/'), ('AI4Life', 'AI4Life', 'https://ai4life.eurobioimaging.eu/')) AS t(platform, name, url)""",
)
def platform_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The websites of the catalogues as rows."""
    return fields.site_rows(spark)


@register(
    "crate_ids",
    """SELECT o_orderkey, 'urn:o:' || o_orderkey || '/ro-crate-metadata.json' AS crate, 'urn:o:' || o_orderkey || '/metadata.json' AS meta, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '2020-02-02' ELSE '2024-01-01' END AS last FROM orders""",
)
def crate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crate and metadata addresses, and the last date: modified, else created, else a given day."""
    k = F.col("o_orderkey")
    modified = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    created = F.when(k % 3 == 1, F.lit("2020-02-02 10:00"))
    iri = F.concat(F.lit("<urn:o:"), _key("o_orderkey"), F.lit(">"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fields.crate_id(iri).alias("crate"), fields.metadata_id(iri).alias("meta"), fields.last_date(modified, created, F.lit("2024-01-01")).alias("last")
    )


@register("catalogue_order", "SELECT p_type AS category, p_brand AS task FROM part GROUP BY ALL ORDER BY p_type, p_brand LIMIT 30")
def catalogue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks in the order of their categories, each once."""
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), F.col("p_brand").alias("task")).distinct().orderBy("category", "task").limit(30)


@register("tasks_with_definitions", "SELECT p_brand AS task, CASE WHEN p_brand LIKE '%1%' THEN 'about ' || p_brand END AS definition, p_brand LIKE '%1%' AS enriched FROM (SELECT DISTINCT p_brand FROM part)")
def tasks_with_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue with the definitions that are known; a repeated definition counts once."""
    tasks = table(spark, sf_dir, "part").select(F.col("p_brand").alias("task"))
    known = tasks.filter(F.contains("task", F.lit("1"))).withColumn("definition", F.concat(F.lit("about "), F.col("task")))
    from quarry.operators import records

    return records.left_with_stub(tasks, known, "task").select("task", "definition", "enriched")


@register("unindexed_rows", "SELECT count(*)::BIGINT AS n FROM embeddings e RIGHT JOIN documents d ON vec_id = doc_id WHERE vec_id IS NULL")
def unindexed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have no vector yet."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return docs.join(vectors, "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("n"))


@register("task_links", r"""SELECT page_id, string_agg(DISTINCT t, ',' ORDER BY t) AS slugs FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"/]+)"', 1)) AS t FROM pages) GROUP BY page_id""")
def task_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slugs that a page links to, each once, sorted."""
    return table(spark, sf_dir, "pages").select("page_id", fields.slugs(F.col("html")).alias("s")).filter(F.size("s") > 0).select("page_id", F.array_join("s", ",").alias("slugs"))


@register("record_files", "SELECT 'json' AS form, count(*)::BIGINT AS n, sum(c_custkey)::BIGINT AS keys FROM customer UNION ALL SELECT 'csv', count(*)::BIGINT, sum(c_custkey)::BIGINT FROM customer UNION ALL SELECT 'errors', count(*)::BIGINT, sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'none', 0, NULL UNION ALL SELECT 'lines', count(*)::BIGINT, sum(c_custkey)::BIGINT FROM customer")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON and CSV, with the faulty ones apart, and read again; a missing file has no rows."""
    path = scratch(spark, "records")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.array("c_mktsegment").alias("tags"), "c_acctbal")
    kind = "c_custkey long, c_name string, tags array<string>, c_acctbal double"
    writers.write_records(rows, f"{path}/all", csv=True)
    writers.write_split(rows.filter("c_acctbal >= 0"), rows.filter("c_acctbal < 0"), f"{path}/split")
    rows.select(_key("c_custkey").alias("value")).union(spark.createDataFrame([("# note",), ("",)], "value string")).write.text(f"{path}/ids")
    parts = {
        "json": readers.read_records(spark, f"{path}/all/json", kind).select("c_custkey"),
        "csv": spark.read.option("header", True).csv(f"{path}/all/csv").select(F.col("c_custkey").cast("long")),
        "errors": readers.read_entities(spark, f"{path}/split/errors", kind).select("c_custkey"),
        "none": readers.read_entities(spark, f"{path}/nothing", kind).select("c_custkey"),
        "lines": readers.read_lines(spark, f"{path}/ids").select(F.col("id").cast("long").alias("c_custkey")),
    }
    out = [df.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")).select(F.lit(form).alias("form"), "n", "keys") for form, df in parts.items()]
    return readers.union_tables(out)


@register("curated_tables", "SELECT n_name AS keyword, CASE WHEN n_nationkey % 2 = 0 THEN 'a,b' ELSE '' END AS aliases, n_name AS task, 'Q ' || n_name AS question FROM nation")
def curated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated keywords with JSON aliases (a malformed list is empty), a task catalogue and a table of questions, from CSV."""
    path = scratch(spark, "curated")
    n = table(spark, sf_dir, "nation")
    aliases = F.when(F.col("n_nationkey") % 2 == 0, '["a", "b"]').otherwise("[broken")
    n.select(F.col("n_name").alias("keyword"), F.lit("d").alias("definition"), aliases.alias("aliases")).write.option("header", True).option("escape", '"').csv(f"{path}/keywords")
    n.union(n).select(F.col("n_name").alias("task"), F.lit("c").alias("category")).write.option("header", True).csv(f"{path}/tasks")
    n.select(F.col("n_name").alias("property"), F.concat(F.lit("Q "), "n_name").alias("question")).write.option("header", True).option("sep", ";").csv(f"{path}/questions")
    words = readers.read_keywords(spark, f"{path}/keywords").select("keyword", F.array_join("aliases", ",").alias("aliases"))
    tasks = readers.read_catalogue(spark, f"{path}/tasks").select("task")
    asked = readers.read_templates(spark, f"{path}/questions")
    return words.join(tasks, F.col("keyword") == F.col("task")).join(asked, F.col("keyword") == F.col("property")).select("keyword", "aliases", "task", "question")


@register("load_report", "SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*)::BIGINT AS n FROM orders GROUP BY ALL")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a load, written as JSON and read back."""
    path = scratch(spark, "report")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    writers.report(rows, ["status", "priority"]).write.json(path)
    return spark.read.schema("status string, priority string, n long").json(path)


@register("swapped_index", "SELECT c_custkey AS id, upper(c_name) AS name FROM customer WHERE c_custkey % 2 = 0")
def swapped_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index built anew from its own rows: written beside the old one, then read in its place."""
    path = scratch(spark, "index")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.parquet(f"{path}/v1")
    return writers.rebuilt(spark, f"{path}/v1", f"{path}/v2", lambda old: old.filter("id % 2 = 0").withColumn("name", F.upper("name")))
