"""Queries over cards and exports, and the streaming forms run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.operators import cards, splitting
from quarry.session import scratch, table
from quarry.streaming import incremental


@register("md_chunks")
def md_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    card = F.concat(F.lit("intro\n\n# "), F.col("source"), F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n\n## Use\n\nshort\n\n```\ncode()\n```\n"))
    return cards.chunks(docs.select("doc_id", card.alias("card")), "doc_id", "card")


@register(
    "text_windows",
    """
    WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
    s AS (SELECT doc_id, text, unnest(range(0, greatest(n - 200, 1), 800)) AS st FROM d)
    SELECT doc_id, (st // 800)::INTEGER AS n, length(substr(text, st + 1, 1000))::INTEGER AS size FROM s WHERE substr(text, st + 1, 1000) <> ''
    """,
)
def text_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cards.windows(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "n", F.length("text").alias("size"))


_WORDS = {c: "[" + ", ".join(f"'{w}'" for w in ws) + "]" for c, ws in cards.FREQUENT.items()}


@register(
    "language_detect",
    f"""
    WITH w AS (SELECT doc_id, string_split_regex(lower(trim(text)), '[^\\p{{L}}]+') AS ws FROM documents),
    c AS (SELECT doc_id, {", ".join(f"len([x FOR x IN ws IF list_contains({ws}, x)]) AS {c}" for c, ws in _WORDS.items())} FROM w),
    t AS (SELECT *, {" + ".join(_WORDS)} AS total FROM c)
    SELECT doc_id, {" || ".join(f"CASE WHEN {c} / greatest(total, 1) > 0.5 THEN '{c}' ELSE '' END" for c in _WORDS)} AS code FROM t
    """,
)
def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cards.languages(F.col("text"), least=0.500001)
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.get(found, 0)["code"], F.lit("")).alias("code"))


@register(
    "jsonld_export",
    """
    SELECT s_suppkey, '{"@context":"https://w3id.org/ro/crate/1.1/context","@graph":[{"@id":"ro-crate-metadata.json","@type":"CreativeWork","about":{"@id":"urn:s:' || s_suppkey
      || '"},"datePublished":"2024-01-01"},{"@id":"urn:s:' || s_suppkey || '","@type":"Organization","name":"' || s_name || '"'
      || CASE WHEN s_suppkey % 2 = 0 THEN ',"nation":"n' || s_nationkey || '"' ELSE '' END || '}]}' AS crate FROM supplier
    """,
)
def jsonld_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    iri = F.concat(F.lit("urn:s:"), F.col("s_suppkey").cast("string"))
    nation = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("n"), F.col("s_nationkey").cast("string")))
    node = cards.json_ld({"name": F.col("s_name"), "nation": nation}, iri, "Organization")
    return table(spark, sf_dir, "supplier").select("s_suppkey", cards.crate(node, iri, F.lit("2024-01-01")).alias("crate"))


@register(
    "prompt_fan_out",
    """
    WITH q AS (SELECT unnest(['size', 'brand']) AS property), p AS (SELECT *, len(string_split_regex(trim('Q: ' || property || '? Card: ' || p_name || ' ' || p_type), '\\s+')) AS words FROM part, q)
    SELECT p_partkey, property, 'Q: ' || property || '? Card: ' || p_name || ' ' || p_type AS prompt FROM p WHERE words + 4 <= 10
    """,
)
def prompt_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = spark.createDataFrame([("size", "size?", "a"), ("brand", "brand?", "a")], "property string, question string, type string")
    templates = spark.createDataFrame([("a", "Q: {question} Card: {card}")], "type string, template string")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("card"))
    return cards.prompts(parts, questions, templates, "p_partkey", context=10, answer=4)


@register(
    "stream_change_log",
    """
    WITH e AS (SELECT user_id, ts, min(event_type) AS event_type FROM events GROUP BY 1, 2),
    c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM e)
    SELECT user_id, event_type, ts AS valid_from FROM c WHERE n = 1 OR b <> event_type
    """,
)
def stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each user's event type over a stream of events that come out of order, run to its end.

    The table is dealt to files by a hash, so every file has events of the whole time, and read one file a batch.
    """
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    path = scratch(spark, "stream")
    events.repartition(3, F.xxhash64("ts", "user_id")).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    log = incremental.changes(stream, "user_id", "event_type", "ts", delay="60 days")
    with incremental.keyed_state(spark):
        run = log.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/log")
    run.awaitTermination()
    settled = incremental.settled_log(spark.read.schema(log.schema).parquet(f"{path}/log"), "user_id", "event_type")
    return settled.select("user_id", "event_type", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"))


@register(
    "md_chunk_outline",
    """
    SELECT s_suppkey, string_agg(type || ':' || coalesce(htext, '') || ':' || coalesce(phtext, '') || ':' || text, ';' ORDER BY type, text) AS chunks FROM (
      SELECT s_suppkey, unnest(['orphan', 'section', 'section', 'granular', 'code', 'table', 'granular']) AS type,
        unnest([NULL, s_name, 'Use', NULL, NULL, NULL, NULL]) AS htext, unnest([NULL, NULL, s_name, s_name, 'Use', 'Use', 'Use']) AS phtext,
        unnest(['intro', s_name || ' about it Use | a | code() end', 'Use | a | code() end', 'about it', 'code()', '| a |', 'end']) AS text FROM supplier)
    GROUP BY s_suppkey
    """,
)
def md_chunk_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of small cards with every kind of block."""
    card = F.concat(F.lit("intro\n\n# "), F.col("s_name"), F.lit(" #\n\nabout it\n\n## Use\n| a |\n```py\ncode()\n```\n\nend\n"))
    made = cards.chunks(table(spark, sf_dir, "supplier").select("s_suppkey", card.alias("card")), "s_suppkey", "card")
    said = F.concat_ws(":", "type", F.coalesce("htext", F.lit("")), F.coalesce("phtext", F.lit("")), "text")
    ordered = F.array_sort(F.collect_list(F.struct("type", "text", said.alias("said"))))
    return made.groupBy("s_suppkey").agg(F.array_join(F.transform(ordered, lambda x: x["said"]), ";").alias("chunks"))


@register(
    "card_texts",
    """
    WITH c AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'code' ELSE 'granular' END AS type, 'H' || (turn // 4) AS h, 't' || turn AS t FROM conversations),
    k AS (SELECT *, lag(h) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM c WHERE type <> 'code')
    SELECT conv_id, string_agg(CASE WHEN b = h THEN '' ELSE h || chr(10) END || t, chr(10) ORDER BY turn) AS text FROM k GROUP BY conv_id
    """,
)
def card_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards for prompts: code left out, headings where they change."""
    turn = F.col("turn")
    kind = F.when(turn % 3 == 0, "code").otherwise("granular")
    head = F.concat(F.lit("H"), F.floor(turn / 4).cast("string"))
    chunks = table(spark, sf_dir, "conversations").select("conv_id", turn.alias("pos"), kind.alias("type"), head.alias("phtext"), F.concat(F.lit("t"), turn.cast("string")).alias("text"))
    return cards.card_text(chunks, "conv_id")


@register("model_cards", "SELECT p_partkey, 'Name: ' || p_name || chr(10) || 'Brand: ' || p_brand AS card FROM part")
def model_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [("Name", F.col("p_name")), ("License", F.lit("NA")), ("Brand", F.col("p_brand")), ("Tasks", F.lit(None).cast("string"))]
    return table(spark, sf_dir, "part").select("p_partkey", cards.model_card(fields).alias("card"))


@register("recursive_chunks")
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in chunks of 1000 characters with an overlap of 200."""
    return splitting.chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text")).drop("text")


@register("section_chunks")
def section_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as model texts with sections, cut at these first."""
    told = F.concat(F.lit("Model Name: "), F.col("source"), F.lit("\n== Model Properties ==\n"), F.coalesce("text", F.lit("")))
    return splitting.chunks(table(spark, sf_dir, "documents").select("doc_id", told.alias("told")), F.col("told"), by_section=True).drop("told")


@register("answer_prompt")
def answer_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt for a question: the three nearest chunks of all documents."""
    question = "the license of the edited thing"
    chunked = splitting.chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"))
    return splitting.answer_prompt(splitting.nearest_chunks(chunked, question, ["doc_id"]), question)
