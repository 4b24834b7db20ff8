"""Model cards: Markdown chunks, plain splits, languages, prompts and JSON-LD exports."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as tx


_HEADING = re.compile(r"(#{1,6})\s+\S", re.ASCII)
_MARKS = re.compile(r"^#{1,6}\s+|\s+#*\s*$", re.ASCII)
_TABLE = re.compile(r"\s*\|", re.ASCII)


def _blocks(card: str) -> Iterator[tuple[int, str, tuple[int, ...], str]]:
    """(place, kind, places of the open headings, text) of a card's blocks: headings, code, tables and paragraphs."""
    path: list[tuple[int, int]] = []
    inside, kind_before, block = False, "", None
    for pos, line in enumerate(card.split("\n")):
        bare = line.strip(" ")
        fence = bare.startswith("```")
        opens = fence and not inside
        heading = None if fence or inside else _HEADING.match(line)
        kind = "code" if fence or inside else "heading" if heading else "blank" if not bare else "table" if _TABLE.match(line) else "granular"
        inside ^= fence
        if heading:
            while path and path[-1][0] >= len(heading[1]):
                path.pop()
            path.append((len(heading[1]), pos))
        if block and (kind != kind_before or heading or opens):
            yield block[0], block[1], block[2], "\n".join(block[3])
            block = None
        kind_before = kind
        if kind != "blank" and not fence:
            if block:
                block[3].append(line)
            else:
                block = (pos, kind, tuple(p for _, p in path), [line])
    if block:
        yield block[0], block[1], block[2], "\n".join(block[3])


def _card_chunks(card: str, least_words: int) -> Iterator[tuple[str, int, int | None, str | None, str | None, str]]:
    """(type, place, place of the parent section, heading, parent's heading, text) of one card's chunks."""
    heads: dict[int, str] = {}
    sections: dict[int, tuple[tuple[int, ...], list[str]]] = {}
    small: dict[tuple[int, str, int], tuple[int, list[str]]] = {}
    longs: dict[tuple[int, str], int] = {}
    loose: list[str] = []
    for pos, kind, path, raw in _blocks(card):
        said = _MARKS.sub("", raw) if kind == "heading" else raw.strip(" ")
        if not said:
            continue
        if kind == "heading":
            heads[pos] = said
            sections[pos] = (path, [])
        for p in path:
            if p in sections:
                sections[p][1].append(said)
        if kind == "heading":
            continue
        if not path:
            loose.append(said)
            continue
        # a short block goes with the next long one of its section
        group = (path[-1], kind if kind == "granular" else f"{kind}{pos}")
        part = longs.get(group, 0)
        small.setdefault((*group, part), (pos, []))[1].append(said)
        longs[group] = part + (len(said.split()) > least_words)
    for pos, (path, said) in sections.items():
        up = path[-2] if len(path) > 1 else None
        yield "section", pos, up, heads[pos], heads.get(up), " ".join(said)
    for (section, kind, _), (pos, said) in small.items():
        if section in heads:
            yield kind if kind == "granular" else kind.rstrip("0123456789"), pos, section, None, heads[section], " ".join(said)
    if loose:
        yield "orphan", 0, None, None, None, " ".join(loose)


def chunks(docs: DataFrame, id_col: str, text_col: str, least_words: int = 20) -> DataFrame:
    """(id_col, chunk_id, type, length, parent, htext, phtext, text): the chunks of every Markdown text.

    A section chunk holds a heading and all that stands under it, sub-sections included; code and table blocks are
    chunks of their own; other blocks are "granular", and those of at most `least_words` words are put before the next
    longer one of their section. Text before the first heading is one "orphan". Ids are hashes of document and place.

    A card is parsed where its row lies, on Arrow batches: no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                owners, found = [], []
                for i, card in enumerate(some.column(1).to_pylist()):
                    own = list(_card_chunks(card or "", least_words))
                    owners += [i] * len(own)
                    found += own
                kinds, places, ups, heads, above, texts = zip(*found) if found else ((),) * 6
                columns = [some.column(0).take(pa.array(owners, pa.int64())), pa.array(kinds, pa.string()), pa.array(places, pa.int32()), pa.array(ups, pa.int32()),
                           pa.array([len(t.split()) for t in texts], pa.int32()), pa.array(heads, pa.string()), pa.array(above, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "type", "pos", "up", "length", "htext", "phtext", "text"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    made = rows.mapInArrow(run, f"id {kind}, type string, pos int, up int, length int, htext string, phtext string, text string")
    uid = lambda t, pos: F.lower(F.hex(F.xxhash64("id", t, pos)))
    return made.select(
        F.col("id").alias(id_col), uid("type", "pos").alias("chunk_id"), "type", "length",
        F.when(F.col("up").isNotNull(), uid(F.lit("section"), "up")).alias("parent"), "htext", "phtext", "text",
    )


def card_text(chunks: DataFrame, id_col: str, place: str = "pos") -> DataFrame:
    """(id_col, text): what is left of a card for prompts: no sections and code, a heading where it changes, then the texts."""
    said = F.struct(F.col(place).alias("at"), F.coalesce("phtext", F.lit("")).alias("head"), F.coalesce("text", F.lit("")).alias("said"))
    kept = chunks.filter(~F.col("type").isin("section", "code")).groupBy(id_col).agg(F.array_sort(F.collect_list(said)).alias("all"))
    start = F.struct(F.lit("").alias("head"), F.lit("").alias("out"))
    folded = F.aggregate(
        "all",
        start,
        lambda acc, x: F.struct(
            F.when(x["head"] != "", x["head"]).otherwise(acc["head"]).alias("head"),
            F.concat(acc["out"], F.when((x["head"] != "") & (x["head"] != acc["head"]), F.concat(x["head"], F.lit("\n"))).otherwise(""), x["said"], F.lit("\n")).alias("out"),
        ),
        lambda acc: F.regexp_replace(acc["out"], r"^\s+|\s+\z", ""),
    )
    return kept.select(id_col, folded.alias("text"))


def model_card(fields: list[tuple[str, Column]], most: int = 500) -> Column:
    """A model as lines "Label: value" for a prompt; fields without a value are left out, long values cut."""
    lines = [F.when(tx.is_meaningful(v), F.concat(F.lit(f"{label}: "), F.substring(F.trim(v), 1, most))) for label, v in fields]
    return F.concat_ws("\n", *lines)


def windows(docs: DataFrame, id_col: str, text_col: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """(id_col, n, text): texts in pieces of `size` characters that overlap; a short text is one piece."""
    length = F.length(F.coalesce(F.col(text_col), F.lit("")))
    starts = F.sequence(F.lit(0), F.greatest(length - overlap - 1, F.lit(0)), F.lit(size - overlap))
    pieces = docs.select(F.col(id_col), F.col(text_col).alias("__t"), F.posexplode(starts).alias("n", "__s"))
    return pieces.select(id_col, "n", F.substr("__t", F.col("__s") + 1, F.lit(size)).alias("text")).filter("text <> ''")


#: Frequent words by language.
FREQUENT = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "this"),
    "fr": ("le", "la", "les", "des", "et", "du", "une", "qui", "pour", "sur"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "von"),
    "es": ("el", "los", "las", "que", "una", "del", "por", "para", "con", "su"),
}


def languages(text: Column, least: float = 0.5, most: int = 5) -> Column:
    """Array of (code, confidence), surest first: shares of the frequent words of each language among all that were found.

    A small stand-in for a trained detector; text without any frequent word has none.
    """
    words = F.split(F.lower(tx.strip_front_matter_loose(text)), r"[^\p{L}]+")
    counts = {c: F.size(F.filter(words, _one_of(ws))) for c, ws in FREQUENT.items()}
    total = sum(counts.values(), F.lit(0))
    scored = F.array(*[F.struct((-(n / F.greatest(total, F.lit(1)))).alias("o"), F.lit(c).alias("code")) for c, n in counts.items()])
    sure = F.filter(F.array_sort(scored), lambda x: -x["o"] >= least)
    return F.slice(F.transform(sure, lambda x: F.struct(x["code"].alias("code"), (-x["o"]).alias("confidence"))), 1, most)


def _one_of(words: tuple[str, ...]):
    return lambda w: w.isin(*words)


def json_ld(fields: dict[str, Column], iri: Column, kind: str) -> Column:
    """A JSON-LD node; fields without a value are left out."""
    return F.to_json(F.struct(iri.alias("@id"), F.lit(kind).alias("@type"), *[v.alias(k) for k, v in fields.items()]))


def crate(model_json: Column, iri: Column, published: Column) -> Column:
    """A detached research-object crate around a model's JSON-LD node."""
    head = F.lit('{"@context":"https://w3id.org/ro/crate/1.1/context","@graph":[{"@id":"ro-crate-metadata.json","@type":"CreativeWork","about":{"@id":"')
    return F.concat(head, iri, F.lit('"},"datePublished":"'), F.coalesce(published, F.lit("")), F.lit('"},'), model_json, F.lit("]}"))


def prompts(cards: DataFrame, questions: DataFrame, templates: DataFrame, id_col: str, context: int, answer: int, most: int = 1000) -> DataFrame:
    """(id_col, property, prompt): each card with each question in its type's template, where it fits the context.

    Questions and templates are configuration: more than `most` of them are an error, so what each card is joined with
    has a bound.
    """
    asked = questions.join(templates, "type").select("property", "question", "template").limit(most + 1).collect()
    if len(asked) > most:
        raise ValueError(f"more than {most} questions")
    rows = [F.struct(F.lit(r["property"]).alias("property"), F.lit(r["question"]).alias("question"), F.lit(r["template"]).alias("template")) for r in asked]
    none = F.array().cast("array<struct<property: string, question: string, template: string>>")
    each = cards.select(id_col, "card", F.inline(F.array(*rows) if rows else none))
    filled = F.replace(F.replace("template", F.lit("{question}"), F.col("question")), F.lit("{card}"), F.col("card"))
    words = F.size(F.split(F.trim(F.col("prompt")), r"\s+"))
    return each.withColumn("prompt", filled).filter(words + answer <= context).select(id_col, "property", "prompt")
