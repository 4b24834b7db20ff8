"""Triples: records unpivoted to (s, p, o), and back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quarry.functions.idents import is_iri


def objects(df: DataFrame, name: str) -> Column:
    """A column's objects: elements of an array, or the value; null and blank ones are none."""
    if isinstance(df.schema[name].dataType, ArrayType):
        values = F.coalesce(F.col(name).cast("array<string>"), F.array().cast("array<string>"))
    else:
        values = F.array(F.col(name).cast("string"))
    return F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != ""))


def tagged(name: str, key: str, value: str):
    """A function of an element that pairs it with a fixed name."""
    return lambda v: F.struct(F.lit(name).alias(key), v.alias(value))


def to_triples(df: DataFrame, subject: str, predicates: dict[str, str], kind: str | None = None, repeats: bool = False) -> DataFrame:
    """(s, p, o, o_is_iri), each once: one for every object of every mapped column, and the type if given.

    One scan and one explode for all predicates; duplicates are merged on the map side before the shuffle. With repeats
    they stay and nothing is shuffled, for a sink that merges them itself.
    """
    maps = [F.transform(objects(df, c), tagged(p, "p", "o")) for c, p in predicates.items()]
    if kind:
        maps.append(F.array(F.struct(F.lit("http://www.w3.org/1999/02/22-rdf-syntax-ns#type").alias("p"), F.lit(kind).alias("o"))))
    out = df.select(F.col(subject).cast("string").alias("s"), F.explode(F.flatten(F.array(*maps))).alias("t")).select("s", "t.p", "t.o")
    out = out.withColumn("o_is_iri", is_iri(F.col("o")))
    return out if repeats else out.distinct()


def to_documents(triples: DataFrame) -> DataFrame:
    """(s, doc): for every subject its predicates with their sorted objects, as a map."""
    by_predicate = triples.groupBy("s", "p").agg(F.array_sort(F.collect_set("o")).alias("os"))
    return by_predicate.groupBy("s").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "os")))).alias("doc"))


def delete_triples(store: DataFrame, gone: DataFrame) -> DataFrame:
    """The store without the given (s, p, o)."""
    return store.join(gone.select("s", "p", "o").distinct(), ["s", "p", "o"], "left_anti")


def n_triples(triples: DataFrame) -> DataFrame:
    """One line of N-Triples for each triple, in a column named value."""
    quoted = F.replace(F.replace(F.replace(F.replace(F.col("o"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    obj = F.when(F.col("o_is_iri"), F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(F.concat(F.lit('"'), quoted, F.lit('"')))
    return triples.select(F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), obj, F.lit(" .")).alias("value"))


def referenced(triples: DataFrame, prefix: str) -> DataFrame:
    """Every object that lies in the graph, once."""
    return triples.filter(F.startswith("o", F.lit(prefix))).select("o").distinct()


def mentions(triples: DataFrame, predicate_part: str, object_prefix: str = "") -> DataFrame:
    """Distinct objects of the predicates that contain a text, and begin with a prefix."""
    found = triples.filter(F.contains("p", F.lit(predicate_part)))
    return (found.filter(F.startswith("o", F.lit(object_prefix))) if object_prefix else found).select("o").distinct()


_S, _F, _C, _I = "https://schema.org/", "https://w3id.org/fair4ml/", "https://w3id.org/codemeta/", "https://w3id.org/insilico/"
_NAMED = ("identifier", "name", "url", "sameAs")
#: The type of each kind of entity, and its predicates.
KINDS = {
    "model": (
        _F + "MLModel",
        [_S + p for p in ("identifier", "name", "url", "author")] + [_F + "sharedBy"]
        + [_S + p for p in ("description", "abstract", "discussionUrl", "archivedAt")] + [_C + "readme", _C + "issueTracker", _F + "parameterCount", _F + "domain"]
        + [_I + "dataSplits", _I + "adaptionTechniques"] + [_S + p for p in ("dateCreated", "dateModified", "datePublished")]
        + [_S + p for p in ("license", "source", "keywords", "inLanguage")] + [_F + p for p in ("supportedLanguages", "mlTask", "modelCategory", "baseModel", "evaluatedOn")],
    ),
    "article": (_S + "ScholarlyArticle", [_S + p for p in (*_NAMED, "description", "about", "author", "isPartOf", "comment", "datePublished", "dateModified")]),
    "license": (
        _S + "CreativeWork",
        [_S + p for p in (*_NAMED, "alternateName", "description", "abstract", "text", "license", "version", "copyrightNotice")]
        + [_S + p for p in ("legislationJurisdiction", "legislationType", "isBasedOn", "subjectOf", "dateCreated", "dateModified", "datePublished")],
    ),
    "website": (_S + "WebSite", [_S + p for p in (*_NAMED, "description", "alternateName")]),
    "dataset": (
        _S + "Dataset",
        [_S + p for p in (*_NAMED, "description", "license")] + ["http://purl.org/dc/terms/conformsTo", "http://mlcommons.org/croissant/citeAs", _S + "creator"]
        + [_S + p for p in ("keywords", "datePublished", "dateModified")],
    ),
    "term": (_S + "DefinedTerm", [_S + p for p in (*_NAMED, "description", "termCode", "alternateName", "inDefinedTermSet")]),
    "language": (_S + "Language", [_S + p for p in (*_NAMED, "alternateName", "description")]),
}


def entity_triples(rows: DataFrame, kind: str, subject: str, citation: str | None = None) -> DataFrame:
    """The triples of one kind of entity, from columns named by the last part of their predicates; others are ignored.

    citation names a list column of a model whose works are kept together as one JSON text.
    """
    iri, predicates = KINDS[kind]
    short = {p.rsplit("/", 1)[-1]: p for p in predicates}
    own = rows
    mapped = {c: short[c] for c in rows.columns if c in short}
    if citation:
        own = own.withColumn("__citation", F.when(F.size(citation) > 0, F.to_json(citation)))
        mapped["__citation"] = _S + "citation"
    return to_triples(own, subject, mapped, kind=iri)
