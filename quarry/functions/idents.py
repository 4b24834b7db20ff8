"""Identity: IRIs, content-hash identifiers, JSON-exact hashing. Pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where this engine's identifiers live unless a caller names another base.
GRAPH = "https://example.org/model-graph/"
_IRI = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\s]+/\S*\z"
_HTTP = r"^(?i)https?://[^/?#\s]+"


def is_iri(value: Column) -> Column:
    """True for scheme://authority/path without white space; null counts as false."""
    return F.coalesce(value.rlike(_IRI), F.lit(False))


def is_http_url(value: Column) -> Column:
    """True for http and https urls with a host."""
    return F.coalesce(F.trim(value).rlike(_HTTP), F.lit(False))


def json_string(value: Column) -> Column:
    """The value as a JSON string in ASCII, escaped the way Python's json module does; null becomes null."""
    units = F.hex(F.encode(value, "UTF-16BE"))
    each = F.transform(
        F.sequence(F.lit(0), (F.length(units) / 4).cast("int") - 1), lambda i: F.substr(units, i * 4 + 1, F.lit(4))
    )

    def escaped(u: Column) -> Column:
        short = {"0022": '\\"', "005C": "\\\\", "000A": "\\n", "000D": "\\r", "0009": "\\t", "0008": "\\b", "000C": "\\f"}
        out = F.when(u.between("0020", "007E") & ~u.isin("0022", "005C"), F.char(F.conv(u, 16, 10).cast("int")))
        for unit, text in short.items():
            out = out.when(u == unit, F.lit(text))
        return out.otherwise(F.concat(F.lit("\\u"), F.lower(u)))

    plain = value.rlike(r"^[ !#-\[\]-~]*\z")
    body = F.when(plain, value).otherwise(F.array_join(F.transform(each, escaped), ""))
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit("null"))


def json_double(value: Column) -> Column:
    """The value as Python prints a float; null becomes null. Meant for magnitudes below 10^7."""
    said = value.cast("string")
    digits = F.regexp_replace(F.regexp_extract(said, r"^-?([\d.]+)E", 1), r"\.0$|\.", "")
    power = -F.regexp_extract(said, r"E(-?\d+)$", 1).try_cast("int")
    sign = F.when(value < 0, "-").otherwise("")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), power - 1), digits)
    mantissa = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""))
    tiny = F.concat(sign, mantissa, F.lit("e-"), F.lpad(power.cast("string"), 2, "0"))
    return F.coalesce(F.when(~said.contains("E"), said).when(power <= 4, small).otherwise(tiny), F.lit("null"))


def entity_iri(platform: Column, kind: Column, entity: Column, base: str = GRAPH) -> Column:
    """The identifier of an entity: the hash of its platform, type and id, under the graph's address."""
    said = F.concat(
        F.lit('{"id": '), json_string(entity), F.lit(', "platform": '), json_string(platform), F.lit(', "type": '), json_string(kind), F.lit("}")
    )
    return F.concat(F.lit(base), F.sha2(said, 256))


def first_with_prefix(values: Column, prefix: str) -> Column:
    """The first element that starts with the prefix; null if there is none."""
    return F.get(F.filter(values, lambda x: F.startswith(x, F.lit(prefix))), 0)


def mint_subject(identifiers: Column, url: Column, row_json: Column, base: str = GRAPH) -> Column:
    """A record's subject: an identifier of the graph, else any IRI, else the hash of its url, else of the record."""
    any_iri = F.get(F.filter(identifiers, is_iri), 0)
    hashed = F.concat(F.lit(base), F.sha2(F.coalesce(F.nullif(F.trim(url), F.lit("")), row_json), 256))
    return F.coalesce(first_with_prefix(identifiers, base), any_iri, hashed)


def shorten_predicate(predicate: Column) -> Column:
    """What stands behind "#", else behind the last slash."""
    return F.when(F.contains(predicate, F.lit("#")), F.substring_index(predicate, "#", -1)).otherwise(F.substring_index(predicate, "/", -1))


def normalise_uri(value: Column, base: str = GRAPH) -> Column:
    """Angle brackets stripped; the graph's address put before what is no http address."""
    bare = F.regexp_replace(F.trim(value), "^<|>$", "")
    return F.when(F.startswith(bare, F.lit("http")), bare).otherwise(F.concat(F.lit(base), bare))


def decode_term(term: Column) -> Column:
    """An N3 term's value: what is in angle brackets, or in quotes, or the term itself."""
    iri, text = F.regexp_extract(term, "^<(.*)>$", 1), F.regexp_extract(term, r'^"(.*)"', 1)
    return F.when(term.rlike("^<.*>$"), iri).when(term.rlike(r'^".*"'), text).otherwise(term)


def snapshot_hash(predicate: Column, value: Column, value_uri: Column, method: Column, confidence: Column, notes: Column) -> Column:
    """The hash of a property snapshot: of its six fields as JSON with sorted keys. The model is not part of it."""
    said = F.concat(
        F.lit('{"confidence": '), json_double(confidence), F.lit(', "extraction_method": '), json_string(method), F.lit(', "notes": '), json_string(notes),
        F.lit(', "predicate_iri": '), json_string(predicate), F.lit(', "value": '), json_string(value), F.lit(', "value_uri": '), json_string(value_uri), F.lit("}"),
    )
    return F.sha2(said, 256)
