"""Turtle files: triples grouped by subject and predicate, with prefixes learned from the triples, and back.

Triples are range partitioned by subject, predicate and a hash of the object, and each file is written as its sorted rows come. A subject
with very many triples is cut at a file's end and begins again in the next one, so no group is held anywhere. Every file
begins with the same prefixes and can be read by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of triples in a file, about.
FILE_BYTES = 16 << 20
#: How many namespaces get a prefix: the most frequent ones. IRIs of others are written out.
PREFIXES = 100

_NAMESPACE, _LOCAL = r"(?s)^(.*[/#])[^/#]*$", "^[A-Za-z_][A-Za-z0-9_]*$"
#: What an IRI must not hold as it is, in Turtle.
_NOT_IN_IRI = '\\<>"{}|^` \n\r\t'


def namespaces(triples: DataFrame, most: int = PREFIXES) -> list[tuple[str, str]]:
    """(prefix, namespace) of the most frequent namespaces, ties by name. At most that many rows reach the driver."""
    iris = F.array("s", "p", F.when(F.col("o_is_iri"), F.col("o")))
    each = triples.select(F.explode(iris).alias("iri")).select(F.regexp_extract("iri", _NAMESPACE, 1).alias("ns"), F.regexp_replace("iri", r"(?s)^.*[/#]", "").alias("local"))
    counted = each.filter((F.col("ns") != "") & F.col("local").rlike(_LOCAL)).groupBy("ns").agg(F.count(F.lit(1)).alias("n"))
    return [(f"n{i}", r.ns) for i, r in enumerate(counted.orderBy(F.desc("n"), "ns").limit(most).collect())]


def _escaped(value: Column, marks: dict[str, str]) -> Column:
    for mark, said in marks.items():
        value = F.replace(value, F.lit(mark), F.lit(said))
    return value


def _iri(value: Column, prefixes: list[tuple[str, str]]) -> Column:
    whole = F.concat(F.lit("<"), _escaped(value, {c: f"\\u{ord(c):04X}" for c in _NOT_IN_IRI}), F.lit(">"))
    if not prefixes:
        return whole
    known = F.create_map(*[F.lit(x) for prefix, ns in prefixes for x in (ns, prefix)])
    local = F.regexp_replace(value, r"(?s)^.*[/#]", "")
    prefix = F.try_element_at(known, F.regexp_extract(value, _NAMESPACE, 1))
    return F.when(prefix.isNotNull() & local.rlike(_LOCAL), F.concat(prefix, F.lit(":"), local)).otherwise(whole)


def _literal(value: Column) -> Column:
    return F.concat(F.lit('"'), _escaped(value, {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r"}), F.lit('"'))


def write_turtle(triples: DataFrame, path: str, file_bytes: int = FILE_BYTES, most: int = PREFIXES) -> None:
    """Triples (s, p, o, o_is_iri) as Turtle files in a new folder, each triple once.

    A triple with a null is left out; an empty table gives files without triples. Other columns are ignored. A literal
    of any length is one line of its file, whatever the file's size. The triples are gone over twice: for their bytes and
    namespaces in one pass, and for the files; equal triples meet in one file, side by side, so they need no other shuffle.
    """
    own = triples.select("s", "p", "o", "o_is_iri").filter("s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL AND o_is_iri IS NOT NULL")
    total = F.sum(F.octet_length("s") + F.octet_length("p") + F.octet_length("o")).alias("bytes")
    measured = Observation()
    prefixes = namespaces(own.observe(measured, total), most)
    # a plan that is empty from the start is not observed
    size = (measured.get["bytes"] if prefixes else own.agg(total).first()["bytes"]) or 0
    header = "\n".join(f"@prefix {p}: {_header_iri(ns)} ." for p, ns in prefixes)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subject = predicate = obj = None
        for batch in batches:
            same_s = batch.s == batch.s.shift(fill_value=subject or "")
            same_p = same_s & (batch.p == batch.p.shift(fill_value=predicate or ""))
            new = ~(same_p & (batch.o == batch.o.shift(fill_value=obj or "")))
            batch, same_s, same_p = batch[new], same_s[new], same_p[new]
            if batch.empty:
                continue
            text = "  , " + batch.o
            text = text.where(same_p, "; " + batch.p + " " + batch.o)
            text = text.where(same_s, ".\n" + batch.s + " " + batch.p + " " + batch.o)
            if subject is None:
                text.iloc[0] = header + text.iloc[0][1:]
            subject, predicate, obj = batch.s.iloc[-1], batch.p.iloc[-1], batch.o.iloc[-1]
            yield pd.DataFrame({"value": text})
        if subject is not None:
            yield pd.DataFrame({"value": ["."]})

    said = own.select(_iri(F.col("s"), prefixes).alias("s"), _iri(F.col("p"), prefixes).alias("p"), F.when(F.col("o_is_iri"), _iri(F.col("o"), prefixes)).otherwise(_literal(F.col("o"))).alias("o"))
    # ranges are cut by a hash of the object, as a sample of the cutting columns goes to the driver
    keyed = said.withColumn("h", F.xxhash64("o"))
    cut = keyed.repartitionByRange(max(1, -(-size // file_bytes)), "s", "p", "h").sortWithinPartitions("s", "p", "h", "o")
    cut.drop("h").mapInPandas(lines, "value string").write.text(path)


def _header_iri(iri: str) -> str:
    return "<" + "".join(f"\\u{ord(c):04X}" if c in _NOT_IN_IRI else c for c in iri) + ">"


_TOKEN = re.compile(r'@prefix\s+(\w+):\s+<([^>]*)>\s+\.|<([^>]*)>|(\w+):(\w+)|"([^"\\]*(?:\\.[^"\\]*)*)"|([.;,])', re.S)
_ESCAPE = re.compile(r"\\(?:u([0-9A-F]{4})|(.))", re.S)


def _plain(said: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else {"n": "\n", "r": "\r"}.get(m[2], m[2]), said)


def _triples_of(text: str) -> Iterator[tuple[str, str, str, bool]]:
    prefixes: dict[str, str] = {}
    terms: list[tuple[str, bool]] = []
    for m in _TOKEN.finditer(text):
        if m[1]:
            prefixes[m[1]] = _plain(m[2])
        elif m[7]:
            if len(terms) == 3:
                yield terms[0][0], terms[1][0], terms[2][0], terms[2][1]
            terms = terms[: {".": 0, ";": 1, ",": 2}[m[7]]]
        elif m[3] is not None:
            terms.append((_plain(m[3]), True))
        elif m[4]:
            terms.append((prefixes[m[4]] + m[5], True))
        else:
            terms.append((_plain(m[6]), False))


def read_turtle(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o, o_is_iri) from files that write_turtle has written; a file, of bounded size, is read by one task."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["s", "p", "o", "o_is_iri"]
        for batch in batches:
            for text in batch.value:
                rows: list[tuple[str, str, str, bool]] = []
                for row in _triples_of(text):
                    rows.append(row)
                    if len(rows) == 2000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return spark.read.text(path, wholetext=True).mapInPandas(parsed, "s string, p string, o string, o_is_iri boolean")
