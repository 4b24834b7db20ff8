"""License scans by sentence rules, in DataFrame expressions only.

A text is normalised (lower case, letters and digits, single spaces) and cut into pieces at line ends and stops; known
licence sentences are found from the start of a piece to the end of the same or a later one, so hard-wrapped lines,
comment marks and stops within a sentence do not hide it. What is left of a document is a short sequence of sentence
identifiers. Licence rules are sequences too; a rule holds where its identifiers follow each other in that order among
the recognised sentences, with no more than MAX_GAP other pieces between two of them. A rule that is part of a longer
rule which holds at the same place gives way to it. Both lists are parameters of scan(); SENTENCES and RULES are a base
of common licences.

All of it is row-local: no shuffle, no join, no Python. Cost is linear in the text.

Defined results: a null or empty text has no sentences; a very long text is scanned whole; a row with a null id and
repeated rows are scanned like any other, one result for each row; of sentences that begin at one place the longest
counts; rules of one length are tried in the order of their names; an empty table gives no rows; other columns, whatever
their names, are ignored; documents without a licence sentence come out with empty strings and zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening, licence and notice sentences of widely used licences, normalised, by identifier.
SENTENCES = {
    "a1": "licensed under the apache license version 2 0",
    "a2": "licensed under the apache license version 2 0 the license",
    "a3": "you may not use this file except in compliance with the license",
    "a4": "you may obtain a copy of the license at",
    "a5": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "a6": "see the license for the specific language governing permissions and limitations under the license",
    "b1": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "b2": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "b3": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "b4": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "b5": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "c1": "licensed under cc by nc 4 0",
    "c2": "licensed under cc by 4 0",
    "c3": "licensed under cc by sa 4 0",
    "c4": "this work is licensed under a creative commons attribution 4 0 international license",
    "c5": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "c6": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "c7": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "g1": "this work is licensed under the gnu general public license version 3",
    "g2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "g3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "g4": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "g5": "see the gnu general public license for more details",
    "g6": "you should have received a copy of the gnu general public license along with this program",
    "i1": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "m1": "released under the mit license",
    "m2": "licensed under the mit license",
    "m3": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "m4": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "m5": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "p1": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "s1": "all rights reserved",
}

#: Fixed values: (rule, licence, sentence identifiers in order).
RULES = (
    ("apache-header", "Apache-2.0", ("a2", "a3", "a4", "a5", "a6")),
    ("apache-short-header", "Apache-2.0", ("a2", "a3", "a4")),
    ("apache-notice", "Apache-2.0", ("a1",)),
    ("bsd-3-clause-text", "BSD-3-Clause", ("b1", "b2", "b3", "b4", "b5")),
    ("bsd-2-clause-text", "BSD-2-Clause", ("b1", "b2", "b3", "b5")),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", ("c1",)),
    ("cc-by-notice", "CC-BY-4.0", ("c2",)),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ("c3",)),
    ("cc-by-sentence", "CC-BY-4.0", ("c4",)),
    ("cc-by-sa-sentence", "CC-BY-SA-4.0", ("c5",)),
    ("cc-by-nc-sentence", "CC-BY-NC-4.0", ("c6",)),
    ("cc0-waiver", "CC0-1.0", ("c7",)),
    ("gpl-3-notice", "GPL-3.0", ("g1",)),
    ("gpl-3-header", "GPL-3.0-or-later", ("g2", "g4", "g5", "g6")),
    ("gpl-2-header", "GPL-2.0-or-later", ("g3", "g4", "g5", "g6")),
    ("isc-grant", "ISC", ("i1",)),
    ("mit-text", "MIT", ("m3", "m4", "m5")),
    ("mit-grant", "MIT", ("m3",)),
    ("mit-release", "MIT", ("m1",)),
    ("mit-notice", "MIT", ("m2",)),
    ("mpl-2-notice", "MPL-2.0", ("p1",)),
    ("all-rights-reserved", "Proprietary", ("s1",)),
)

MAX_GAP = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces(text: Column, known: dict[str, str] | None = None) -> Column:
    """The known sentences and the other pieces of a text in order, normalised, without empty ones.

    A piece ends at a line end or behind . : ; ! ? before a blank. A known sentence begins and ends with a piece but
    may run over several, so hard-wrapped lines, comment marks and stops within it do not hide it.
    """
    known = SENTENCES if known is None else known
    # a bar stands where a piece ends; all that is no letter or digit is a blank, comment marks included
    lower = F.translate(F.concat(F.lit("\n"), F.coalesce(text, F.lit(""))), _UPPER + "|", _LOWER + " ")
    broken = F.regexp_replace(lower, r"[.:;!?][ \t\r]+|\n[^a-z0-9\n]*(?:(?:dnl|rem)[ \t]+)?", "|")
    words = F.regexp_replace(F.concat(F.regexp_replace(broken, "[^a-z0-9|]+", " "), F.lit("|")), r" ?\|[| ]*", "|")
    said = "|".join(s.replace(" ", "[ |]") for s in sorted(known.values(), key=lambda s: (-len(s), s)))
    found = F.regexp_extract_all(words, F.lit(rf"(?<=\|)(?:(?:{said})(?=\|)|[^|]+)"), 0)
    return F.transform(found, lambda s: F.trim(F.translate(s, "|", " ")))


def sentence_hits(text: Column, known: dict[str, str] | None = None) -> Column:
    """Array of (pos, id) of the recognised sentences, in order."""
    known = SENTENCES if known is None else known
    texts = F.array(*[F.lit(s) for s in known.values()])
    ids = F.array(*[F.lit(k) for k in known])
    found = F.transform(
        pieces(text, known), lambda s, i: F.struct(i.alias("pos"), F.array_position(texts, s).cast("int").alias("at"))
    )
    return F.transform(
        F.filter(found, lambda x: x["at"] > 0), lambda x: F.struct(x["pos"].alias("pos"), F.element_at(ids, x["at"]).alias("id"))
    )


def chain(hits: Column, max_gap: int = MAX_GAP) -> Column:
    """The identifiers as one string like "<m3><m4><m5>|<s1>": a bar stands where too many other sentences lie between."""
    start = F.struct(F.lit(None).cast("int").alias("pos"), F.lit("").alias("said"))
    return F.aggregate(
        hits,
        start,
        lambda acc, h: F.struct(
            h["pos"].alias("pos"),
            F.concat(
                acc["said"],
                F.when(h["pos"] - acc["pos"] - 1 > max_gap, F.lit("|")).otherwise(F.lit("")),
                F.lit("<"),
                h["id"],
                F.lit(">"),
            ).alias("said"),
        ),
        lambda acc: acc["said"],
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, known: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, rules, licenses) for every document; lists are comma-separated strings.

    Rules come in the order of the rule list, longest first where they nest; each licence is named once, sorted.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[2]), r[0]))
    said = F.col("said")
    # each rule in turn, longest first, takes its sentences out of the chain
    left, found = said, []
    for name, licence, ids in ordered:
        pattern = "".join(f"<{i}>" for i in ids)
        found.append(F.when(F.contains(left, F.lit(pattern)), F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence"))))
        if len(ids) > 1:
            left = F.replace(left, F.lit(pattern), F.lit("|"))
    hits = F.col("hits")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), sentence_hits(F.col(text_col).cast("string"), known).alias("hits"))
    rows = rows.select("doc_id", F.size("hits").alias("n_sentences"), F.transform("hits", lambda h: h["id"]).alias("ids"), chain(hits).alias("said"))
    matched = rows.select("doc_id", "n_sentences", "ids", F.when(F.col("n_sentences") > 0, F.array_compact(F.array(*found))).alias("m"))
    return matched.select(
        "doc_id",
        F.col("n_sentences").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.transform("m", lambda x: x["rule"]), ","), F.lit("")).alias("rules"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: x["licence"]))), ","), F.lit("")).alias("licenses"),
    )


def scan_sql(rules=RULES, known: dict[str, str] | None = None, max_gap: int = MAX_GAP) -> str:
    """DuckDB SQL for scan() over `documents`: sentences as rows, chains by window, then the same ordered rules.

    Wrapped sentences are found as in pieces(); as its expressions have no look-around, a piece takes its bar with it.
    """
    known = SENTENCES if known is None else known
    ordered = sorted(rules, key=lambda r: (-len(r[2]), r[0]))
    values = ", ".join(f"('{k}', '{s}')" for k, s in known.items())
    left, steps = "said", []
    for name, licence, ids in ordered:
        pattern = "".join(f"<{i}>" for i in ids)
        steps.append(f"CASE WHEN contains({left}, '{pattern}') THEN '{name}' END AS \"{name}\"")
        if len(ids) > 1:
            left = f"replace({left}, '{pattern}', '|')"
    names = ", ".join(f'"{n}"' for n, _, _ in ordered)
    licences = ", ".join(f"CASE WHEN \"{n}\" IS NOT NULL THEN '{lic}' END" for n, lic, _ in ordered)
    said = "|".join(s.replace(" ", "[ |]") for s in sorted(known.values(), key=lambda s: (-len(s), s)))
    return f"""
    WITH known(id, s) AS (VALUES {values}),
    lower_case AS (SELECT doc_id, translate('\n' || coalesce(text, ''), '{_UPPER}|', '{_LOWER} ') AS t FROM documents),
    broken AS (SELECT doc_id, regexp_replace(t, '[.:;!?][ \\t\\r]+|\\n[^a-z0-9\\n]*(?:(?:dnl|rem)[ \\t]+)?', '|', 'g') AS t FROM lower_case),
    words AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[^a-z0-9|]+', ' ', 'g') || '|', ' ?\\|[| ]*', '|', 'g') AS t FROM broken),
    cut AS (SELECT doc_id, regexp_extract_all(substr(t, 2), '(?:{said}|[^|]+)\\|') AS parts FROM words),
    each AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS pos FROM cut),
    hit AS (
      SELECT doc_id, pos, id, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS gap
      FROM (SELECT doc_id, pos, trim(replace(s, '|', ' ')) AS s FROM each) JOIN known USING (s)),
    doc AS (
      SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY pos) AS ids,
             string_agg(CASE WHEN gap > {max_gap} THEN '|<' ELSE '<' END || id || '>', '' ORDER BY pos) AS said
      FROM hit GROUP BY doc_id),
    found AS (SELECT doc_id, n, ids, {", ".join(steps)} FROM doc)
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids,
           coalesce(concat_ws(',', {names}), '') AS rules,
           coalesce(array_to_string(list_sort(list_distinct([x FOR x IN [{licences}] IF x IS NOT NULL])), ','), '') AS licenses
    FROM documents d LEFT JOIN found USING (doc_id)
    """
