"""License scans: literal texts, edge cases, and the SQL twin on a whole table."""

import duckdb

from quarry.llm import license_scan as ls
from quarry.session import table

APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0
"""
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
    'included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
    "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT."
)


def rows_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, rules string")
    return {r.doc_id: r for r in ls.scan(docs).collect()}


def test_rules(spark):
    parts = MIT.split("\n\n")
    got = rows_of(
        spark,
        [
            APACHE,
            MIT,
            "Released under the MIT License.",
            "Some text. Licensed under CC BY-NC 4.0. More.\nReleased under the MIT License.",
            parts[0] + "\n\n" + "one.\ntwo.\nthree.\nfour.\n" + parts[1] + "\n" + parts[2],  # too far apart for the whole rule
            "\n".join([parts[1], parts[0], parts[2]]),  # wrong order
            None,
            "",
            "the MIT license is not named as such here",
            MIT + "\n" + MIT,
        ],
    )
    assert [got[i].rules for i in range(10)] == [
        "apache-short-header", "mit-text", "mit-release", "cc-by-nc-notice,mit-release", "mit-grant", "mit-grant", "", "", "", "mit-text",
    ]
    assert got[3].licenses == "CC-BY-NC-4.0,MIT" and got[3].sentence_ids == "c1,m1" and got[0].sentence_ids == "a2,a3,a4"
    assert got[6].n_sentences == 0 and got[8].licenses == ""


def test_rows_stay_and_empty_tables(spark):
    rows = [(1, "Released under the MIT License.", 0)] * 2 + [(None, "x. " * 30_000 + "Released under the MIT License", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int")
    assert [r.licenses for r in ls.scan(docs).collect()] == ["MIT"] * 3
    assert ls.scan(docs.limit(0)).count() == 0


def test_sql_twin(spark):
    base = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{base}/documents.parquet'")
    want = sorted(con.execute(ls.scan_sql()).fetchall())
    columns = [c[0] for c in con.description]
    got = ls.scan(table(spark, base, "documents"))
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == want
    assert sum(1 for r in want if r[columns.index("licenses")]) > 5


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = ls.scan(table(spark, "/root/testdata/sf0.01", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
