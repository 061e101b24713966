"""Normal forms and lookups; the SQL form on the given tables is compared in test_llm_queries."""

import os
import textwrap

import compare
import pytest
from pyspark.sql import functions as F

from tillwise.llm import licences, registry

MIT = licences.KNOWN["MIT"]


def form(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(licences.normalise(F.col("t"))).first()[0]


def test_equal_forms(spark):
    altered = MIT.upper().replace("\n", "\n\n  ").replace(",", " ;").replace("(C) <YEAR> <COPYRIGHT HOLDERS>", "2024 Someone Else")
    assert altered != MIT and form(spark, altered) == form(spark, MIT)
    assert form(spark, "  The LICENCE is granted -- by the Organisation.") == form(spark, "the license is granted by the organization")
    assert form(spark, "* Copyright 2001 X\r\nText") == form(spark, "text")
    assert form(spark, "Grüße 漢字") != form(spark, "Gre")  # other scripts stay
    assert form(spark, None) == form(spark, " \n--") == ""


def test_known_texts_wrapped_at_any_width(spark):
    rows = []
    for name, text in licences.KNOWN.items():
        for width in (30, 45, 60, 66, 72, 78, 100):
            for line in ("Copyright (c) 2020, Some One", "Copyright Some One 1999", "(c) 2011 Some One", "Copyright by Some One", "© Some One"):
                body = [line if p.startswith("Copyright") else textwrap.fill(p, width) for p in text.split("\n")]
                rows.append((f"{name} {width}", "\n".join(body)))
    found = licences.scan(spark.createDataFrame(rows, "doc_id string, text string"), licences.known_digests(spark)).collect()
    assert len(found) == len(rows) and [r.doc_id for r in found if r.license != r.doc_id.rsplit(" ", 1)[0]] == []


def test_body_lines_stay(spark):
    for line in ("copyright treaty adopted on 20 December 1996, or", "copyright owners of 2001 works agree", "copyright notice and this permission notice", "copyright holders be liable", "(c) You must retain all notices"):
        assert form(spark, f"x\n{line}\ny") == form(spark, f"x {line} y") != "x y"


def test_rules_do_not_feed_themselves():
    for spelling, same in licences.SPELLINGS:
        assert spelling not in same, (spelling, same)


def test_scan(spark):
    rows = [(1, MIT.lower(), "a"), (2, None, "a"), (3, "", "b"), (4, "word " * 40_000, "b"), (5, "Licensed under CC BY-NC 4.0.\nMore.", "c"),
            (6, "LICENCED under CC-BY NC 4.0", None), (6, "LICENCED under CC-BY NC 4.0", None), (None, "released under the MIT licence", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string")
    known = licences.known_texts(spark).union(spark.createDataFrame([("empty", " - "), ("A-MIT", MIT)], "license string, text string"))
    known = licences.digests_of(known)
    found = licences.scan(docs, known)
    assert found.columns == ["doc_id", "digest", "license"]
    assert sorted((str(r.doc_id), r.license or "") for r in found.collect()) == [
        ("1", "A-MIT"), ("2", ""), ("3", ""), ("4", ""), ("5", ""), ("6", "CC-BY-NC-4.0-notice"), ("6", "CC-BY-NC-4.0-notice"), ("None", "MIT-notice"),
    ]
    assert licences.scan(docs.limit(0), known).count() == 0 and licences.scan(docs, known.limit(0)).filter("license is null").count() == len(rows)


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    plan = licences.scan(docs, licences.known_digests(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


FOLDER = "/usr/share/common-licenses"
FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic-1.0-Perl": "Artistic", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1.0": "GPL-1",
    "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def altered(text):
    """The text in capitals, indented, with other paragraphs and punctuation."""
    return "\n".join("  * " + line.upper().replace(", ", " , ") for line in text.split("\n") if line.strip())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the licence texts of a Debian system")
def test_long_texts_have_the_known_digests(spark):
    texts = {name: open(f"{FOLDER}/{file}", encoding="utf-8", errors="replace").read() for name, file in FILES.items()}
    assert set(texts) == set(licences.DIGESTS)
    rows = [row for name, text in texts.items() for row in ((name, text), (name, altered(text)))]
    found = licences.scan(spark.createDataFrame(rows, "doc_id string, text string"), licences.known_digests(spark))
    assert [r.doc_id for r in found.collect() if r.license != r.doc_id] == []


def test_query_finds_every_known_text_as_sql_does(spark, tmp_path):
    rows = []
    for text in licences.KNOWN.values():
        body = "\n".join("Copyright 2020-2024 Some One" if p.startswith("Copyright") else textwrap.fill(p, 60) for p in text.split("\n"))
        rows += [text, body, altered(text), text + " and more"]
    rows += [None, "", "x\ncopyright notice and this permission notice appear in all copies.\ny", "© 2001 A\nx", "a\r\nCopyright A 1999\r\nb", "Grüße\u2028(c) 1999 x"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id bigint, text string, license string")
    docs.coalesce(1).write.parquet(str(tmp_path / "t"))
    next((tmp_path / "t").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    out = registry.SPARK["op10_licence_lookup"](spark, str(tmp_path))
    names = [r.license for r in out.orderBy("doc_id").collect()][: 4 * len(licences.KNOWN)]
    assert names == [name if i < 3 else None for name in licences.KNOWN for i in range(4)]
    difference = compare.difference(out, compare.connect(str(tmp_path)), registry.SQL["op10_licence_lookup"])
    assert not difference, difference
