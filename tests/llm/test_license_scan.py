from __future__ import annotations

from pyspark.sql import functions as F

from casebook.llm import license_scan

SF = "/root/testdata/sf0.01"
PROSE = "Some prose that has nothing to do with it. It goes on for a while.\n"


def files(spark, rows):
    return spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, Path2 string")


def scanned(spark, rows):
    return [r.asDict() for r in license_scan.scan(files(spark, rows), "doc_id", "path", "text").orderBy("doc_id").collect()]


def test_own_and_inherited_licences(spark):
    rows = [
        ("LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software\n" + PROSE * 5),
        ("src/a.py", PROSE),
        ("src/lib/COPYING.txt", PROSE + "This work is licensed under the GNU General Public License, version 3."),
        ("src/lib/deep/er/b.py", PROSE),
        ("src/lib/c.py", "# Licensed under the Apache License, Version 2.0\n" + PROSE),
        ("srclib/d.py", PROSE),
        ("src/e.py", "We sell licenses and copyright advice.\n" + PROSE),
        ("src/only", "Released under the MIT License."),
        (None, PROSE),
        ("/abs/x", None),
    ]
    found = scanned(spark, rows)
    got = [(r["license"], r["origin"], r["licensed_by"]) for r in found]
    assert got == [
        ("MIT", "own", "LICENSE"),
        ("MIT", "inherited", "src/only"),
        ("GPL-3.0", "own", "src/lib/COPYING.txt"),
        ("GPL-3.0", "inherited", "src/lib/COPYING.txt"),
        ("Apache-2.0", "own", "src/lib/c.py"),
        ("MIT", "inherited", "LICENSE"),
        ("MIT", "inherited", "src/only"),
        ("MIT", "own", "src/only"),
        (None, "none", None),
        ("MIT", "inherited", "LICENSE"),
    ]
    assert all(r["cosine"] is None or license_scan.LEAST_COSINE <= r["cosine"] <= 1 for r in found)


def test_every_template_is_found_and_told_apart(spark):
    rows = [(f"d{i}/f", f"{PROSE}{text}.\n{PROSE}") for i, (_, text) in enumerate(license_scan.TEMPLATES)]
    found = scanned(spark, rows)
    assert [r["license"] for r in found] == [licence for licence, _ in license_scan.TEMPLATES]


def test_query_finds_all_licence_lines(spark):
    found = license_scan.op4_license_scan(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = docs.where(F.lower("text").contains("licen")).select("doc_id")
    assert found.count() == docs.count()
    assert found.where("license is not null").select("doc_id").exceptAll(named).count() == 0
    assert named.exceptAll(found.where("license is not null").select("doc_id")).count() == 0


def test_edge_rows(spark):
    rows = [(None, None), ("", ""), ("a", "x" * 200_000), ("a", "x" * 200_000), ("a/", "license " * 20_000), ("a/LICENSE", "Released under the MIT License.")] * 2
    found = scanned(spark, rows)
    assert len(found) == 12
    assert scanned(spark, [])  == []


def test_no_python_in_the_plan(spark):
    plan = license_scan.op4_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]


def commented(text):
    return "".join(f" * {line}".rstrip() + "\n" for line in text.splitlines())


def test_standard_texts_are_told_apart_by_version(spark):
    texts = license_scan.whole_texts()
    rows = [(f"d{i}/LICENSE", t) for i, (_, t) in enumerate(texts)] + [(f"e{i}/words", t) for i, (_, t) in enumerate(texts)]
    rows += [(f"f{i}/c.c", f"/*\n{commented(t)} */\n\n{PROSE}{PROSE}") for i, (_, t) in enumerate(texts)]
    rows += [(f"e{i}/sub/x", PROSE) for i in range(len(texts))]
    assert [(r["license"], r["origin"]) for r in scanned(spark, rows)] == [(n, o) for o in ("own", "own", "own", "inherited") for n, _ in texts]


def test_openings_and_wrapped_headers(spark):
    header = (
        "Copyright (C) 2020 Somebody\n\nThis program is free software; you can redistribute it and/or modify\nit under the terms of the GNU {}General "
        "Public License as published by\nthe Free Software Foundation; either version {} of the License, or\n(at your option) any later version.\n\n"
        "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {}General Public License for more details.\n"
    )
    opening = lambda name: "\n".join(license_scan.standard_text(name).strip().splitlines()[:2])
    rows = [
        ("GPL-2.0", opening("GPL-2.0")),
        ("GPL-3.0", opening("GPL-3.0")),
        ("LGPL-2.1", opening("LGPL-2.1")),
        ("LGPL-3.0", opening("LGPL-3.0")),
        ("AGPL-3.0", "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007"),
        ("GPL-2.0", header.format("", 2, "")),
        ("GPL-3.0", header.format("", 3, "")),
        ("LGPL-2.1", header.format("Lesser ", 2.1, "Lesser ")),
        ("LGPL-2.1", header.format("Lesser ", 2.1, "Lesser ").replace("program", "library")),
        ("LGPL-3.0", header.format("Lesser ", 3, "Lesser ").replace("program", "library")),
        ("AGPL-3.0", header.format("Affero ", 3, "Affero ")),
        ("ISC", license_scan.standard_text("ISC").split("THE SOFTWARE")[0]),
        (None, "See the GNU General Public License for more details."),
    ]
    found = scanned(spark, [(f"d{i}/f.c", f"/*\n{commented(t)} */\n\n{PROSE}") for i, (_, t) in enumerate(rows)])
    assert [r["license"] for r in found] == [n for n, _ in rows]
