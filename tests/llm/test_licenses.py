import pytest

from shapeloom.llm import licenses, queries

SAID = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "All rights reserved.": "reserved",
}


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return licenses.fit_licenses(docs)


def test_statements_anywhere_in_a_text(spark, model):
    rows, wanted = [], []
    for i, (said, family) in enumerate(SAID.items()):
        for k, text in enumerate([said, f"Intro line.\n{said}\nmore", f"Words before. {said} Words after it", said.upper(), f"{said} {said}"]):
            rows.append((i * 10 + k, text))
            wanted.append([family])
    rows += [(900 + k, t) for k, t in enumerate(licenses.UNLIKE)] + [(990, "MIT"), (991, "the license"), (992, "under the MIT")]
    wanted += [[] for _ in range(len(rows) - len(wanted))]
    found = {r.id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert [found[key].licenses for key, _ in rows] == wanted
    texts = dict(rows)
    for r in found.values():
        for f in r.found:
            assert f.chance >= model.least_chance and texts[r.id].encode()[f.start : f.end].strip()


def test_wrapped_notices(spark, model):
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation."]
    short = ["This work is licensed under the GNU", "General Public License, version 3"]
    two = ["Released under the", "MIT License", "and other parts are", "Licensed under the Apache", "License, Version 2.0"]
    words = "This work is licensed under the GNU General Public License, version 3".split()
    rows, wanted = [], []
    for lines, families in ((gpl, ["GPL-3.0"]), (short, ["GPL-3.0"]), (two, ["MIT", "Apache-2.0"]), ([" ".join(words[i : i + 2]) for i in range(0, 12, 2)], ["GPL-3.0"])):
        for mark in ("", " * ", "# ", "// ", "//", "-- "):
            rows.append((len(rows), "Intro text\n\n" + "\n".join(mark + x for x in lines) + "\n\nmore words"))
            wanted.append(families)
    rows += [(100, "\n\n".join(short)), (101, "This work is licensed under the contract\nof the general public and its\nversion 3"), (102, "Released under the MIT License\nmore words\nof it")]
    wanted += [[], [], ["MIT"]]
    found = {r.id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert [found[key].licenses for key, _ in rows] == wanted
    assert len(found[102].found) == 1 and "GNU" in rows[6][1].encode()[found[6].found[0].start : found[6].found[0].end].decode()


def test_other_versions_and_kinds_are_not_confirmed(spark, model):
    other = [
        "This work is licensed under the GNU General Public License, version 2", "This work is licensed under the GNU General Public License",
        "Licensed under the Apache License, Version 1.1", "Licensed under the Mozilla Public License, version 1.1", "Licensed under CC BY 3.0", "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution 3.0 International License", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 International License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2", "Licensed under the BSD 2-Clause License",
    ]
    named = [(t, family) for family, texts in licenses.TEMPLATES.items() for t in texts]
    rows = list(enumerate([*other, *(t for t, _ in named)]))
    found = {r.id: r.licenses for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert [(t, found[i]) for i, t in rows[: len(other)] if found[i]] == []
    assert [(t, found[len(other) + i]) for i, (t, f) in enumerate(named) if not set(found[len(other) + i]) <= {f}] == []
    assert [t for i, (t, _) in enumerate(named) if not found[len(other) + i]] == []


def test_odd_rows(odd_docs, no_docs, model):
    clashing = odd_docs.withColumnsRenamed({"source": "licenses", "rate": "found"})
    rows = licenses.scan_licenses(clashing, model=model).collect()
    assert len(rows) == odd_docs.count() and not any(r.licenses for r in rows)
    assert licenses.scan_licenses(no_docs, model=model).count() == 0
    assert licenses.fit_licenses(no_docs).weights.any(), "the templates alone train it"


def test_query_finds_what_the_texts_state(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op9_license_scan(spark, "/root/testdata/sf0.01").collect()
    wanted = {k: {f for said, f in SAID.items() if said in t} for k, t in docs.items()}
    assert len(rows) == len(docs)
    assert {r.doc_id: set(r.licenses) for r in rows} == wanted
