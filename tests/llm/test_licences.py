"""Licence scan: planted notices, near notices and plain text."""

import re

import pytest

from strataloom.llm import licences
from strataloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
#: The lines that the tables hold, with their families.
LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


def test_planted_notices(spark):
    plain = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 200").collect() if not re.search("licen", r.text, re.I)]
    rows = [(d, t, "q") for d, t in plain]
    planted = {}
    for i, (line, family) in enumerate(LINES.items()):
        rows.append((1000 + i, plain[i][1] + "\n" + line + "\n" + plain[i + 5][1], "q"))
        planted[1000 + i] = [family]
    more = {1010: ("SPDX-License-Identifier: BSD-3-Clause", ["BSD"]), 1011: ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA"]), 1012: ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["MPL-2.0"]), 1013: ("RELEASED UNDER THE MIT LICENSE\n\nlicensed under the apache license, version 2.0", ["Apache-2.0", "MIT"])}
    for d, (text, families) in more.items():
        rows.append((d, text, "q"))
        planted[d] = families
    rows += [(2000, "Licensed under the Zebra License, edition seven.", "q"), (2001, None, "q"), (2002, "", "q"), (None, "Released under the MIT License.", "q"), (2003, "\n \n", "q"), (2004, "x y\n" * 20000, "q"), (1013, rows[-1][1], "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, family string")
    found = licences.scan(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id in planted and r.families != []:
            assert r.families == planted[r.doc_id], r
    assert sorted(d for d in planted if any(r.doc_id == d and r.families == planted[d] for r in found)) == sorted(planted)
    by_id = {r.doc_id: r for r in found}
    assert by_id[2000].families == [] and by_id[2000].n_unknown == 1
    assert by_id[None].families == ["MIT"]
    for d in (2001, 2002, 2003):
        assert (by_id[d].n_paragraphs, by_id[d].families, by_id[d].n_unknown, by_id[d].top_probability) == (0, [], 0, None)
    assert by_id[2004].n_paragraphs == 20000
    assert all(by_id[d].families == [] and by_id[d].n_unknown == 0 for d, _ in plain)
    where = licences.licence_paragraphs(docs).where("doc_id = 1013 AND confirmed").collect()
    assert sorted((r.paragraph, r.family) for r in where) == [(0, "MIT")] * 2 + [(2, "Apache-2.0")] * 2  # the row is there twice


WRAPPED = {
    "BSD": ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"],
    "MIT": ["Permission is hereby granted, free of charge, to any person", "obtaining a copy of this software and associated documentation files"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for", "any purpose with or without fee is hereby granted, provided that the", "above copyright notice appear in all copies."],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public", "License, v. 2.0. If a copy of the MPL was not distributed with this"],
}


@pytest.mark.parametrize("part", [0, 1])
def test_wrapped_headers_and_unknown_ones(spark, part):
    """Notices that run over several lines, with comment marks and without; two samples of other text."""
    plain = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where(f"doc_id < 400 AND doc_id % 2 = {part}").collect() if not re.search("licen", r.text, re.I)]
    rows, planted = list(plain), {}
    for i, (family, lines) in enumerate(WRAPPED.items()):
        for k, mark in enumerate(["", "# ", " * ", "// "]):
            d = 5000 + 10 * i + k
            rows.append((d, f"first words of a file\n{mark}\n" + "\n".join(mark + x for x in lines) + "\n\n" + plain[i][1]))
            planted[d] = family
    unknown = ["Licensed under the Zebra License, edition seven.", "SPDX-License-Identifier: EUPL-1.2", "Distributed under the terms of the Walrus Public License."]
    rows += [(9000 + i, line) for i, line in enumerate(unknown)]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d: found[d].families for d in planted} == {d: [f] for d, f in planted.items()}
    assert [(found[9000 + i].families, found[9000 + i].n_unknown) for i in range(len(unknown))] == [([], 1)] * len(unknown)
    assert sum(found[d].families != [] or found[d].n_unknown > 0 for d, _ in plain) == 0


def test_no_rows(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    """Every document of the table against a plain search for the lines it holds."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = QUERIES["op4_licences"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    wrong = [r.doc_id for r in found if r.families != sorted({f for line, f in LINES.items() if line.lower() in docs[r.doc_id].lower().split("\n")})]
    assert len(wrong) <= 0.005 * len(docs), wrong[:10]


def test_every_line_counts_in_the_fit(spark):
    """No document is left out of the model and its limits, however many there are."""
    kinds = ["just a line of plain text", "the code of the door", "a line with one copy left", "under the terms of the day"]
    rows = [(i, "\n".join([kinds[i % 4], "", kinds[(i // 4) % 4] + f" {i}"])) for i in range(1200)] + [(5000, "Released under the MIT License."), (5001, None)]
    scanner = licences.Scanner(spark.createDataFrame(rows, "doc_id bigint, text string"))
    heads, marks = scanner.marks.where("paragraph IS NULL"), scanner.marks.where("paragraph IS NOT NULL")
    counted = heads.selectExpr("sum(n_paragraphs)", "sum(n_bare + n_bare_held)", "count(*)").first()
    assert (counted[0], counted[2]) == (2401, 1202) and counted[1] + marks.count() == 2401
    held = [t.split("\n")[k] for _, t in rows[:1200] for k in (0, 2) if re.search(r"\bcode\b|\bcopy\b", t.split("\n")[k])]
    wanted = spark.createDataFrame([(x,) for x in held], "line string").where(f"pmod(xxhash64(line), {licences.CALIBRATION}) = 0").count()
    assert scanner._training().where("tells").selectExpr("sum(n_held)").first()[0] == wanted > 0


def test_the_fit_is_as_wide_as_the_vocabulary(spark):
    """The driver holds some vectors of classes times columns, and gets one from every branch of a sum."""
    scanner = licences.Scanner(spark.createDataFrame([(1, "Released under the MIT License."), (2, "a line of text")], "doc_id bigint, text string"))
    assert 0 < scanner.model.numFeatures <= len(scanner.vocabulary)
    whole = spark.createDataFrame([(licences.SEPARATOR.join(scanner.vocabulary),), *((g,) for g in scanner.vocabulary), ("",)], "features string")
    found = [r.features for r in scanner._featured(whole).collect()]
    assert {v.size for v in found} == {scanner.model.numFeatures}
    assert sorted(v.numNonzeros() for v in found) == [0, *[1] * len(scanner.vocabulary), scanner.model.numFeatures]  # every word and pair has a column
