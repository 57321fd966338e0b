import pytest

from plumbline.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. Tail.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
CASES = [
    ("Text before. Licensed under the Apache License, Version 2.0.\nMore.", ["apache_short"], ["Apache-2.0"]),
    ("Released under the MIT License\nno full stop", ["mit_short"], ["MIT"]),
    ("Licensed under CC BY-NC 4.0. Released under the MIT License.", ["cc_by_nc_4", "mit_short"], ["CC-BY-NC-4.0", "MIT"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl3_short"], ["GPL-3.0-only"]),
    (MIT, ["mit_title", "mit_grant", "mit_notice", "mit_as_is"], ["MIT"]),
    (APACHE, ["apache_grant", "apache_copy", "apache_see"], ["Apache-2.0"]),
    ("She is licensed under a spell. We warrant nothing.", [], []),
    ("SPDX-License-Identifier: MIT\ncode", ["spdx_mit"], ["MIT"]),
    ("MIT License", ["mit_title"], []),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)], "doc_id long, text string, licences string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_sentences_and_rules(found, case):
    assert list(found[case].sentence_ids) == CASES[case][1]
    assert list(found[case].licences) == CASES[case][2]


def test_known_sentences_have_hints():
    for sentence in licenses.KNOWN:
        assert any(hint in sentence for hint in licenses.HINTS), sentence
    names = set(licenses.KNOWN.values())
    assert {part for _, sequence in licenses.RULES for part in sequence} <= names


def test_matched_sentences_are_taken_once(spark):
    ids = ["mit_grant", "mit_notice", "mit_as_is", "apache_grant"]
    row = spark.range(1).select(licenses.matched(licenses.F.array(*map(licenses.F.lit, ids))).alias("m")).first()
    assert list(row.m) == ["Apache-2.0", "MIT"]


def test_odd_documents(odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(list(r.sentence_ids) == [] and list(r.licences) == [] for r in rows)
    assert licenses.scan(no_docs).count() == 0
    plan = licenses.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_notices_as_they_stand_in_documents_and_spdx_identifiers(spark):
    cases = [
        ("It byanthblely anreed hestwh of.\nAll rights reserved.", ["all_rights"], ["proprietary"]),
        ("Prose.\nLicensed under CC BY-NC 4.0.", ["cc_by_nc_4"], ["CC-BY-NC-4.0"]),
        ("Prose.\nReleased under the MIT License.", ["mit_short"], ["MIT"]),
        ("Prose.\nLicensed under the Apache License, Version 2.0.", ["apache_short"], ["Apache-2.0"]),
        ("All rights reserved.\nReleased under the MIT License.", ["all_rights", "mit_short"], ["MIT"]),
        ("All of them reserved a seat.", [], []),
        ("// SPDX-License-Identifier: BSD-3-Clause\ncode", ["spdx:BSD-3-Clause"], ["BSD-3-Clause"]),
        ("/* SPDX-License-Identifier: bsd-2-clause */", ["spdx:BSD-2-Clause"], ["BSD-2-Clause"]),
        (
            "# SPDX-License-Identifier: (MIT OR LGPL-2.1+) AND GPL-2.0-only WITH Classpath-exception-2.0\nx",
            ["spdx_mit", "spdx:LGPL-2.1+", "spdx:GPL-2.0-only_WITH_Classpath-exception-2.0"],
            ["GPL-2.0-only WITH Classpath-exception-2.0", "LGPL-2.1+", "MIT"],
        ),
        ("SPDX-License-Identifier: NONE", [], []),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    for row in licenses.scan(docs).collect():
        assert list(row.sentence_ids) == cases[row.doc_id][1], row
        assert list(row.licences) == cases[row.doc_id][2], row


def commented(text, first, mark, last):
    lines = [f"{mark} {line}".rstrip() for line in text.strip().split("\n")]
    return "\n".join([first, *lines, last])


BSD = """Copyright (c) 2012, Google Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """3. Neither the name of Google Inc. nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.
"""


def test_wrapped_commented_and_mixed_texts(spark):
    mit, bsd = ["mit_title", "mit_grant", "mit_notice", "mit_as_is"], ["bsd_grant", "bsd_source", "bsd_binary"]
    lines = "Released under the MIT License\ncode\n" * 3
    tight = MIT.replace("License\n\nCopyright", "License\nCopyright").replace("Someone\n\n", "Someone\n")
    cases = [
        (commented(MIT, "/*", " *", " */"), mit, ["MIT"]),
        (commented(MIT, "", "#", ""), mit, ["MIT"]),
        (commented(MIT, "", "!", ""), mit, ["MIT"]),
        (commented(MIT, "", "dnl", ""), mit, ["MIT"]),
        (commented(tight, "/*", " *", " */"), mit, ["MIT"]),
        (BSD, ["all_rights", *bsd], ["BSD-2-Clause"]),
        (BSD.replace("1. ", "(1) ").replace("2. R", "(2) R"), ["all_rights", *bsd], ["BSD-2-Clause"]),
        (BSD + ENDORSE, ["all_rights", *bsd, "bsd_endorse"], ["BSD-3-Clause"]),
        (commented(BSD + ENDORSE, "/*", " *", " */"), ["all_rights", *bsd, "bsd_endorse"], ["BSD-3-Clause"]),
        (APACHE + "\n" + lines, ["apache_grant", "apache_copy", "apache_see"] + ["mit_short"] * 3, ["Apache-2.0", "MIT"]),
        (lines + "\n" + APACHE, ["mit_short"] * 3 + ["apache_grant", "apache_copy", "apache_see"], ["Apache-2.0", "MIT"]),
        ("-" * 50_000 + "." * 50_000 + "licence: " + ":" * 50_000, [], []),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    for row in licenses.scan(docs).collect():
        assert list(row.sentence_ids) == cases[row.doc_id][1], (row.doc_id, row.sentence_ids)
        assert list(row.licences) == cases[row.doc_id][2], row.doc_id
