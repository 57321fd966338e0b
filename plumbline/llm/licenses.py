"""Licence recognition by sentences and ordered rules.

A text is cut into sentences, each sentence is normalised and looked up among the known
sentences of licences, unknown ones by their parts and lines, and the sequence of identifiers found is matched against rules. Rules
come in order, the most specific first; what a rule has matched is taken out of the sequence, so a
weaker rule cannot claim the same sentences again.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Column, let

# Sentences of public licence texts and notices, as published. Several
# wordings may stand for one identifier.
SENTENCES = [
    ("apache_grant", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("apache_grant", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("apache_short", "Licensed under the Apache License, Version 2.0"),
    ("apache_short", "Released under the Apache License, Version 2.0"),
    ("apache_comply", "you may not use this file except in compliance with the License"),
    ("apache_copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache_as_is", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("apache_see", "See the License for the specific language governing permissions and limitations under the License"),
    ("mit_short", "Released under the MIT License"),
    ("mit_short", "Licensed under the MIT License"),
    ("mit_title", "The MIT License (MIT)"),
    ("mit_title", "MIT License"),
    ("mit_grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit_notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit_as_is", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("gpl3_short", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl3_short", "Licensed under the GNU General Public License, version 3"),
    ("gpl3_later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl2_later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl_hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("gpl_details", "See the GNU General Public License for more details"),
    ("bsd_grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd_source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd_binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd_endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc_by_nc_4", "Licensed under CC BY-NC 4.0"),
    ("cc_by_nc_4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc_by_4", "Licensed under CC BY 4.0"),
    ("cc_by_4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc_by_sa_4", "Licensed under CC BY-SA 4.0"),
    ("cc_by_sa_4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("spdx_apache", "SPDX-License-Identifier: Apache-2.0"),
    ("spdx_mit", "SPDX-License-Identifier: MIT"),
    ("spdx_gpl3", "SPDX-License-Identifier: GPL-3.0-only"),
    ("all_rights", "Copyright, all rights reserved"),
    ("all_rights", "All rights reserved"),
]

# (licence, identifiers in sequence), tried from the top.
RULES = [
    ("Apache-2.0", ("apache_grant", "apache_comply", "apache_copy", "apache_as_is", "apache_see")),
    ("Apache-2.0", ("apache_grant", "apache_copy", "apache_as_is", "apache_see")),
    ("MIT", ("mit_title", "mit_grant", "mit_notice", "mit_as_is")),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    ("GPL-3.0-or-later", ("gpl3_later", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl2_later", "gpl_hope", "gpl_details")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_grant",)),
    ("Apache-2.0", ("apache_short",)),
    ("Apache-2.0", ("spdx_apache",)),
    ("MIT", ("mit_short",)),
    ("MIT", ("mit_grant",)),
    ("MIT", ("spdx_mit",)),
    ("GPL-3.0-or-later", ("gpl3_later",)),
    ("GPL-2.0-or-later", ("gpl2_later",)),
    ("GPL-3.0-only", ("gpl3_short",)),
    ("GPL-3.0-only", ("spdx_gpl3",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("CC-BY-4.0", ("cc_by_4",)),
    # Counts only where no other sentence of a licence is found.
    ("proprietary", ("all_rights",)),
]

# SPDX tags, and what stands behind them by AND and OR. Identifiers with a sentence of their
# own keep its name; the others are named as written, ``spdx:`` in front.
SPDX_TAG = "spdx-license-identifier:"
SPDX = (
    rf"(?:(?i:{SPDX_TAG})|\G(?!\A)[ \t)]+(?:AND|OR)\b)[ \t(]*"
    r"[a-zA-Z0-9.+:-]*[a-zA-Z0-9+](?:[ \t]+WITH[ \t]+[a-zA-Z0-9.-]*[a-zA-Z0-9])?"
)
SPDX_HEAD = rf"^(?:(?i:{SPDX_TAG})|[ \t)]+(?:AND|OR)\b)[ \t(]*"
SPDX_SENTENCES = {"apache-2.0": "spdx_apache", "mit": "spdx_mit", "gpl-3.0-only": "spdx_gpl3"}
SPDX_NONE = ("none", "noassertion")
SPDX_NAMES = {name.lower(): name for name, _ in RULES if name != "proprietary"}

# Sentences end at these marks before white space, or at an empty line.
END = r"[.!?]+([ \t\r\n\f\x0B]|\z)|\n[ \t\r]*\n"
CUT = "\x01"
OTHER = "[^a-z0-9]+"

# The cuts of the scan. What stands at line starts besides words is dropped, so lines of
# comment markers are empty ones.
MARKERS = r"(?md)^[ \t*#/;%!|<>=~_+'\"\\.:-]*+(?:@?(?i:rem|dnl)(?=[ \t\r\n]|\z)[ \t]*+)?"
SENTENCE_END = r"(?<![.!?])[.!?]++(?:[ \t\r\n\f\x0B]|\z)|\n[ \t\r]*+\n"
# Labels of list items.
LABEL = r"\(?(?:[0-9]{1,2}|[a-z])[.)]"
# Names of holders stand for the words of the published text.
HOLDER = r"(?is)\bneither\s{1,40}the\s{1,40}names?\s{1,40}of\s.{1,200}?\snor\s{1,40}the\s{1,40}names?\s{1,40}of\b"
HOLDER_WORDS = "neither the name of the copyright holder nor the names of"


def _part_end() -> str:
    """Ends of parts of an unknown sentence: a colon before a list or at a line end, and a line
    end before the first words of a known sentence."""
    starts = sorted({"[^a-z0-9]{1,40}".join(sentence.split()[:3]) for sentence in KNOWN})
    first = rf"[^a-z0-9\n]{{0,40}}(?:{LABEL}[ \t]{{1,40}})?(?:{'|'.join(starts)})\b"
    return rf"(?i):[^a-z0-9\n]{{0,80}}+(?=\n)|:[ \t]{{1,80}}(?={LABEL})|\n(?={first})"


# Every known sentence holds one of these, so texts without them need no look.
HINTS = ("licens", "redistribut", "warrant", "permission", "copyright", "reserved")


def normalised(sentence: str) -> str:
    """Lower-cased letters and digits, all else as one space."""
    return re.sub(OTHER, " ", sentence.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))).strip()


KNOWN = {normalised(sentence): name for name, sentence in SENTENCES}


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def spdx_ids(text: Column) -> Column:
    """One identifier for each licence named by the SPDX tags of a text."""
    tags = F.transform(
        F.regexp_extract_all(text, F.lit(SPDX), F.lit(0)),
        lambda tag: F.regexp_replace(F.regexp_replace(tag, SPDX_HEAD, ""), "[ \t]+", "_"),
    )
    named = F.filter(tags, lambda name: ~_lower(name).isin(*SPDX_NONE))
    return F.transform(
        named,
        lambda name: F.coalesce(
            F.try_element_at(_map(SPDX_SENTENCES), _lower(name)),
            F.concat(F.lit("spdx:"), F.coalesce(F.try_element_at(_map(SPDX_NAMES), _lower(name)), name)),
        ),
    )


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _hinted(text: Column) -> Column:
    lower, hinted = _lower(text), F.lit(False)
    for hint in HINTS:
        hinted = hinted | F.contains(lower, F.lit(hint))
    return hinted


def _known(sentence: Column) -> Column:
    """The identifier of a known sentence, with or without the label of a list item."""
    bare = F.regexp_replace(_lower(sentence), rf"^[^a-z0-9]*+(?:[0-9]{{1,2}}|[a-z])[.)][ \t]+", "")
    return F.try_element_at(_map(KNOWN), F.trim(F.regexp_replace(bare, OTHER, " ")))


def _cut(text: Column, end: str, otherwise) -> Column:
    """The identifiers of the pieces between ends, in order; unknown ones are cut further."""

    def of(piece: Column) -> Column:
        def named(found: Column) -> Column:
            return F.when(found.isNotNull(), F.array(found)).otherwise(otherwise(piece))

        tagged = F.contains(_lower(piece), F.lit(SPDX_TAG))
        whole = F.when(tagged, F.lit(None).cast("string")).otherwise(_known(piece))
        return F.when(_hinted(piece), let(whole, named)).otherwise(_nothing())

    return F.flatten(F.transform(F.split(F.regexp_replace(text, end, CUT), CUT), of))


def sentence_ids(text: Column) -> Column:
    """Identifiers by sentences; an unknown sentence is cut into parts, an unknown part into
    lines, so that notices without a full stop are found where they stand."""
    text = F.coalesce(text, F.lit(""))
    ends = _part_end()

    def parts(sentence: Column) -> Column:
        return _cut(sentence, ends, lambda part: _cut(part, "\n", spdx_ids))

    plain = F.regexp_replace(F.regexp_replace(text, MARKERS, ""), HOLDER, HOLDER_WORDS)
    return F.when(_hinted(text), let(plain, lambda t: _cut(t, SENTENCE_END, parts))).otherwise(_nothing())


def matched(ids: Column) -> Column:
    """The licences of a sequence of identifiers, by the ordered rules, each once, and those
    that SPDX tags name. Rights reserved beside a sentence of a licence are no licence."""
    marked = F.concat_ws("", F.transform(ids, lambda name: F.concat(F.lit("<"), name, F.lit(">"))))
    state = F.struct(marked.alias("left"), F.array().cast("array<string>").alias("found"))
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq")) for name, seq in RULES]
    )

    def apply(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["left"], rule["seq"])
        return F.struct(
            # A bar stays behind, so that what stood apart does not become neighbours.
            F.replace(acc["left"], rule["seq"], F.lit("|")).alias("left"),
            F.when(hit, F.array_append(acc["found"], rule["name"])).otherwise(acc["found"]).alias("found"),
        )

    tagged = F.transform(
        F.filter(ids, lambda name: F.startswith(name, F.lit("spdx:"))),
        lambda name: F.translate(F.substring(name, 6, 1 << 30), "_", " "),
    )
    by_rule = F.aggregate(rules, state, apply, lambda acc: acc["found"])
    other = F.exists(ids, lambda name: name != "all_rights")
    by_rule = F.when(other, F.array_remove(by_rule, "proprietary")).otherwise(by_rule)
    found = F.array_sort(F.array_distinct(F.concat(by_rule, tagged)))
    return F.when(F.size(ids) > 0, found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``sentence_ids`` and ``licences`` (arrays).

    Null, empty and unlicensed texts have empty arrays; repeated rows and null ids stay; other
    columns are not carried. Whole texts are read.
    """
    found = docs.select(F.col(id_column).alias("doc_id"), sentence_ids(F.col(text_column)).alias("sentence_ids"))
    return found.withColumn("licences", matched(F.col("sentence_ids")))
