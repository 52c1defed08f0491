"""License scan by sentence rules, in DataFrame expressions only.

A whole text is normalised (A-Z lower-cased, everything but letters and digits to single spaces; marks and list numbers
at the start of a line are left out) and keeps its line ends and its sentence ends: . ! ? ; followed by white space, and
blank lines. A known licence sentence may run over line ends, as wrapped texts do, but over no sentence end; it starts
and ends at one or the other. The identifiers of a text, in order and with ``/`` where unknown sentences lie between, are
then matched against the ordered licence rules: an earlier rule takes its sentences away from later ones.

The sentence table is part of the operator and bounded (``SENTENCES``), so every sentence is a step of the expression; no
row leaves its partition.

Edge cases: a null or empty text has no sentences and no licences. Repeated rows come back as often as they came; a null
doc_id is kept. A known sentence that fits no rule is counted in n_known, and gives no licence. Other columns pass through
whatever their names, but for older ones of the three that are added. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import helper, table

# Known licence sentences, normalised, and their identifiers (capitals A-Z).
SENTENCES = {
    "released under the mit license": "MITNAME",
    "licensed under the mit license": "MITNAME",
    "this project is licensed under the mit license": "MITNAME",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "WARRANTY",
    "licensed under the apache license version 2 0": "APACHENAME",
    "licensed under the apache license version 2 0 the license": "APACHENAME",
    "you may not use this file except in compliance with the license": "COMPLY",
    "you may obtain a copy of the license at": "OBTAIN",
    "http www apache org licenses license 2 0": "APACHEURL",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "BASIS",
    "this work is licensed under the gnu general public license version 3": "GPLNAME",
    "licensed under the gnu general public license version 3": "GPLNAME",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPLTHREE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPLTWO",
    "licensed under cc by nc 4 0": "BYNC",
    "this work is licensed under cc by nc 4 0": "BYNC",
    "licensed under cc by 4 0": "BY",
    "this work is licensed under a creative commons attribution 4 0 international license": "BY",
    "licensed under cc by sa 4 0": "BYSA",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "ENDORSE",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "DISCLAIMER",
    "this is free and unencumbered software released into the public domain": "PUBLIC",
    "all rights reserved": "RESERVED",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "LIABLE",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "DAMAGES",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGRANT",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPLNAME",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "HOPE",
    "you should have received a copy of the gnu general public license along with this program": "RECEIVED",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZLIBGRANT",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "WTFPL",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "BYSA",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "BYNC",
}

# Licence rules in order; a rule is a run of sentence identifiers.
RULES = [
    ("MIT", "MITGRANT NOTICE WARRANTY"),
    ("MIT", "MITGRANT NOTICE"),
    ("Apache-2.0", "APACHENAME COMPLY OBTAIN APACHEURL BASIS"),
    ("Apache-2.0", "APACHENAME COMPLY OBTAIN"),
    ("BSD-3-Clause", "BSDGRANT SOURCE BINARY ENDORSE DISCLAIMER"),
    ("BSD-3-Clause", "BSDGRANT SOURCE BINARY ENDORSE"),
    ("BSD-2-Clause", "BSDGRANT SOURCE BINARY DISCLAIMER"),
    ("BSD-2-Clause", "BSDGRANT SOURCE BINARY"),
    ("GPL-3.0-or-later", "GPLTHREE"),
    ("GPL-2.0-or-later", "GPLTWO"),
    ("MIT", "MITNAME"),
    ("Apache-2.0", "APACHENAME"),
    ("GPL-3.0-only", "GPLNAME"),
    ("CC-BY-NC-4.0", "BYNC"),
    ("CC-BY-4.0", "BY"),
    ("CC-BY-SA-4.0", "BYSA"),
    ("Unlicense", "PUBLIC"),
    ("MIT", "MITGRANT"),
    ("BSD", "BSDGRANT"),
    ("ISC", "ISCGRANT"),
    ("MPL-2.0", "MPLNAME"),
    ("LGPL-2.1-or-later", "LGPL"),
    ("AGPL-3.0-or-later", "AGPL"),
    ("Zlib", "ZLIBGRANT"),
    ("WTFPL", "WTFPL"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# steps of normalising, the same for Spark and SQL: line ends, with all marks and list numbers after them, to one; sentence
# ends and blank lines to \f; then all but the words to single spaces, with none beside line and sentence ends
STEPS = [
    (r"(?:\r\n|[\r\n])[^a-z0-9\r\n]*(?:(?:[0-9]{1,2}|[a-z])[.)][\x20\t]+[^a-z0-9\r\n]*)?", "\n"),
    (r"\n{2,}|[.!?;]+(?:[\x20\t\n]+|\z)", "\f"),
    (r"[^a-z0-9\n\f]+", " "),
    (r"\x20?\n\x20?", "\n"),
    (r"\x20?\f\x20?", "\f"),
]


def _wrapped(sentence: str, end: str) -> str:
    """The sentence with a space or a line end between its words."""
    return sentence.replace(" ", f"(?:\x20|{end})")


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """docs without text, with n_known (known sentences), sequence (their identifiers) and licences (comma-joined, in order of rules)."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    plain, ids_of, sequence = helper(docs, "plain"), helper(docs, "ids"), helper(docs, "sequence")
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    for pattern, to in STEPS:
        text = F.regexp_replace(text, pattern, to)
    # the first words decide for nearly all texts that they hold no known sentence
    starts = "|".join(sorted({_wrapped(" ".join(s.split()[:2]), "\n") for s in sentences}))
    out = docs.withColumn(plain, F.trim(text))
    ids = F.col(plain)
    for sentence, name in sorted(sentences.items(), key=lambda x: (-len(x[0]), x)):
        ids = F.regexp_replace(ids, rf"(?<![^\n\f]){_wrapped(sentence, chr(10))}(?![^\n\f])", name)
    # what is left in lower case is unknown
    ids = F.regexp_replace(F.regexp_replace(ids, r"[a-z0-9\x20]+", "/"), r"[\n\f]+", " ")
    ids = F.when(F.col(plain).rlike(rf"(?:^|[\n\f])(?:{starts})"), F.regexp_replace(ids, r"/(?:\x20/)+", "/")).otherwise(F.lit(""))
    out = out.withColumn(ids_of, ids).withColumn(sequence, F.expr(f"trim(BOTH ' /' FROM `{ids_of}`)"))
    # identifiers stand between two spaces each, so that runs that follow each other are found both
    left, found, steps = F.when(F.col(sequence) == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(F.col(sequence), F.lit(" "), F.lit("  ")), F.lit(" "))), [], []
    for i, (_, run) in enumerate(rules):
        name = helper(docs, f"left{i}")
        out = out.withColumn(f"{name}", left)
        steps.append(name)
        left = F.when(F.col(name) == "", F.lit("")).otherwise(F.replace(F.col(name), F.lit(f" {run.replace(' ', '  ')} "), F.lit(" | ")))
        found.append(F.when(left != F.col(name), F.lit(rules[i][0])))
    named = F.array_join(F.array_distinct(F.array_compact(F.array(*found))), ",")
    own = [c for c in docs.columns if c not in ("text", "sequence", "licences", "n_known")]
    known = F.size(F.filter(F.split(F.col(sequence), " "), lambda x: (x != "/") & (x != ""))).cast("int")
    return out.select(*(F.col(f"`{c}`") for c in own), known.alias("n_known"), F.col(sequence).alias("sequence"), named.alias("licences"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    quoted = lambda s: s.replace("\n", "' || chr(10) || '").replace("\f", "' || chr(12) || '")
    text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    for pattern, to in STEPS:
        text = f"regexp_replace({text}, '{pattern}', '{quoted(to)}', 'g')"
    # without looking around: every end is doubled, so that neighbours have one each, and a match takes one on either side
    ids = f"chr(12) || regexp_replace(trim({text}), '([\\n\\f])', '\\1\\1', 'g') || chr(12)"
    for sentence, name in sorted(SENTENCES.items(), key=lambda x: (-len(x[0]), x)):
        ids = f"regexp_replace({ids}, '([\\n\\f]){_wrapped(sentence, r'\n\n')}([\\n\\f])', '\\1{name}\\2', 'g')"
    ids = f"regexp_replace(regexp_replace(regexp_replace({ids}, '[a-z0-9 ]+', '/', 'g'), '[\\n\\f]+', ' ', 'g'), '/( /)+', '/', 'g')"
    left, steps, found, last = "CASE WHEN sequence = '' THEN '' ELSE ' ' || replace(sequence, ' ', '  ') || ' ' END", [], [], "q"
    for k, (name, run) in enumerate(RULES):
        steps.append(f"q{k} AS (SELECT *, {left} AS left{k} FROM {last})")
        left, last = f"replace(left{k}, ' {run.replace(' ', '  ')} ', ' | ')", f"q{k}"
        found.append(f"CASE WHEN {left} <> left{k} THEN '{name}' END")
    return f"""
WITH q AS (SELECT doc_id, trim({ids}, ' /') AS sequence FROM documents),
{", ".join(steps)}
SELECT doc_id, len(list_filter(string_split(sequence, ' '), lambda x: x <> '/' AND x <> ''))::INT AS n_known, sequence,
  array_to_string(list_filter(names, lambda x, j: x IS NOT NULL AND list_position(names, x) = j), ',') AS licences
FROM (SELECT doc_id, sequence, [{", ".join(found)}] AS names FROM {last})
"""


OP8_SQL = _sql()
