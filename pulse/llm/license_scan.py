"""Licence recognition from sequences of known licence sentences.

A text is cut into sentences (after . ! ? or ; followed by white space, and
at line ends), every sentence is normalised (lower case, letters and digits
only, single spaces) and looked up in a table of known licence sentences.
The identifiers found, in text order, form the text's sequence; unknown
sentences leave no mark.  Licence rules are ordered: each names an identifier
sequence, and the first rule that occurs in what earlier rules have left
takes its identifiers.  Longer and more specific rules come first, so a
sentence that belongs to a full notice is not reported again as a reference.

Line ends inside a sentence are handled by a second reading in which a single
line end is a space; both readings are matched and their licences united.
Comment marks at line starts are taken off first, so a notice reads alike in a
source file and in plain text and a bare comment line is a blank one.

``SPDX-License-Identifier:`` tags leave the mark ``spdx`` in the sequence; the
licences of their expressions are reported beside those of the rules (what
follows ``WITH`` is an exception, not a licence).

Null and blank texts have no sentences and no licence; repeated rows are
scanned alike; an empty table gives an empty result; other columns are not
read.  The sentence and rule tables are constants of a fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import let

# --- fixed values: public licence notices, normalised -------------------------------------------------
SENTENCES: dict[str, str] = {
    "apache-ref": "licensed under the apache license version 2 0",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license "
                    "is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-ref": "released under the mit license",
    "mit-ref-licensed": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-the-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
                 "of the software and to permit persons to whom the software is furnished to do so subject to the "
                 "following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited "
                 "to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl3-program-ref": "this program is licensed under the gnu general public license version 3",
    "gpl2-ref": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license or at your "
                "option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 2 of the license or at your "
                 "option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the "
                "implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl-ref": "licensed under the gnu lesser general public license version 3",
    "agpl-ref": "licensed under the gnu affero general public license version 3",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided "
                 "that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                  "the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission",
    "bsd-ref": "licensed under the bsd license",
    "mpl-ref": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-ref": "licensed under cc by 4 0",
    "cc-by-sa-ref": "licensed under cc by sa 4 0",
    "cc-by-nc-ref": "licensed under cc by nc 4 0",
    "cc-by-nd-ref": "licensed under cc by nd 4 0",
    "cc-by-nc-sa-ref": "licensed under cc by nc sa 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
           "this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights": "all rights reserved",
}

#: Ordered: the first rule that matches takes its sentences.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-ref", "apache-may-not", "apache-obtain", "apache-as-is", "apache-see")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-ref",)),
    ("Apache-2.0", ("apache-obtain",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-ref-licensed",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-the-title",)),
    ("GPL-3.0-only", ("gpl3-ref",)),
    ("GPL-3.0-only", ("gpl3-program-ref",)),
    ("GPL-2.0-only", ("gpl2-ref",)),
    ("LGPL-3.0-only", ("lgpl-ref",)),
    ("AGPL-3.0-only", ("agpl-ref",)),
    ("BSD", ("bsd-ref",)),
    ("MPL-2.0", ("mpl-ref",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("All-Rights-Reserved", ("all-rights",)),
]

#: Sentences of the official notices as they split at their own ; and blank lines, with their identifiers.
NOTICES: dict[str, str] = {
    "licensed under the apache license version 2 0 the license": "apache-ref-the",
    "you may obtain a copy of the license at": "apache-obtain-at",
    "http www apache org licenses license 2 0": "apache-url",
    "https www apache org licenses license 2 0": "apache-url",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache-obtain",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
    "software foundation": "gpl-modify",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by "
    "the free software foundation": "gpl2-modify",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
    "free software foundation": "lgpl-modify",
    "either version 2 of the license or at your option any later version": "either-2",
    "either version 2 1 of the license or at your option any later version": "either-2-1",
    "either version 3 of the license or at your option any later version": "either-3",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope-but",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl-hope-but",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-even",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
    "public license as published by the free software foundation either version 3 of the license or at your option any "
    "later version": "agpl-free",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met 1": "bsd-grant",
}

#: Rules over them, before the others.
NOTICE_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-ref-the", "apache-may-not", "apache-obtain-at", "apache-url", "apache-as-is", "apache-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope-but", "gpl-even", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-modify", "either-2", "gpl-hope-but", "gpl-even", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-modify", "either-2")),
    ("GPL-3.0-or-later", ("gpl-modify", "either-3")),
    ("LGPL-2.1-or-later", ("lgpl-modify", "either-2-1")),
    ("LGPL-3.0-or-later", ("lgpl-modify", "either-3")),
    ("GPL-2.0-only", ("gpl2-modify",)),
    ("AGPL-3.0-or-later", ("agpl-free",)),
    ("Apache-2.0", ("apache-obtain-at", "apache-url")),
]

#: Every known sentence has one of these; texts with none are not cut up.
TRIGGERS = ("licens", "redistribut", "rights", "warrant", "copyright", "permission", "as is", "public domain")
# -------------------------------------------------------------------------------------------------------

#: Two readings of the same text: line ends end a sentence, or only blank lines do.  "v. 2.0" does not end one.
ENDS = (r"(?<=[.!?;])(?<!\b[vV]\.)[\x20\x09-\x0D]+|\n", r"(?<=[.!?;])(?<!\b[vV]\.)[\x20\x09-\x0D]+|\n[\x20\t]*\n")

#: Comment marks at the start of a line.
MARKS = r"(?md)^[\x20\t]*(?:(?:<!-+|\(\*+|\{-+|\.\\\"|[#*;!%/'\"|>~-]+|@?(?:rem|REM|dnl)(?![^\x20\t\r\n]))[\x20\t]*)+"

SPDX_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.:-]*[A-Za-z0-9])?\+?"
SPDX_TAG = (rf"(?i:SPDX-License-Identifier):[\x20\t]*(\(*{SPDX_ID}\)*"
            rf"(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+\(*{SPDX_ID}\)*)*)")
SPDX_NONE = ("AND", "OR", "NONE", "NOASSERTION")
#: Older identifiers, in lower case, and what they are called now.
SPDX_OLD = {f"{n}{old}".lower(): f"{n}{new}" for n in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
                                                       "AGPL-1.0", "AGPL-3.0")
            for old, new in (("", "-only"), ("+", "-or-later"))}
#: Identifiers are compared without case; the rules' licences keep their spelling.
SPDX_NAMES = SPDX_OLD | {x.lower(): x for x in [*SPDX_OLD.values(), *(n for n, _ in [*NOTICE_RULES, *RULES])]}


def _normal(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def _triggered(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.translate(low, "\t\n\x0b\x0c\r-_\"'", "         ")
    hit = F.lit(False)
    for word in TRIGGERS:
        hit = hit | F.contains(spaced if " " in word else low, F.lit(word))
    return hit


def _bare(text: Column) -> Column:
    """The text without comment marks at line starts, lines ended by \\n."""
    return F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), MARKS, "")


def _sequence(text: Column, ends: str) -> Column:
    """Identifiers of the known sentences in text order, each as ``<id>``."""
    ids = {s: i for i, s in SENTENCES.items()} | NOTICES
    known = F.create_map(*[x for s, i in ids.items() for x in (F.lit(s), F.lit(f"<{i}>"))])
    tag = F.lit("spdx license identifier ")
    found = F.transform(F.split(text, ends, -1), lambda s: let(_normal(s), lambda n: F.coalesce(
        F.element_at(known, n), F.when(F.contains(n, tag), F.lit("<spdx>")))))
    return F.array_join(F.filter(found, lambda x: x.isNotNull()), "")


def _tagged(text: Column) -> Column:
    """Licences of the SPDX tags."""
    names = F.create_map(*[F.lit(x) for pair in SPDX_NAMES.items() for x in pair])
    expressions = F.regexp_extract_all(text, F.lit(SPDX_TAG), F.lit(1))
    ids = F.flatten(F.transform(expressions, lambda e: F.regexp_extract_all(
        F.regexp_replace(e, rf"[\x20\t]WITH[\x20\t]+\(*{SPDX_ID}", ""), F.lit(SPDX_ID), F.lit(0))))
    return F.transform(F.filter(ids, lambda i: ~i.isin(*SPDX_NONE)),
                       lambda i: F.coalesce(F.element_at(names, F.lower(i)), i))


def _apply_rules(sequence: Column) -> tuple[Column, Column]:
    """(licences in rule order, what no rule took)."""
    taken, left = [], sequence
    for licence, ids in [*NOTICE_RULES, *RULES]:
        wanted = "".join(f"<{i}>" for i in ids)
        taken.append(F.when(F.contains(left, F.lit(wanted)), F.lit(licence)))
        left = F.replace(left, F.lit(wanted), F.lit("#"))
    return F.array_compact(F.array(*taken)), left


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, sentences (identifiers of the line reading, comma separated), licenses (sorted)."""
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = read.withColumn("hit", _triggered(F.col("text")))
    marked = marked.withColumn("text", F.when(F.col("hit"), _bare(F.col("text"))))
    for k, ends in enumerate(ENDS):
        marked = marked.withColumn(f"s{k}", F.when(F.col("hit"), _sequence(F.col("text"), ends)).otherwise(F.lit("")))
    tags = F.when(F.contains("s0", F.lit("<spdx>")), _tagged(F.col("text"))).otherwise(F.array().cast("array<string>"))
    found = marked.select("id", "s0", "s1", tags.alias("tags"))
    # only the few texts with a known sentence pay for the rules
    licences = [F.when(F.col(f"s{k}") == "", F.array().cast("array<string>")).otherwise(_apply_rules(F.col(f"s{k}"))[0])
                for k in range(len(ENDS))]
    return found.select(
        "id", F.replace(F.btrim(F.col("s0"), F.lit("<>")), F.lit("><"), F.lit(",")).alias("sentences"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(*licences, "tags"))), ",").alias("licenses"))


def op8_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan_licenses(docs).withColumnRenamed("id", "doc_id")


#: Looks up SENTENCES and RULES only: no comment marks, official notices (NOTICES) or SPDX tags.
def _sql() -> str:
    known = ", ".join(f"('{s}', '<{i}>')" for i, s in SENTENCES.items())
    cut = ("regexp_replace(regexp_replace(text, '([.!?;])[\\x20\\x09-\\x0D]+', '\\1' || chr(1), 'g'), "
           "'{ends}', chr(1), 'g')")
    parts = []
    for k, ends in enumerate((r"\n", r"\n[\x20\t]*\n")):
        seq = (f"s{k} AS (SELECT rid, string_agg(id, '' ORDER BY pos) AS seq FROM "
               f"(SELECT rid, generate_subscripts(ss, 1) AS pos, unnest(ss) AS s FROM "
               f"(SELECT rid, string_split({cut.format(ends=ends)}, chr(1)) AS ss FROM d)) x "
               f"JOIN known ON known.s = trim(regexp_replace(lower(x.s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) GROUP BY rid)")
        ctes = [seq]
        source = f"s{k}"
        for n, (licence, ids) in enumerate(RULES):
            wanted = "".join(f"<{i}>" for i in ids)
            prev = "NULL::VARCHAR[]" if n == 0 else "took"
            ctes.append(f"r{k}_{n} AS (SELECT rid, replace(seq, '{wanted}', '#') AS seq, "
                        f"list_concat(coalesce({prev}, []), CASE WHEN contains(seq, '{wanted}') THEN ['{licence}'] ELSE [] END) AS took "
                        f"FROM {source})")
            source = f"r{k}_{n}"
        parts.append((",\n".join(ctes), source))
    return (f"WITH known(s, id) AS (VALUES {known}), d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),\n"
            + ",\n".join(c for c, _ in parts)
            + f"\nSELECT d.doc_id, coalesce(replace(trim(s0.seq, '<>'), '><', ','), '') AS sentences, "
              f"coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(a.took, []), coalesce(b.took, [])))), ','), '') AS licenses "
              f"FROM d LEFT JOIN s0 USING (rid) LEFT JOIN {parts[0][1]} a USING (rid) LEFT JOIN {parts[1][1]} b USING (rid)")


OP8_SQL = _sql()
