"""Licence scans by sentence rules, in DataFrame and SQL functions only.

A text is normalised to words with marks where a line or sentence ends, known
licence sentences between two marks are mapped to their identifiers, and the
text's identifier sequence is matched against ordered licence rules: a rule
fires where its identifiers follow each other; identifiers that a rule has used
are not used again by a later one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Sentences of public licence texts and notices, normalised
# (lower case, runs of other characters than a-z and 0-9 as one space).
SENTENCES: dict[str, str] = {
    "apache2-notice": "licensed under the apache license version 2 0",
    "apache2-header": "licensed under the apache license version 2 0 the license",
    "apache2-use": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache2-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-asis": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "ccbync4-notice": "licensed under cc by nc 4 0",
    "ccby4-notice": "licensed under cc by 4 0",
    "ccbysa4-notice": "licensed under cc by sa 4 0",
    "ccby4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccbync4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl2-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
# Fixed values: (licence, identifiers in their order); longer rules first.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache2-header", "apache2-use", "apache2-copy", "apache2-asis", "apache2-see")),
    ("MIT", ("mit-grant", "mit-keep", "mit-asis")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-asis", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-asis", "gpl-see", "gpl-copy")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache2-header",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", ("ccbync4-notice",)),
    ("CC-BY-NC-4.0", ("ccbync4-long",)),
    ("CC-BY-4.0", ("ccby4-notice",)),
    ("CC-BY-4.0", ("ccby4-long",)),
    ("CC-BY-SA-4.0", ("ccbysa4-notice",)),
    ("CC-BY-SA-4.0", ("ccbysa4-long",)),
    ("BSD", ("bsd-grant",)),
    ("MPL-2.0", ("mpl2-terms",)),
]
#: Every known sentence holds one of these, so texts without them are done.
TRIGGER = "(?i)license|permission|warrant|redistribut|licensed"
#: Words after which the printed notice holds a stop inside the sentence ("free software: you", "v. 2.0").
STOPS: dict[str, tuple[str, ...]] = {
    "gpl-free": ("free software", "software foundation"), "gpl2-free": ("free software", "software foundation"),
    "gpl-asis": ("any warranty",), "mpl2-terms": ("license v",),
}
#: Comment marks at a line's start that would read as a stop or a word; other marks are dropped as any sign is.
MARKS = (r"\n[ \t]*(?:[.!?;:]+|dnl|@?[Rr][Ee][Mm])(?=[ \t\r\n])", "\n#")
#: A line that goes on in lower case continues its sentence; both steps use explicit classes.
WRAPPED = (r"\n[ \t\r]*([a-z])", " $1")
#: In place of a line's end (a sentence may end or go on there) and of a stop (it ends, but for STOPS).
LINE, STOP = "\x01", "\x02"
ENDS = (r"[.!?;:][ \t\r\n]+", STOP)
#: The address ends its sentence without a stop, also on one line.
ADDRESS = (r"((?i:apache\.org/licenses/license-2\.0))[ \t\r\n]+([A-Z])", f"$1{STOP}$2")

assert all(any(t in s for t in ("license", "permission", "warrant", "redistribut")) for s in SENTENCES.values())


def marked(text: Column) -> Column:
    """A text's words between single spaces, ``LINE`` or ``STOP`` marks; it begins and ends with a mark."""
    steps = (ADDRESS, MARKS, WRAPPED, ENDS)
    cut = F.concat(F.lit(STOP + "\n"), F.translate(text, LINE + STOP, "##"), F.lit(STOP))
    cut = F.lower(reduce(lambda t, step: F.regexp_replace(t, *step), steps, cut))
    cut = F.translate(cut, "\n", LINE)
    # each run between two words is looked at once, from its start
    cut = F.regexp_replace(cut, f"(?<![^a-z0-9])[^a-z0-9{STOP}]*{STOP}[^a-z0-9]*", STOP)
    cut = F.regexp_replace(cut, f"(?<![^a-z0-9])[^a-z0-9{LINE}{STOP}]*{LINE}[^a-z0-9{STOP}]*", LINE)
    return F.regexp_replace(cut, f"[^a-z0-9{LINE}{STOP}]+", " ")


def _pattern(key: str) -> str:
    """A known sentence in a marked text: lines may end between any two words, stops only at its own."""
    words = SENTENCES[key].split(" ")
    out = words[0]
    for k in range(1, len(words)):
        stop = " ".join(words[max(0, k - 2):k]) in STOPS.get(key, ())
        out += f"[ {LINE}{STOP if stop else ''}]{words[k]}"
    return out


#: Longer sentences first, so that none hides one that goes on.
KNOWN = f"[{LINE}{STOP}]({'|'.join(_pattern(k) for k in sorted(SENTENCES, key=lambda k: -len(SENTENCES[k])))})(?=[{LINE}{STOP}])"


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in their order.

    A known sentence begins and ends at a line's end or a stop, and may be
    wrapped or commented between any two of its words.
    """
    known = F.create_map(*(F.lit(x) for key, s in SENTENCES.items() for x in (s, key)))
    ids = F.transform(F.regexp_extract_all(marked(text), F.lit(KNOWN), F.lit(1)),
                      lambda s: known[F.translate(s, LINE + STOP, "  ")])
    return F.when(text.rlike(TRIGGER), ids).otherwise(F.array().cast("array<string>"))


def licences(ids: Column) -> Column:
    """Licences whose rules match the identifier sequence, sorted, each once."""
    def use(state: Column, rule: tuple[str, tuple[str, ...]]) -> Column:
        name, seq = rule
        key = "".join(f"<{s}>" for s in seq)
        return let(state, lambda s: F.when(F.contains(s["rest"], F.lit(key)), F.struct(
            F.replace(s["rest"], F.lit(key), F.lit("|")).alias("rest"),
            F.concat(s["found"], F.array(F.lit(name))).alias("found"))).otherwise(s))

    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("rest"),
                     F.array().cast("array<string>").alias("found"))
    return F.when(F.size(ids) == 0, F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(reduce(use, RULES, start)["found"])))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentence_ids, licences) of every row, empty lists where nothing is known.

    Row by row and without a shuffle: a hot source or copies cost nothing
    extra. Null and empty texts have no sentences; repeated rows each give a row.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), identifiers(F.coalesce(F.col(text_col), F.lit(""))).alias("sentence_ids"))
    return found.withColumn("licences", licences(F.col("sentence_ids")))


def licence_query(docs: DataFrame) -> DataFrame:
    """One row per document: number of known sentences, their identifiers and the licences as text."""
    return scan_licences(docs).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_known"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def licence_sql() -> str:
    """The same in DuckDB, but for known sentences that hold a stop or are wrapped before other than lower case: it cuts those."""
    rows = ", ".join(f"('{s}', '{k}')" for k, s in SENTENCES.items())
    state, found = "seq", []
    steps = []
    for i, (name, seq) in enumerate(RULES):
        key = "".join(f"<{s}>" for s in seq)
        steps.append(f"s{i + 1} AS (SELECT doc_id, replace(rest, '{key}', '|') AS rest, CASE WHEN contains(rest, '{key}') "
                     f"THEN list_append(found, '{name}') ELSE found END AS found, n_known, ids FROM s{i})")
    del state, found
    return f"""
WITH known(sentence, id) AS (VALUES {rows}),
cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''),
    '[ \\t\\r]*\\n[ \\t\\r]*([a-z])', ' \\1', 'g'), '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)) AS parts
  FROM documents),
one AS (SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS part FROM cut),
hit AS (SELECT doc_id, place, id FROM (SELECT doc_id, place,
    trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM one) JOIN known USING (sentence)),
s0 AS (SELECT d.doc_id, coalesce(string_agg('<' || id || '>', '' ORDER BY place), '') AS rest, CAST([] AS VARCHAR[]) AS found,
    count(id) AS n_known, coalesce(string_agg(id, ',' ORDER BY place), '') AS ids
  FROM documents d LEFT JOIN hit USING (doc_id) GROUP BY d.doc_id),
{", ".join(steps)}
SELECT doc_id, n_known, ids AS sentence_ids, array_to_string(list_sort(list_distinct(found)), ',') AS licences FROM s{len(RULES)}
"""
