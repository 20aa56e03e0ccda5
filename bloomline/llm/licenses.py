"""Licence recognition: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The sentences that are recognised, in normalised form, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache2",
    "licensed under the apache license version 2.0 the license": "apache2",
    "you may not use this file except in compliance with the license": "apache2use",
    "you may obtain a copy of the license at": "apache2copy",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mitgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitnotice",
    "the software is provided as is without warranty of any kind express or implied": "aswarranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdname",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3later",
    "licensed under cc by-nc 4.0": "ccbync4",
    "licensed under cc by-sa 4.0": "ccbysa4",
    "licensed under cc by 4.0": "ccby4",
    "this work is licensed under a creative commons attribution 4.0 international license": "ccby4",
    "all rights reserved": "reserved",
}

# Sentences of the standard texts that go on where a short form above ends, or join several of them.
STANDARD = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": ("mitgrant",),
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": ("aswarranty",),
    "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license": ("apache2", "apache2use"),
    "you may obtain a copy of the license at http www.apache.org licenses license-2.0": ("apache2copy",),
    "you may obtain a copy of the license at https www.apache.org licenses license-2.0": ("apache2copy",),
}

# Ordered rules (licence, sequence of identifiers, may the text be used); longer sequences first.
RULES = [
    ("BSD-3-Clause", ("bsdgrant", "bsdsource", "bsdbinary", "bsdname"), True),
    ("BSD-2-Clause", ("bsdgrant", "bsdsource", "bsdbinary"), True),
    ("MIT", ("mitgrant", "mitnotice", "aswarranty"), True),
    ("Apache-2.0", ("apache2", "apache2use", "apache2copy"), True),
    ("Apache-2.0", ("apache2",), True),
    ("MIT", ("mit",), True),
    ("GPL-3.0-or-later", ("gpl3later",), False),
    ("GPL-3.0", ("gpl3",), False),
    ("CC-BY-NC-4.0", ("ccbync4",), False),
    ("CC-BY-SA-4.0", ("ccbysa4",), False),
    ("CC-BY-4.0", ("ccby4",), True),
    ("All-rights-reserved", ("reserved",), False),
]

#: Each known sentence holds one of these; a text without any is not split.
CLUES = "licens|permission|warranty|redistribut|reserved"

#: A sentence ends at . ! or ? before white space, and at a line end.
SENTENCE_END = r"([.!?])[\x20\x09-\x0D]+"
NOISE, EDGES = "[^a-z0-9.-]+", "^[ .]+|[ .]+$"


#: Where lines don't go on, besides sentence ends: after a copyright line or a colon, before a line without words or a list item.
COPYRIGHT_LINE = r"(?m)^([\x20\t\r#/*;%!-]*(?:copyright|\(c\))[^\n]*)\n"
COLON_LINE = r"(?<!free software)(:[\x20\t\r]*)\n"
NEXT_LINE = r"\n(?=[\x20\t\r]*(?:<!)?[#/*;%!>-]*[\x20\t\r]*(?:\n|[0-9]{1,2}[.)][\x20\t]|\([0-9a-z]\)[\x20\t]))"
#: Markers that are not noise: dashes that open or close a comment, and the number of a list item.
MARKERS = r"(?m)^[\x20\t\r]*(?:<!)?--+|--+>|\A[\x20\t\r\n#/*;%!-]*(?:\(?[0-9a-z]{1,2}\)[\x20\t]|-+[\x20\t])"


def normalised(sentence: Column) -> Column:
    """Runs of other characters than a-z, 0-9, dot and hyphen made a blank, edges cut."""
    return F.regexp_replace(F.regexp_replace(sentence, NOISE, " "), EDGES, "")


def sentence_ids(text: str | Column, known: Column) -> Column:
    """Identifiers of the known sentences of a text, A-Z lower-cased, in order.

    A sentence may be wrapped over lines, with comment markers before each. If
    its joined lines are not known as a whole, each line counts for itself.
    """
    # No A is left in the lower-cased text: it marks where lines don't go on.
    ends = F.translate(text, UPPER, LOWER)
    for pattern, by in ((COPYRIGHT_LINE, "$1A"), (SENTENCE_END, "$1A"), (COLON_LINE, "$1A"), (NEXT_LINE, "A")):
        ends = F.regexp_replace(ends, pattern, by)
    none = F.array().cast("array<string>")
    lines = lambda s: F.flatten(F.transform(F.split(s, "\n"), lambda x: F.coalesce(F.try_element_at(known, normalised(x)), none)))
    whole = lambda s: F.try_element_at(known, normalised(F.regexp_replace(s, MARKERS, " ")))
    return F.flatten(F.transform(F.split(ends, "A"), lambda s: F.coalesce(whole(s), lines(s))))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, str] | None = None,
                  rules: list[tuple[str, tuple[str, ...], bool]] | None = None) -> DataFrame:
    """Licences stated in every text: ``key``, sentence_ids, licenses, n_unmatched, usable.

    Known sentences, also those wrapped over lines or set in comments, become
    identifiers in text order (comma-joined). Rules are
    tried in their order; one whose sequence of neighbouring identifiers occurs
    adds its licence (once, comma-joined in rule order) and uses up every such
    occurrence. ``n_unmatched`` counts identifiers that no rule used; ``usable``
    is false if a matched rule forbids use. Null and empty texts state nothing
    and are usable. Rows are judged each; an empty table gives no rows; other
    columns are ignored. A narrow stage of built-in functions.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    values = {s: (i,) for s, i in sentences.items()} | (STANDARD if sentences is SENTENCES else {})
    known = F.create_map(*[x for s, found in values.items() for x in (F.lit(s), F.array(*[F.lit(i) for i in found]))])
    ids = sentence_ids("text", known)
    none = F.array().cast("array<string>")
    clue = F.coalesce(F.col("text").rlike(f"(?i){CLUES}"), F.lit(False)) if sentences is SENTENCES else F.col("text").isNotNull()
    found = (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
             .select("key", F.when(clue, ids).otherwise(none).alias("ids")))
    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in sequence)).alias("sequence"),
                                F.lit(may).alias("may")) for name, sequence, may in rules])
    state = lambda rest, names, may: F.struct(rest.alias("rest"), names.alias("names"), may.alias("may"))
    start = state(F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""), none, F.lit(True))
    matched = F.aggregate(listed, start, lambda acc, r: F.when(
        F.contains(acc["rest"], r["sequence"]),
        state(F.replace(acc["rest"], r["sequence"], F.lit("|")), F.array_append(acc["names"], r["name"]), acc["may"] & r["may"])
    ).otherwise(acc))
    found = found.withColumn("m", F.when(F.size("ids") > 0, matched))
    rest = F.coalesce("m.rest", F.lit(""))
    return found.select(
        F.col("key").alias(key), F.array_join("ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct("m.names"), ","), F.lit("")).alias("licenses"),
        (F.length(rest) - F.length(F.replace(rest, F.lit("<"), F.lit("")))).cast("long").alias("n_unmatched"),
        F.coalesce("m.may", F.lit(True)).alias("usable"))


def oracle() -> str:
    """The same in DuckDB's SQL over ``documents`` for sentences on one line, without ``STANDARD``; each rule is a stage of its own."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in SENTENCES.items())
    stages, last = [], "seq"
    for n, (_, sequence, _) in enumerate(RULES):
        key = quote("".join(f"<{i}>" for i in sequence))
        stages.append(f"r{n} AS (SELECT *, contains(rest, {key}) AS hit{n} FROM {last}),\n"
                      f"s{n} AS (SELECT * REPLACE (replace(rest, {key}, '|') AS rest) FROM r{n})")
        last = f"s{n}"
    names = ", ".join(f"CASE WHEN hit{n} THEN {quote(name)} END" for n, (name, _, _) in enumerate(RULES))
    # The first mention of a licence keeps its place.
    unique = f"list_filter([{names}], lambda x, i: x IS NOT NULL AND list_position([{names}], x) = i)"
    may = " AND ".join(["true"] + [f"NOT hit{n}" for n, (_, _, use) in enumerate(RULES) if not use])
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (SELECT row_number() OVER () AS r, doc_id,
  string_split(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10)) AS parts
  FROM documents),
lines AS (SELECT r, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM cut),
found AS (SELECT r, string_agg(id, ',' ORDER BY i) AS sentence_ids, string_agg('<' || id || '>', '' ORDER BY i) AS rest
  FROM lines JOIN known ON regexp_replace(regexp_replace(s, '{NOISE}', ' ', 'g'), '{EDGES}', '', 'g') = sentence GROUP BY r),
seq AS (SELECT doc_id, coalesce(sentence_ids, '') AS sentence_ids, coalesce(rest, '') AS rest FROM cut LEFT JOIN found USING (r)),
{(',' + chr(10)).join(stages)}
SELECT doc_id, sentence_ids, coalesce(array_to_string({unique}, ','), '') AS licenses,
  CAST(length(rest) - length(replace(rest, '<', '')) AS BIGINT) AS n_unmatched, {may} AS usable
FROM {last}"""
