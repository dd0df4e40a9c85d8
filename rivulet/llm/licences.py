"""Licence recognition by sentences and ordered rules, with DataFrame functions only.

A text is cut into sentences, each is normalised (A-Z in lower case, everything but a-z and 0-9 as one
blank) and looked up among known licence sentences. What is known, in the order of the text, is a
sequence of identifiers; a rule is a sequence of identifiers too, and holds where it occurs in a row,
outside of what a longer rule takes.

In a known sentence ``*`` stands for one to forty words and ``**`` at its end for the rest of the line.

Licence texts are wrapped. Stops and blank lines always end a sentence; a single line end (with the
comment marks beside it) may end one, as after a header, or stand for a blank inside one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The licence sentences, normalised as above. The identifier is the place in the list, from 1.
SENTENCES = [
    "released under the mit license",
    "licensed under the mit license",
    "this project is licensed under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at",
    "this work is licensed under the gnu general public license version 3",
    "this work is licensed under the gnu general public license version 2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under cc by nc 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "this source code form is subject to the terms of the mozilla public license v",
    "neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement **",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "this is free and unencumbered software released into the public domain",
    "to the extent possible under law * has waived all copyright and related or neighboring rights to **",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 **",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 **",
    "this software is provided as is without any express or implied warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
]
# Licence, and the sentence identifiers that state it, in order.
RULES = [
    ("MIT", [1]),
    ("MIT", [2]),
    ("MIT", [3]),
    ("MIT", [4, 5]),
    ("Apache-2.0", [6]),
    ("Apache-2.0", [7, 8, 9]),
    ("GPL-3.0", [10]),
    ("GPL-3.0", [12, 14]),
    ("GPL-2.0", [11]),
    ("GPL-2.0", [13, 14]),
    ("CC-BY-4.0", [15]),
    ("CC-BY-4.0", [18]),
    ("CC-BY-SA-4.0", [16]),
    ("CC-BY-NC-4.0", [17]),
    ("BSD-2-Clause", [19, 20, 21]),
    ("MPL-2.0", [22]),
    ("BSD-3-Clause", [19, 20, 21, 23]),
    ("BSD-4-Clause", [19, 20, 21, 24, 23]),
    ("LGPL-2.1", [25]),
    ("LGPL-3.0", [26]),
    ("AGPL-3.0", [27]),
    ("AGPL-3.0", [27, 14]),
    ("ISC", [28]),
    ("Unlicense", [29]),
    ("CC0-1.0", [30]),
    ("EPL-1.0", [31]),
    ("EPL-2.0", [32]),
    ("Zlib", [33, 34]),
]
# How a licence is named in one sentence, and the names, with the identifiers they stand for.
FORMS = [
    "released under the {} license", "licensed under the {} license", "licensed under the {} license see **",
    "this project is licensed under the {} license", "this project is licensed under the {} license see **",
    "distributed under the {} license",
]
NAMED = {"mit": "MIT", "isc": "ISC", "apache 2 0": "Apache-2.0", "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause",
         "mpl 2 0": "MPL-2.0", "zlib": "Zlib"}
SPDX = {"apache 2 0": "Apache-2.0", "mit": "MIT", "isc": "ISC", "zlib": "Zlib", "unlicense": "Unlicense",
        "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "mpl 2 0": "MPL-2.0", "cc0 1 0": "CC0-1.0",
        "epl 1 0": "EPL-1.0", "epl 2 0": "EPL-2.0", "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0",
        "cc by nc 4 0": "CC-BY-NC-4.0"}
GNU = {"gpl 2 0": "GPL-2.0", "gpl 3 0": "GPL-3.0", "lgpl 2 1": "LGPL-2.1", "lgpl 3 0": "LGPL-3.0", "agpl 3 0": "AGPL-3.0"}
SPDX |= {name + kind: licence for name, licence in GNU.items() for kind in ("", " only", " or later")}


def _add_named() -> None:
    """Appends the sentences that name a licence, with a rule of one sentence each."""
    named = [(form.format(words), licence) for words, licence in NAMED.items() for form in FORMS]
    for sentence, licence in named + [(f"spdx license identifier {w}", licence) for w, licence in SPDX.items()]:
        if sentence not in SENTENCES:
            SENTENCES.append(sentence)
            RULES.append((licence, [len(SENTENCES)]))


_add_named()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def marked(text: Column) -> Column:
    """The normal form of a text, in which H stands for an end of a sentence and S for a single line end.

    It begins and ends with H; no blank stands beside a mark.
    """
    steps = [
        (r"[.?][^a-z0-9\x20\t\r\n]*(?=[\x20\t\r\n])", "H"),
        # a line end before a line without letters and digits
        (r"(?>\r\n|[\r\n])[^a-z0-9\r\nH]*(?=[\r\n])", "H"),
        (r"[\r\n]", "S"),
        (r"[^a-z0-9HS]+", " "),
        (r"(?<![\x20S])[\x20S]*+H[\x20HS]*+", "H"),
        (r"\x20?S[\x20S]*+", "S"),
    ]
    out = F.concat(F.lit("H"), F.translate(text, _UPPER, _LOWER), F.lit("H"))
    for pattern, mark in steps:
        out = F.regexp_replace(out, pattern, mark)
    return out


def _levels(sentences: list[str]) -> list[list[str]]:
    """The sentences by how many others they begin with: of one level at most one stands at a place."""
    depth = {s: sum(s.startswith(o + " ") for o in set(sentences)) for s in sentences}
    return [[s for s in depth if depth[s] == level] for level in range(max(depth.values(), default=-1) + 1)]


def _pattern(sentence: str) -> str:
    """A sentence as a pattern over marked text, where blanks may be single line ends."""
    words = sentence.split(" ")
    rest = words[-1] == "**"
    blank = "[\\x20S]"
    spelled = [f"[a-z0-9]+(?:{blank}[a-z0-9]+){{0,39}}?" if w == "*" else w for w in words[: len(words) - rest]]
    return blank.join(spelled) + ("(?:\\x20[a-z0-9\\x20]*)?" if rest else "")


def _any_of(sentences: list[str]) -> str:
    """One alternative per first word, so that a place is compared with few sentences."""
    heads: dict[str, list[str]] = {}
    for sentence in sentences:
        head, _, tail = sentence.partition(" ")
        heads.setdefault(head, []).append(tail)
    parts = []
    for head, tails in heads.items():
        more = "|".join(_pattern(tail) for tail in tails if tail)
        after = f"[\\x20S](?:{more})" if more else ""
        parts.append(head + (f"(?:{after})?" if after and "" in tails else after))
    return "|".join(parts)


def hint(sentences: list[str]) -> str:
    """A pattern that every text with one of the sentences matches: of each sentence its longest word."""
    words: set[str] = set()
    for sentence in sorted(sentences, key=lambda s: len(s.split())):
        own = [w for w in sentence.split(" ") if "*" not in w]
        if not words.intersection(own):
            words.add(max(own, key=len))
    return "(?i)" + "|".join(sorted(words))


#: The hint of the sentences above; other texts are not cut up.
HINT = hint(SENTENCES)


def sentence_ids(text: Column, sentences: list[str]) -> Column:
    """The identifiers of the known sentences of a text, in the order of their starts; where two start
    together the shorter is first."""
    levels = _levels(sentences)
    if not levels:
        return F.array().cast("array<int>")
    # one match, of no length, at every start of a sentence or line; a group for each level
    starts = F.lit("(?<=[HS])" + "".join(f"(?=(?:({_any_of(level)})[HS])?+)" for level in levels))
    whole = marked(text)
    found = F.arrays_zip(*[F.regexp_extract_all(whole, starts, F.lit(i + 1)).alias(f"_{i}") for i in range(len(levels))])
    parts = F.when(F.rlike(text, F.lit(hint(sentences))), F.flatten(F.transform(
        found, lambda start: F.array(*[start[f"_{i}"] for i in range(len(levels))])
    ))).otherwise(F.array().cast("array<string>"))
    parts = F.filter(parts, lambda part: part != "")
    known = F.array(*map(F.lit, sentences))
    loose = [(at, _pattern(s)) for at, s in enumerate(sentences, 1) if "*" in s]

    def place(part: Column) -> Column:
        exact = F.array_position(known, F.translate(part, "S", " ")).cast("int")
        if not loose:
            return exact
        matched = F.coalesce(*[F.when(F.rlike(part, F.lit(f"^(?:{pattern})$")), F.lit(at)) for at, pattern in loose], F.lit(0))
        return F.when(exact > 0, exact).otherwise(matched)

    return F.filter(F.transform(parts, place), lambda at: at > 0)


def _ordered(rules: list[tuple[str, list[int]]]) -> list[list[tuple[str, str, bool]]]:
    """Licence, spelled sequence, and whether a shorter rule lies in it; in groups of equal length, the longest first."""
    spelled = [(name, "".join(f"<{at}>" for at in rule), len(rule)) for name, rule in rules]
    groups = []
    for length in sorted({n for *_, n in spelled}, reverse=True):
        groups.append([
            (name, spelt, any(other in spelt for _, other, m in spelled if m < length))
            for name, spelt, n in spelled if n == length
        ])
    return groups


def scan_licences(docs: DataFrame, id: str = "doc_id", text: str = "text", sentences: list[str] = SENTENCES,
                  rules: list[tuple[str, list[int]]] = RULES) -> DataFrame:
    """``id, n_sentences, sentence_ids, licences`` per row.

    ``sentence_ids`` and ``licences`` are joined by commas; licences are distinct and sorted. Sentences of no
    licence between the known ones do not break a rule. Sentences may be wrapped. Null and empty texts have none, repeated rows
    equal results, other columns are not passed on.
    """
    found = docs.select(F.col(id).alias("_id"), sentence_ids(F.coalesce(F.col(text), F.lit("")), sentences).alias("_ids"))
    joined = found.withColumn("_joined", F.array_join("_ids", ","))
    spelled = F.transform("_ids", lambda at: F.concat(F.lit("<"), at.cast("string"), F.lit(">")))
    joined, hits = joined.withColumn("_left", F.array_join(spelled, "")), []
    for step, group in enumerate(_ordered(rules)):
        found_here = [F.when(F.contains(F.col("_left"), F.lit(spelt)), F.lit(name)) for name, spelt, _ in group]
        joined = joined.withColumn(f"_hits{step}", F.array(*found_here))
        hits.append(F.col(f"_hits{step}"))
        for _, spelt, holds_others in group:
            if holds_others:
                joined = joined.withColumn("_left", F.replace("_left", F.lit(spelt), F.lit("<0>")))
    none = F.array().cast("array<string>")
    licences = F.array_join(F.sort_array(F.array_distinct(F.array_compact(F.concat(none, *hits)))), ",")
    return joined.select(
        F.col("_id").alias(id),
        F.size("_ids").cast("long").alias("n_sentences"),
        F.col("_joined").alias("sentence_ids"),
        licences.alias("licences"),
    )


def sql() -> str:
    """The same over the table ``documents``, for DuckDB: runs of lines that begin at a line or a sentence are looked up."""
    def quoted(values: list[str]) -> str:
        return ", ".join(f"'{value}'" for value in values)

    exact = [s for s in SENTENCES if "*" not in s]
    exact_ids = [SENTENCES.index(s) + 1 for s in exact]
    plain = {s: _pattern(s).replace("\\x20", " ") for s in SENTENCES}
    loose = " ".join(f"WHEN regexp_full_match(run, '{plain[s]}') THEN {at}" for at, s in enumerate(SENTENCES, 1) if "*" in s)
    any_of = "|".join(plain[s] for s in SENTENCES if "*" in s)
    longest = max(len(s.split()) for s in SENTENCES) + 80
    steps, columns, last = [], [], "spelt"
    for step, group in enumerate(_ordered(RULES)):
        hits = ", ".join(f"CASE WHEN contains(rest, '{spelt}') THEN '{name}' END" for name, spelt, _ in group)
        rest = "rest"
        for _, spelt, holds_others in group:
            rest = f"replace({rest}, '{spelt}', '<0>')" if holds_others else rest
        steps.append(f"rules{step} AS (SELECT * REPLACE ({rest} AS rest), [{hits}] AS hits{step} FROM {last})")
        columns, last = [*columns, f"hits{step}"], f"rules{step}"
    return rf"""WITH low AS (
  SELECT doc_id, 'H' || translate(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
    '{_UPPER}', '{_LOWER}') || 'H' AS t FROM documents WHERE regexp_matches(text, '{HINT}')),
ends AS (SELECT doc_id, regexp_replace(t, '[.?][^a-z0-9 \t\n]*([ \t\n])', 'H\1', 'g') AS t FROM low),
gaps AS (SELECT doc_id, replace(regexp_replace(t, '\n([^a-z0-9\nH]*\n)+', 'H', 'g'), chr(10), 'S') AS t FROM ends),
normal AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[^a-z0-9HS]+', ' ', 'g'),
  '[ S]*H[ HS]*', 'H', 'g'), ' ?S[ S]*', 'S', 'g') AS t FROM gaps),
cut AS (SELECT doc_id, string_split(t, 'H') AS stretches FROM normal),
stretch AS (SELECT doc_id, unnest(stretches) AS s, unnest(range(len(stretches))) AS part FROM cut),
lines AS (SELECT doc_id, part, string_split(s, 'S') AS l FROM stretch WHERE regexp_matches(s, '{HINT}')),
opens AS (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM lines),
runs AS (SELECT doc_id, part, i, unnest(range(i, least(len(l), i + {longest}) + 1)) AS j, l FROM opens),
spelled AS (SELECT doc_id, part, i, j, array_to_string(l[i:j], 'S') AS run FROM runs),
known AS (
  SELECT doc_id, part, i, j, coalesce([{', '.join(map(str, exact_ids))}][nullif(coalesce(
    list_position([{quoted(exact)}], replace(run, 'S', ' ')), 0), 0)],
    CASE WHEN regexp_full_match(run, '{any_of}') THEN CASE {loose} END END) AS id FROM spelled),
ids AS (SELECT doc_id, list(id ORDER BY part, i, j) AS ids FROM known WHERE id IS NOT NULL GROUP BY doc_id),
spelt AS (
  SELECT d.doc_id, coalesce(ids, []) AS ids, array_to_string(list_transform(coalesce(ids, []), lambda x: '<' || x || '>'), '') AS rest
  FROM documents d LEFT JOIN ids USING (doc_id)),
{(","+chr(10)).join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct([name FOR name IN flatten([{', '.join(columns)}]) IF name IS NOT NULL])), ',') AS licences
FROM {last}"""
