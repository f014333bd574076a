"""Licence notices in texts: word-bigram Dice similarity to templates, in SQL functions only.

A text's units are its lines and its paragraphs. A unit is compared with a template only if their bigram counts
allow the least similarity, and only if it holds an anchor word: anchors are picked from the templates so that
a unit without any of them cannot reach the least similarity either. Both tests are lossless.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Public notices, as one is to find them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "bsd-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
PERCENT = 80


def words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams in order; a single word is its own."""
    w = words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:]))) if len(w) > 1 else w


def least_shared(size: int, percent: int) -> int:
    """Fewest bigrams a unit of any size must share with a template of ``size`` bigrams to reach ``percent``.

    A unit of u bigrams sharing s reaches it if 200 * s >= percent * (u + size), and s <= u.
    """
    return -(-percent * size // (200 - percent))


def anchors(templates: dict[str, str], percent: int) -> list[str]:
    """Words, one of which every unit holds that reaches ``percent`` with some template; longer words first."""
    picked: list[str] = []
    for text in templates.values():
        own = bigrams(text)
        left = [b for b in own if not any(p in b.split() for p in picked)]
        for word in sorted(set(words(text)), key=lambda w: (-len(w), w)):
            if len(left) < least_shared(len(own), percent):
                break
            picked.append(word)
            left = [b for b in left if word not in b.split()]
    return sorted(set(picked))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    percent: int = PERCENT,
) -> DataFrame:
    """``id_col, matches array<struct<license, unit, shared, unit_bigrams, template_bigrams>>`` for each row.

    ``unit`` is the line or paragraph as it stands; a paragraph of one line counts once. Null and empty texts
    match nothing; null ids and repeated rows are kept; an empty table gives no rows; other columns are not
    read; no templates match nothing. One projection without a shuffle.
    """
    templates = TEMPLATES if templates is None else templates
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    kind = "array<struct<license:string,unit:string,shared:int,unit_bigrams:int,template_bigrams:int>>"
    if not templates:
        return rows.select(F.col("id").alias(id_col), F.array().cast(kind).alias("matches"))
    anchor = r"(?i)(?<![a-z0-9])(?:" + "|".join(anchors(templates, percent)) + r")(?![a-z0-9])"
    sizes = {name: len(bigrams(t)) for name, t in templates.items()}
    lo = min(least_shared(n, percent) for n in sizes.values())
    hi = max((200 - percent) * n // percent for n in sizes.values())

    pieces = F.array_distinct(F.concat(F.split("text", r"\n"), F.split("text", r"\n[ \t\r]*\n")))
    units = F.filter(pieces, lambda u: u.rlike(anchor))

    def with_words(u: Column) -> Column:
        plain = F.trim(F.regexp_replace(F.lower(u), "[^a-z0-9]+", " "))
        return F.struct(u.alias("unit"), F.split(plain, " ").alias("words"))

    def with_bigrams(u: Column) -> Column:
        w = u["words"]
        pairs = F.zip_with(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        return F.struct(u["unit"].alias("unit"), F.array_distinct(F.when(F.size(w) > 1, pairs).otherwise(w)).alias("bigrams"))

    # A unit of w words has at most w - 1 bigrams; repeated ones make it smaller, so only the lower bound holds here.
    units = F.filter(F.transform(units, with_words), lambda u: F.size(u["words"]) > lo)
    units = F.filter(
        F.transform(units, with_bigrams), lambda u: (F.size(u["bigrams"]) >= lo) & (F.size(u["bigrams"]) <= hi)
    )

    def compared(u: Column) -> Column:
        found = []
        for name, content in templates.items():
            own = F.array(*[F.lit(b) for b in bigrams(content)])
            n = sizes[name]
            size = F.size(u["bigrams"])
            fits = (size >= least_shared(n, percent)) & (size * percent <= (200 - percent) * n)
            shared = F.when(fits, F.size(F.array_intersect(u["bigrams"], own))).otherwise(0)
            found.append(
                F.struct(
                    F.lit(name).alias("license"),
                    u["unit"].alias("unit"),
                    shared.alias("shared"),
                    size.alias("unit_bigrams"),
                    F.lit(n).alias("template_bigrams"),
                )
            )
        return F.array(*found)

    reached = lambda m: 200 * m["shared"] >= percent * (m["unit_bigrams"] + m["template_bigrams"])
    matches = F.filter(F.flatten(F.transform(units, compared)), reached)
    some = F.coalesce(F.col("text").rlike(anchor), F.lit(False))
    return rows.select(
        F.col("id").alias(id_col), F.when(some, matches).otherwise(F.array().cast(kind)).cast(kind).alias("matches")
    )


def scan_sql(templates: dict[str, str] | None = None, percent: int = PERCENT) -> str:
    """DuckDB SQL of the scan by brute force: every unit against every template, no pruning."""
    templates = TEMPLATES if templates is None else templates
    listed = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in templates.items())

    def grams(column: str) -> str:
        w = f"str_split(trim(regexp_replace(lower({column}), '[^a-z0-9]+', ' ', 'g')), ' ')"
        return (
            f"CASE WHEN len({w}) > 1 THEN list_distinct(list_transform(list_zip({w}[:-2], {w}[2:]), "
            f"lambda p: p[1] || ' ' || p[2])) ELSE {w} END"
        )

    return f"""
WITH templates(license, content) AS (VALUES {listed}),
template_grams AS (SELECT license, {grams('content')} AS t FROM templates),
units AS (
  SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, unnest(list_concat(str_split(text, chr(10)), str_split_regex(text, '\\n[ \\t\\r]*\\n'))) AS unit
    FROM documents WHERE text IS NOT NULL)),
unit_grams AS (SELECT doc_id, unit, {grams('unit')} AS u FROM units),
matches AS (
  SELECT doc_id, license, unit FROM unit_grams, template_grams
  WHERE 200 * len(list_intersect(u, t)) >= {percent} * (len(u) + len(t))),
per_doc AS (
  SELECT doc_id, count(*) AS n_matches, count(DISTINCT unit) AS n_units,
         array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses
  FROM matches GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(n_units, 0)::BIGINT AS n_units,
       coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""
