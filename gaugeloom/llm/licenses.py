"""Find licence notices in documents by MinHash bands over overlapping windows, in DataFrame functions only.

A template of n words is sought in windows of 2n words, n words apart, so every
stretch of n words lies whole within a window. A window and the templates of
its length meet if one of ``BANDS`` hash minima over their shingles is equal
(bands of one row). A window that holds the least share of a template's shingles agrees with it in
at least a seventh of all, so it is retrieved with a probability of at least
1 - (6/7) ** 64, over 0.9999. The share is then counted exactly.

A window without any shingle of a template cannot hold one; such windows are
never built, which loses none and leaves little to hash.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm.common import text_or_empty

SHINGLE = 5
BANDS = 64
SHARE = 0.8
#: Shingles of the templates that are sought in one pass; more templates take more passes.
PASS_SHINGLES = 5000

#: Templates are alike if one holds this share of the other's shingles: of alike ones at one place the best match stays.
ALIKE = 0.5

#: Wording of notices that are in common use.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _once(value: Column) -> Column:
    """The value, worked out once per row: filters that use it are not moved in front of it, which would repeat it per element."""
    return F.explode(F.array(value))


def _shingles(words: str) -> Column:
    """Hash of the shingle at each word; none if there are fewer words than a shingle has."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(SHINGLE))))
    return F.when(F.size(words) >= SHINGLE, hashed).otherwise(F.array().cast("array<bigint>"))


def _minima(shingles: str) -> Column:
    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(band))))

    return F.array(*map(least, range(BANDS)))


def _templates(spark: SparkSession, templates: Iterable[tuple[str, str]]) -> list:
    listed = F.array(*(F.struct(F.lit(k).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for k, (name, text) in enumerate(templates)))
    rows = spark.range(1).select(F.inline(listed)).select("template", "license", _once(_words(F.col("text"))).alias("words"))
    rows = rows.select("template", "license", F.size("words").alias("length"), _once(F.array_distinct(_shingles("words"))).alias("sought"))
    got = rows.withColumn("minima", _minima("sought")).collect()
    if any(r.length < SHINGLE for r in got):
        raise ValueError(f"a template needs {SHINGLE} words")
    return got


def _passes(templates: list) -> list[list]:
    out: list[list] = [[]]
    for t in templates:
        if out[-1] and sum(len(x.sought) for x in out[-1]) + len(t.sought) > PASS_SHINGLES:
            out.append([])
        out[-1].append(t)
    return out


def _bands(spark: SparkSession, templates: list) -> DataFrame:
    """(length, band, least, template, license, sought) for every template and band."""
    rows = [
        F.struct(
            F.lit(t.length).alias("length"), F.lit(t.template).alias("template"), F.lit(t.license).alias("license"),
            F.array(*map(F.lit, t.sought)).alias("sought"), F.array(*map(F.lit, t.minima)).alias("minima"),
        )
        for t in templates
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).select("length", "template", "license", "sought", F.posexplode("minima").alias("band", "least"))


def _search(docs: DataFrame, templates: list, share: float) -> DataFrame:
    spark = docs.sparkSession
    wanted = sorted({s for t in templates for s in t.sought})
    lengths = F.array(*map(F.lit, sorted({t.length for t in templates})))
    placed = docs.select("row", _once(_shingles("words")).alias("shingles"))
    hits = F.filter(F.transform("shingles", lambda s, i: F.when(s.isin(wanted), i)), lambda i: i.isNotNull())
    hit = placed.select("row", "shingles", _once(hits).alias("hits")).where(F.size("hits") > 0).select("row", "shingles", "hits", F.explode(lengths).alias("length"))
    first = F.transform("hits", lambda p: F.floor(p / F.col("length")).cast("int"))
    numbers = F.filter(F.array_distinct(F.concat(first, F.transform(first, lambda w: w - 1))), lambda w: w >= 0)
    window = lambda w: F.struct(w.alias("number"), F.slice("shingles", w * F.col("length") + 1, 2 * F.col("length") - SHINGLE + 1).alias("own"))
    windows = hit.select("row", "length", F.inline(F.transform(numbers, window)))
    banded = windows.where(F.size("own") > 0).select("row", "length", "number", "own", F.posexplode(_minima("own")).alias("band", "least"))
    # A row per template of this pass and band: bounded by PASS_SHINGLES.
    met = banded.join(F.broadcast(_bands(spark, templates)), ["length", "band", "least"])
    inside = F.array_position(F.transform("own", lambda s: F.array_contains("sought", s)), True) - 1
    found = met.withColumns({"shared": F.size(F.array_intersect("own", "sought")), "of": F.size("sought")}).where(F.col("shared") >= share * F.col("of"))
    return found.select("row", "template", "license", "shared", "of", "length", (F.col("number") * F.col("length") + inside).cast("int").alias("first_word"))


def _kinds(templates: list) -> dict[int, int]:
    """Templates that are alike, directly or through others, get the number of the first of them."""
    kind = {t.template: t.template for t in templates}
    for t in templates:
        for u in templates:
            if len(set(t.sought) & set(u.sought)) >= ALIKE * min(len(t.sought), len(u.sought)):
                one, other = sorted((kind[t.template], kind[u.template]))
                kind = {k: one if v == other else v for k, v in kind.items()}
    return kind


def _best_of_alike(found: DataFrame, templates: list) -> DataFrame:
    """Where alike templates overlap, the one with the largest share, of equal ones the longest."""
    kinds = _kinds(templates)
    numbered = found.withColumn("kind", F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("template")))
    end = F.col("first_word") + F.col("length")
    order = W.partitionBy("row", "kind").orderBy("first_word", "template")
    reach = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    placed = numbered.withColumn("new", F.when(F.col("first_word") < reach, 0).otherwise(1)).withColumn("place", F.sum("new").over(order))
    rank = W.partitionBy("row", "kind", "place").orderBy(F.desc(F.col("shared") / F.col("of")), F.desc("of"), "template")
    return placed.withColumn("rank", F.row_number().over(rank)).where("rank = 1")


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """(doc_id, text_key, template, license, shared, of, first_word) for every document and template found in it.

    ``docs`` has doc_id and text; other columns are ignored. ``templates`` are (license,
    text) of at least five words. Words are runs of letters and digits in lower
    case, shingles five of them. ``shared`` of a template's ``of`` distinct
    shingles stand in the window with the most of them, ``first_word`` is where the
    first of these shingles begins there, in the first such window. Of templates that are alike (one names a version, the other does
    not) and lie at one place only the best match is given. ``text_key`` is the hash of the text.

    Null, empty and short texts hold nothing. Rows with a null doc_id are
    scanned like all others. Rows equal in doc_id and text give the same row once. An
    empty table or no template gives an empty result.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    row = F.struct(F.col("doc_id"), F.xxhash64(text).alias("text_key")).alias("row")
    rows = docs.select(row, _once(_words(text)).alias("words"))
    passes = [p for p in _passes(_templates(spark, templates) if templates else []) if p]
    found = [_search(rows, p, share) for p in passes]
    if not found:
        return rows.limit(0).select("row.*", *(F.lit(None).cast(t).alias(n) for n, t in (("template", "int"), ("license", "string"), ("shared", "int"), ("of", "int"), ("first_word", "int"))))
    order = F.struct(F.col("shared").alias("shared"), (-F.col("first_word")).alias("back"), F.col("length").alias("length"))
    best = reduce(DataFrame.union, found).groupBy("row", "template", "license", "of").agg(F.max(order).alias("best"))
    each = best.select("row", "template", "license", "best.shared", "of", "best.length", (-F.col("best.back")).alias("first_word"))
    kept = _best_of_alike(each, [t for p in passes for t in p])
    return kept.select("row.doc_id", "row.text_key", "template", "license", "shared", "of", "first_word")
