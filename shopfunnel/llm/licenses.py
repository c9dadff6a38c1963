"""License notices in texts: MinHash retrieval of templates, then exact containment.

Overlapping windows of words are described by MinHash values of their word shingles. One value is
a band: a window and a template window that share a share J of their shingles meet in at least one
of ``BANDS`` bands with probability ``1 - (1 - J) ** BANDS``. Any notice of up to ``WINDOW - STEP +
1`` words lies whole inside some window, where J is at least a half for notices of five words and
more: a miss has a probability of 2e-10. Longer notices fill whole windows. Edited notices are
less alike: at J = 0.2 one in 1,300 is missed. Windows that meet a template are verified by the
share of the template's shingles in the words around. Notices of versions and variants share most
of their shingles; a template is told apart by runs of words that the other license lacks.

All of it is built-in functions; minima are taken in generated code, row by row of the windows.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a window and from one to the next; words of a shingle; bands of one value each.
WINDOW, STEP, SHINGLE, BANDS = 8, 4, 3, 32
#: Least share of a template's shingles.
CONTAINED = 0.8
#: Words of a run that tells two licenses' notices apart.
RUN = 4

#: Notices by license identifier. Texts as licensors word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


_HASHES = [f"_shingle{k}" for k in range(WINDOW - SHINGLE + 1)]


def _with_hashes(windows: DataFrame, words: str) -> DataFrame:
    """Each window of ``words`` from ``start`` on with the hashes of its shingles, null beyond the end."""
    word = [F.get(words, F.col("start") + k) for k in range(WINDOW)]
    hashes = [
        F.when(word[k + SHINGLE - 1].isNotNull(), F.xxhash64(*word[k : k + SHINGLE])).alias(name)
        for k, name in enumerate(_HASHES)
    ]
    return windows.select(*windows.columns, *hashes)


def _with_values(hashed: DataFrame) -> DataFrame:
    """A row for each band of each window, with its ``value``.

    A band orders the shingles' hashes by their distance from a constant of its own, and its value
    is the least. Hashes are columns first, so that all bands use them.
    """
    constants = [hash_constant(band) for band in range(BANDS)]
    values = [F.least(*[F.col(h).bitwiseXOR(F.lit(c)) for h in _HASHES]) for c in constants]
    return hashed.select("*", F.posexplode(F.array(*values)).alias("band", "value")).drop(*_HASHES)


def hash_constant(number: int) -> int:
    """A signed 64-bit constant with no pattern."""
    return int.from_bytes(sha256(b"band %d" % number).digest()[:8], "little", signed=True)


def _shingles(words: Column, size: int = SHINGLE) -> Column:
    """Distinct shingles of an array of words."""
    last = F.size(words) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda k: F.concat_ws(" ", *[F.get(words, k + i) for i in range(size)])))


def _templates(spark: SparkSession, templates: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Templates with their shingles, the hashes of these, and the band values of their windows at every word."""
    rows = [(number, name, text) for number, (name, text) in enumerate(templates)]
    known = spark.createDataFrame(rows, "template int, license string, notice string")
    known = known.withColumn("notice_words", _words(F.col("notice"))).filter(F.size("notice_words") >= SHINGLE)
    known = known.select(
        "template", "license", F.size("notice_words").alias("notice_size"), "notice_words",
        _shingles(F.col("notice_words")).alias("notice_shingles"), _shingles(F.col("notice_words"), RUN).alias("runs"),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("notice_words") - WINDOW))
    windows = known.select("template", "notice_words", F.explode(starts).alias("start"))
    hashed = _with_hashes(windows, "notice_words")
    bands = _with_values(hashed).select("template", "band", "value").distinct()
    hashes = hashed.select(F.explode(F.array(*_HASHES)).alias("hash")).filter("hash is not null").distinct()
    return _telling(known.drop("notice_words")), hashes, bands


def _telling(known: DataFrame) -> DataFrame:
    """``known`` with ``telling``: for each notice of another license that would verify the template
    too, the template's runs that it lacks. Notices without any such run aren't told apart."""
    # a fixed list of notices
    other = known.select(F.col("license").alias("other"), F.col("notice_shingles").alias("other_shingles"), F.col("runs").alias("other_runs"))
    both = known.select("template", "license", "notice_shingles", "runs").crossJoin(F.broadcast(other)).filter("license <> other")
    shared = F.size(F.array_intersect("notice_shingles", "other_shingles"))
    own = both.filter(shared >= CONTAINED * F.size("notice_shingles")).withColumn("own", F.array_except("runs", "other_runs"))
    own = own.filter("size(own) > 0").groupBy("template").agg(F.collect_list("own").alias("telling"))
    return known.drop("runs").join(own, "template", "left")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    apart: bool = False,
) -> DataFrame:
    """``doc_id, license, word, containment`` of each license found in each document.

    ``word`` is the first word of the first window that verifies, and ``containment`` the largest
    share of a notice's shingles found. With ``apart``, a license whose notice another license's would
    verify too must show a run of words that the other's lacks, as its version; else all that are
    contained are reported. Null, empty and blank texts hold none; null ids are carried.
    Rows of one id are one document. An empty table gives an empty result. Templates of fewer words
    than a shingle are left out. Other columns are not read.
    """
    spark = docs.sparkSession
    # a fixed list of notices: a few values for each of their words
    known, hashes, bands = _templates(spark, templates or TEMPLATES)
    known_hashes = [row["hash"] for row in hashes.collect()]
    known_values = [row["value"] for row in bands.select("value").distinct().collect()]
    read = docs.select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("words"))
    read = read.filter(F.size("words") >= SHINGLE)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - SHINGLE), F.lit(STEP))
    windows = read.select("doc_id", "words", F.explode(starts).alias("start"))
    # a band's value is one of the window's shingles: without any of a template's, no band can meet
    hashed = _with_hashes(windows, "words").filter(reduce(Column.__or__, [F.col(h).isin(known_hashes) for h in _HASHES]))
    each = _with_values(hashed).filter(F.col("value").isin(known_values))
    each = each.join(F.broadcast(bands), ["band", "value"]).join(F.broadcast(known), "template")
    low = F.greatest(F.lit(0), F.col("start") - F.col("notice_size"))
    around = F.slice("words", low + 1, 2 * F.col("notice_size") + WINDOW)
    share = F.size(F.array_intersect(_shingles(around), F.col("notice_shingles"))) / F.size("notice_shingles")
    if apart:
        runs = _shingles(around, RUN)
        shown = F.forall("telling", lambda own: F.arrays_overlap(own, runs))
        each = each.filter((share >= CONTAINED) & F.coalesce(shown, F.lit(True)))
    found = each.select("doc_id", "license", F.col("start").cast("long").alias("word"), share.alias("containment"))
    found = found.filter(F.col("containment") >= CONTAINED)
    return found.groupBy("doc_id", "license").agg(F.min("word").alias("word"), F.max("containment").alias("containment"))
