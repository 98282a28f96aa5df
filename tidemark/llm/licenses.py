"""License scan by MinHash bands over overlapping text windows.

A template of m shingles is looked for in windows of m shingles and one step more, the step
being an eighth of m, so some window holds every occurrence whole. Window and template
then have a Jaccard similarity of at least 0.6 if the window holds 0.8 of the template.
Signatures of ``BANDS`` bands of ``ROWS`` minima make them meet in a band with a
probability of 1 - (1 - 0.6 ** ROWS) ** BANDS, which is above 0.9999. The windows that
met are then verified by exact containment of the template's shingles.

Two windows without a common shingle have no common minimum, so signatures are
computed only for windows with a shingle of some template; this loses no match.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
BANDS = 24
ROWS = 2
#: Texts that the registered query looks for: fixed values, openings and notices of public licenses.
TEMPLATES = {
    "AGPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation"
    ),
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "Boost notice": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license"
    ),
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0 notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work"
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "ISC notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "LGPL notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"
    ),
    "MIT line": "Released under the MIT License.",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction"
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    "SPDX Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX MIT": "SPDX-License-Identifier: MIT",
    "Unlicense notice": "This is free and unencumbered software released into the public domain.",
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: inside a lambda it would be computed for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of ``size`` words, in their order."""
    return let(
        words_of(text),
        lambda w: F.transform(
            F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - (size - 1))),
            lambda i: F.xxhash64(F.array_join(F.slice(w, i, size), " ")),
        ),
    )


def bands(hashes: Column) -> Column:
    """One key for each band: the hash of its minima over differently seeded hashes."""

    def low(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[F.xxhash64(*[low(b * ROWS + r) for r in range(ROWS)], F.lit(b)) for b in range(BANDS)])


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``template, k, shingles`` (distinct hashes of k words); a text under five words is one shingle of all of them."""
    rows = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    rows = rows.withColumn("k", F.least(F.size(words_of(F.col("text"))), F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("text"), k)) for k in range(1, SHINGLE + 1)])
    rows = rows.select("template", "k", F.array_distinct(hashes).alias("shingles"))
    return rows.filter("shingles is not null and size(shingles) > 0")


def step_of(m: int) -> int:
    return max(1, m // 8)


def scan(docs: DataFrame, templates: dict[str, str], contained: float = CONTAINED) -> DataFrame:
    """``doc_id, template, containment, first_word, windows``: licenses found in the documents.

    One row per document and template with the best containment of the template's
    shingles in a window, the word that the first such window starts at (from 0), and the
    number of windows that hold it. A template of fewer than five words is one shingle, to be found
    whole. Documents without a license have no row, nor have null texts. Rows with one ``doc_id`` count as one
    document, null ids as one too. Only ``doc_id`` and ``text`` are read. Templates
    are a parameter held on the driver; an empty table or no templates give no rows.
    """
    spark = docs.sparkSession
    known = [(r[0], r[1], list(r[2])) for r in template_table(spark, templates).collect()]
    schema = "template string, m int, shingles array<long>"
    table = spark.createDataFrame([(t, len(s), s) for t, _, s in known], schema)
    if not known:
        return docs.limit(0).select("doc_id", F.lit("").alias("template"), F.lit(0.0).alias("containment"),
                                    F.lit(0).alias("first_word"), F.lit(0).cast("long").alias("windows"))
    sizes: dict[int, dict[int, set[int]]] = {}
    for _, k, shingles in known:
        sizes.setdefault(k, {}).setdefault(len(shingles), set()).update(shingles)

    def windows_of(hashes: Column, m: int, vocabulary: set[int]) -> Column:
        """Windows of one size that hold a shingle of its templates, as (m, start, held)."""
        step, length = step_of(m), m + (step_of(m) if m >= 8 else 0)
        hits = F.filter(
            F.transform(hashes, lambda h, i: F.when(h.isin(*vocabulary), i)), lambda i: i.isNotNull()
        )
        first = lambda i: F.greatest(F.ceil((i - (length - 1)) / step), F.lit(0)).cast("int") * step
        last = lambda i: F.floor(i / step).cast("int") * step
        at = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.sequence(first(i), last(i), F.lit(step)))))
        held = lambda s: F.slice(hashes, s + 1, length)
        return F.transform(at, lambda s: F.struct(F.lit(m).alias("m"), s.alias("start"), held(s).alias("held")))

    def found_with(k: int, by_size: dict[int, set[int]]) -> Column:
        every = sorted(set().union(*by_size.values()))
        # most texts hold no shingle of any template and are done after one look at each of theirs
        return let(
            shingle_hashes(F.col("text"), k),
            lambda h: F.when(
                F.exists(h, lambda x: x.isin(*every)),
                reduce(F.concat, [windows_of(h, m, v) for m, v in sorted(by_size.items())]),
            ),
        )

    found = F.flatten(F.array_compact(F.array(*[found_with(k, by_size) for k, by_size in sorted(sizes.items())])))
    found = F.when(F.size(found) > 0, found)
    # explode_outer, as the filter that Spark derives from explode would compute ``found`` twice
    windows = docs.select("doc_id", F.explode_outer(found).alias("w")).filter("w is not null").select("doc_id", "w.*")
    keyed = windows.select("*", F.posexplode_outer(let(F.col("held"), bands)).alias("band", "key"))
    wanted = table.select("template", "m", "shingles", F.posexplode(let(F.col("shingles"), bands)).alias("band", "key"))
    # Spark broadcasts the template side if it is under its threshold
    verified = (
        keyed.join(wanted, ["m", "band", "key"])
        .withColumn("containment", F.size(F.array_intersect("shingles", "held")) / F.size("shingles"))
        .filter(F.col("containment") >= contained)
    )
    return verified.groupBy("doc_id", "template").agg(
        F.max("containment").alias("containment"),
        F.min("start").alias("first_word"),
        F.count_distinct("start").alias("windows"),
    )
