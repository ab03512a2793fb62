"""License scans: MinHash bands over overlapping text windows, then exact containment.

Words are runs of letters and digits, lower-cased.  A template of ``m`` distinct
``k``-word shingles is looked for in windows of ``2 m`` shingles that start every ``m``
shingles, so every stretch of ``m`` shingles lies whole in one window.  A document holds
a template when one window has at least ``percent`` percent of its shingles.

Such a window has a Jaccard similarity of at least 0.8 m / 2.2 m = 0.36 with the template
(0.8 is the default percentage).  With ``bands`` bands of one MinHash each the two share a
band with probability 1 - 0.64 ** 24 = 0.99998 at least.  Windows meet templates by
(size, band, value); candidates are verified by counting their common shingles.

A window without any template shingle shares no MinHash value with a template, so windows
are formed around template shingles only; the templates are a small fixed list, whose
shingles are literals of the plan.  Up to the final row per document and template nothing
is shuffled.  DataFrame functions only.

Defined cases: null, empty and wordless texts hold no template; fewer than ``k`` words
are one shingle; null ids are left out; rows that repeat an id give one result, that of
the best window; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finspark.llm.shingles_sql import shingles_column

# Fixed values: (license, name of the template, text).
TEMPLATES = (
    ("MIT", "statement", "Released under the MIT License."),
    ("Apache-2.0", "statement", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "statement", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "statement", "Licensed under CC BY-NC 4.0."),
    ("MIT", "grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "notice", "you may not use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied."),
    ("GPL-3.0", "notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("BSD-3-Clause", "conditions", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
)
#: Between words, as a Java and as an RE2 pattern.
GAP = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")


def _minhashes(shingles: Column, bands: int) -> Column:
    """(band, value): the smallest of the shingle hashes salted by the band."""
    return F.array(*(F.struct(
        F.lit(i).alias("band"), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(i)))).alias("value"))
        for i in range(bands)))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[tuple[str, str, str]] = TEMPLATES, k: int = 5, percent: int = 80,
                  bands: int = 24) -> DataFrame:
    """``(id, license, template, common, size)``: templates found, with the shingles of the best
    window that are among the template's ``size`` ones."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame([tuple(t) for t in templates], "license string, template string, text string").select(
        "license", "template", F.array_distinct(shingles_column(_words(F.col("text")), k)).alias("wanted")).withColumn(
        "size", F.size("wanted")).filter("size > 0")
    rows = wanted.select("wanted", "size").collect()
    vocabulary, sizes = sorted({h for r in rows for h in r.wanted}), sorted({r.size for r in rows})
    known = lambda h: h.isin(vocabulary)

    texts = (docs.filter(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), shingles_column(_words(F.col(text_col)), k).alias("all"))
             .filter(F.exists("all", known)))
    places = texts.withColumn("hits", F.filter(F.sequence(F.lit(0), F.size("all") - 1),
                                               lambda i: known(F.element_at("all", i + 1))))
    # A hit at p lies in the windows that start at the last multiple of m up to p and at the one before.
    starts = F.array(*(F.struct(F.lit(m).alias("m"), F.array_distinct(F.flatten(F.transform(
        "hits", lambda p: F.array(F.greatest(p - p % m - m, F.lit(0)), p - p % m)))).alias("starts")) for m in sizes))
    windows = (places.select("id", "all", F.explode(starts).alias("w"))
               .select("id", "all", "w.m", F.explode("w.starts").alias("start"))
               .select("id", "m", F.slice("all", F.col("start") + 1, F.col("m") * 2).alias("window")))
    banded = windows.select("id", "m", "window", F.explode(_minhashes(F.col("window"), bands)).alias("b"))
    entered = wanted.select("license", "template", "wanted", "size", F.explode(_minhashes(F.col("wanted"), bands)).alias("t"))
    met = banded.join(F.broadcast(entered), (F.col("m") == F.col("size")) & (F.col("b.band") == F.col("t.band"))
                      & (F.col("b.value") == F.col("t.value")))
    held = met.select("id", "license", "template", "size",
                      F.size(F.array_intersect("window", "wanted")).alias("common")).filter(
        F.col("common") * 100 >= F.col("size") * percent)
    return held.groupBy("id", "license", "template", "size").agg(F.max("common").alias("common")).select(
        "id", "license", "template", "common", "size")
