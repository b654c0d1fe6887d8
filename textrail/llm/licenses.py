"""Licence scan of files.

Every line that speaks of a licence (a header), and every licence file also as
a whole, and every run of words of a header as long as a template, is compared with templates by the cosine of sparse TF-IDF vectors; the
document frequencies of the templates' terms are counted over all texts.  A
file without a header of its own inherits the licence of the licence file in
the nearest directory above it, found by joining the paths of its ancestors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, settled, small_batches
from .words import parts, word_hashes

# fixed values: what licences say of themselves
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "you may not use this file except in compliance with the Apache License, Version 2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "you can redistribute it under the terms of the GNU General Public License version 3"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "licensed under the Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: A line is a header if it has one of these.
HEADER = r"(?i)licen[cs]e|licensed|copyright|redistribut|public domain|permission is hereby"
#: A path's last part of a licence file.
FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
SIMILAR = 0.6


def terms(text: Column) -> Column:
    """Lower-case words of letters, digits, inner hyphens and dots."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[-.][a-z0-9]+)*"), F.lit(0))


def _frequencies(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, df): in how many texts of ``texts`` each term of the templates
    stands as a word (punctuation around it counts as part of no word)."""
    listed = sorted(r["term"] for r in vocabulary.collect())  # bounded: the templates' words
    blank = np.array([32 if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b in (45, 46) or b >= 128) else b for b in range(256)], np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.frombuffer(" ".join(listed).encode(), np.uint8)
        known = word_hashes(raw, np.array([0, len(raw)]))[0]
        order = np.argsort(known)
        total, seen = np.zeros(len(listed), np.int64), 0
        for batch in batches:
            for first, last, raw, at in parts(batch.column("text")):
                clean = blank[raw]
                # a hyphen or dot at a word's end is no part of it
                edge = (clean == 45) | (clean == 46)
                clean[edge & np.r_[clean[1:] == 32, True]] = 32
                word, doc = word_hashes(clean, at)
                where = np.minimum(np.searchsorted(known[order], word), len(listed) - 1)
                hit = known[order][where] == word
                pairs = np.unique(doc[hit] * len(listed) + order[where[hit]])
                total += np.bincount(pairs % len(listed), minlength=len(listed))
                seen += last - first
        yield pa.RecordBatch.from_arrays([pa.array([*listed, None], pa.string()), pa.array([*total.tolist(), seen])], names=["term", "df"])

    return small_batches(texts).mapInArrow(run, "term string, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def scan(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, path, license, similarity, via, origin`` for every row.

    ``via`` is ``header`` or ``file`` (the row's own text, of a licence file
    the whole or a line of it; the most similar
    template, then the first by name), ``inherited`` (``origin``: the licence
    file's path; of several in a directory the most similar, then the first),
    or null without a licence.  Null and empty texts have no header; a row
    without a path inherits nothing; repeated rows get the same answer; an
    empty table gives an empty result.  Other columns are not read.
    """
    spark = df.sparkSession
    df = settled(df)
    src = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), path.alias("path"), F.col(f"`{text_col}`").alias("text"))
    samples = spark.createDataFrame([(k, n, t) for k, v in TEMPLATES.items() for n, t in enumerate(v)], "license string, n int, text string")
    bags = samples.select("license", "n", F.explode(terms(F.col("text"))).alias("term")).groupBy("license", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    counts = cut(_frequencies(src.select("text"), bags.select("term").distinct()))
    total = counts.where("term is null").select("df").first()
    n = total["df"] if total else 0
    # a term of no template weighs as one that no text has
    idf = counts.where("term is not null").select("term", (F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    rare = float(np.log(n + 1.0) + 1.0)
    weights = bags.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    weights = weights.join(F.broadcast(weights.groupBy("license", "n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))), ["license", "n"])
    weights = cut(weights.select("license", "n", "term", (F.col("w") / F.col("len")).alias("tw")))

    is_file = F.coalesce(F.regexp_like(F.element_at(F.split("path", "/"), -1), F.lit(FILE)), F.lit(False))
    # a sentence of its own is compared on its own, also amid a line
    split = F.split("text", r"\n|(?<=[.!?])\s+(?=[A-Z])")
    headers = (src.where(F.regexp_like("text", F.lit(HEADER))).select("row", F.when(is_file, "file").otherwise("header").alias("via"), F.explode(split).alias("line"))
               .where(F.regexp_like("line", F.lit(HEADER))).select("row", "via", "line"))
    files = src.where(is_file & F.col("text").isNotNull()).select("row", F.lit("file").alias("via"), F.col("text").alias("line"))
    lines = headers.unionByName(files).withColumn("words", terms(F.col("line"))).select("row", "via", "words")
    # a notice amid other words: windows as long as each template, at every word, that speak of a licence themselves
    sizes = sorted({r["size"] for r in bags.groupBy("license", "n").agg(F.sum("tf").alias("size")).collect()})  # bounded: the templates

    def starts(size: int) -> Column:
        places = F.when(F.size("words") > size, F.sequence(F.lit(1), F.size("words") - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: F.struct(k.alias("k"), F.lit(size).alias("size")))

    windows = (headers.select("row", "via", terms(F.col("line")).alias("words")).select("row", "via", "words", F.explode(F.flatten(F.array(*map(starts, sizes)))).alias("at"))
               .select("row", "via", F.slice("words", F.col("at.k"), F.col("at.size")).alias("words"))
               .where(F.regexp_like(F.array_join("words", " "), F.lit(HEADER))))
    # equal windows of a row count once
    lines = lines.unionByName(windows.distinct()).select("row", "via", F.monotonically_increasing_id().alias("unit"), "words")
    unit = lines.select("row", "via", "unit", F.explode("words").alias("term")).groupBy("row", "via", "unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    unit = cut(unit.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rare))).select("row", "via", "unit", "term", "w"))
    norm = unit.groupBy("row", "via", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    dots = unit.join(F.broadcast(weights), "term").groupBy("row", "unit", "license", "n").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    best = F.struct((-F.round(F.col("dot") / F.col("len"), 9)).alias("s"), F.col("license").alias("l"), F.col("via").alias("v"))
    own = cut(dots.join(norm, ["row", "unit"]).where(F.col("dot") / F.col("len") >= SIMILAR).groupBy("row").agg(F.min(best).alias("b"))
              .select("row", F.col("b.l").alias("license"), (-F.col("b.s")).alias("similarity"), F.col("b.v").alias("via")))
    places = cut(src.select("row", "doc_id", "path"))  # the path may read the text
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    named = places.join(own, "row", "left")
    top = W.partitionBy("folder").orderBy(F.desc("similarity"), "path", "row")
    folders = cut(named.where("via = 'file'").withColumn("folder", folder).withColumn("k", F.row_number().over(top)).where("k = 1")
                  .select("folder", F.col("license").alias("up_license"), F.col("similarity").alias("up_similarity"), F.col("path").alias("origin")))
    if folders.isEmpty():
        return named.select("doc_id", "path", "license", "similarity", "via", F.lit(None).cast("string").alias("origin"))
    parts_ = F.split(folder, "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts_)), lambda k: F.struct(F.array_join(F.slice(parts_, F.lit(1), k), "/").alias("folder"), k.alias("depth")))
    bare = named.where("license is null and path is not null").select("row", F.explode(above).alias("a")).select("row", "a.folder", "a.depth").distinct()
    near = F.max(F.struct("depth", "up_license", "up_similarity", "origin")).alias("n")
    gained = bare.join(folders, "folder").groupBy("row").agg(near).select("row", "n.*")
    return named.join(gained, "row", "left").select(
        "doc_id", "path", F.coalesce("license", "up_license").alias("license"), F.coalesce("similarity", "up_similarity").alias("similarity"),
        F.coalesce("via", F.when(F.col("up_license").isNotNull(), "inherited")).alias("via"), "origin")
