"""License scans: TF-IDF cosine of lines to templates, and inheritance by directory. DataFrame functions only.

Every line of every file is compared with the lines of the templates as sparse
TF-IDF vectors. A file without a license of its own gets that of the nearest
ancestor directory that holds a licence file, found by joins on directory paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import spared, stored
from .rules import let

#: Usual header lines by license.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "MIT": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "GNU GENERAL PUBLIC LICENSE Version 3"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "GNU GENERAL PUBLIC LICENSE Version 2"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}
#: Words that neither templates nor lines are compared by.
STOP_WORDS = ["a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "may", "not", "of", "on", "or", "that", "the", "this", "to", "with", "you"]
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.-][^/]*)?$"
_tokens = re.compile("[a-z0-9]+").findall


def template_counts(templates: dict[str, list[str]]) -> tuple[list[str], list[tuple[str, Counter]]]:
    """The templates' words, and the license and word counts of each template line."""
    rows = [(name, Counter(w for w in _tokens(line.lower()) if w not in STOP_WORDS)) for name, lines in sorted(templates.items()) for line in lines]
    return sorted(set().union(*(c for _, c in rows))), rows


def words_in(line: Column) -> Column:
    return F.filter(F.split(line, "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(STOP_WORDS))


def counted(words: Column) -> Column:
    """An array's different words with how often each occurs."""
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.zip_with(at, F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(s))), lambda a, b: F.struct(F.get(s, a).alias("w"), (b - a).alias("n"))))

    return F.when(F.size(words) > 0, let(F.array_sort(words), runs)).otherwise(F.array().cast("array<struct<w:string,n:int>>"))


def lines_with(text: Column, vocab: list[str]) -> Column:
    """Of the text's lines with a template word: the words' counts (by place in `vocab`) and the other words with theirs."""
    pattern = r"(?<![a-z0-9])(" + "|".join(sorted(vocab, key=len, reverse=True)) + r")(?![a-z0-9])"
    lines = F.filter(F.split(F.lower(text), "[\r\n]+"), lambda x: F.regexp_like(x, F.lit(pattern)))

    def unit(ws: Column) -> Column:
        return let(F.filter(ws, lambda w: w.isin(vocab)), lambda hits: F.struct(
            F.transform(F.array(*map(F.lit, vocab)), lambda v: F.size(F.filter(hits, lambda w: w == v))).alias("counts"),
            let(F.filter(ws, lambda w: ~w.isin(vocab)), counted).alias("others")))

    return F.when(F.regexp_like(F.lower(text), F.lit(pattern)), F.transform(lines, lambda x: let(words_in(x), unit))).otherwise(
        F.array().cast("array<struct<counts:array<int>,others:array<struct<w:string,n:int>>>>"))


def scanned(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.6, file_share: float = 0.5) -> DataFrame:
    """`files` (path, text, any others but text are kept) with own_license, similarity and licence_file.

    A line's vector has tf * idf for each word that is no stop word, idf =
    ln((1 + N) / (1 + df)) + 1 with the lines that hold it of all N lines of all files. A file's license is that of its line nearest to a
    template line, if the cosine is at least `least` (ties: the license first by
    name). It is a licence file if it has the name of one, or if the nearest
    line is at least `file_share` of its words. Null texts are empty.
    """
    vocab, rows = template_counts(templates)
    files = files.drop("own_license", "similarity", "licence_file", "license", "inherited_from")
    files, named_back = spared(files, ["_text", "_lines", "_units", "_words", "_row", "_best"])
    text = F.coalesce("text", F.lit(""))
    kept = [c for c in files.columns if c != "text"]
    lines = F.split(F.lower(text), "[\r\n]+")
    df = files.select(F.explode(F.flatten(F.transform(lines, lambda x: F.array_distinct(words_in(x))))).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    df = stored(df, "license_words")
    units = files.select(*kept, text.alias("_text"), F.size(F.split(text, "[\r\n]+")).cast("long").alias("_lines"), lines_with(text, vocab).alias("_units"))
    words = F.when(F.size("_units") > 0, F.size(F.array_remove(F.split(F.lower("_text"), "[^a-z0-9]+"), "")))
    units = stored(units.withColumns({"_words": words, "_row": F.monotonically_increasing_id()}).drop("_text"), "licenses")
    n = units.agg(F.coalesce(F.sum("_lines"), F.lit(0))).first()[0]
    seen = {r["w"]: r["df"] for r in df.where(F.col("w").isin(vocab)).collect()}  # at most one row for each template word
    most = df.where(~F.col("w").isin(vocab)).agg(F.coalesce(F.max("df"), F.lit(0))).first()[0]
    idf = [math.log((1 + n) / (1 + seen.get(w, 0))) + 1 for w in vocab]
    low, high = math.log((1 + n) / (1 + most)) + 1, math.log(1 + n) + 1  # bounds of the other words' idf
    sq = F.array(*[F.lit(x * x) for x in idf])
    known = []
    for name, count in rows:
        norm = math.sqrt(sum((count[w] * idf[i]) ** 2 for i, w in enumerate(vocab)))
        known.append((name, [count[w] * idf[i] ** 2 / norm for i, w in enumerate(vocab)]))
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    def near(u: Column) -> Column:
        """The line's nearest template before its own norm: what the other words add to that norm is the same for all templates."""
        dots = F.array_min(F.array(*[F.struct(F.round(-add(F.zip_with(u["counts"], F.array(*map(F.lit, t)), lambda c, x: c * x)), 12).alias("dot"), F.lit(name).alias("license")) for name, t in known]))
        return F.struct(dots.alias("best"), add(F.zip_with(u["counts"], sq, lambda c, x: c * c * x)).alias("norm2"), add(F.transform(u["others"], lambda o: F.lit(1.0) * o["n"] * o["n"])).alias("others2"),
                        (F.aggregate(u["counts"], F.lit(0), lambda a, x: a + x) + F.aggregate(u["others"], F.lit(0), lambda a, o: a + o["n"])).alias("words"), u["others"].alias("others"))

    # a file's nearest line is among those whose greatest possible cosine reaches the greatest of the least possible ones
    cosine = lambda x, i: -x["best"]["dot"] / F.sqrt(x["norm2"] + x["others2"] * (i * i))
    able = units.select("_row", F.transform("_units", near).alias("_near"))
    able = able.withColumn("_least", F.array_max(F.transform("_near", lambda x: cosine(x, high))))
    able = able.select("_row", "_least", F.posexplode("_near").alias("_line", "x")).where(cosine(F.col("x"), low) >= F.col("_least") - 1e-8)
    able = stored(able.select("_row", "_line", "x"), "license_lines")
    other = able.select("_row", "_line", F.explode("x.others").alias("o")).select("_row", "_line", F.col("o.w").alias("w"), F.col("o.n").alias("n"))
    weight = F.col("n") * (F.log((1 + n) / (1 + F.col("df"))) + 1)
    other = other.join(df, "w").groupBy("_row", "_line").agg(F.sum(weight * weight).alias("_other2"))
    best = able.join(other, ["_row", "_line"], "left").select("_row", F.struct(
        F.round(F.col("x.best.dot") / F.sqrt(F.col("x.norm2") + F.coalesce("_other2", F.lit(0.0))), 9).alias("near"), F.col("x.best.license").alias("license"), F.col("x.words").alias("words")).alias("b"))
    found = units.join(best.groupBy("_row").agg(F.min("b").alias("_best")), "_row", "left")
    hit = F.coalesce(-F.col("_best.near") >= least, F.lit(False))
    named = F.coalesce(F.regexp_like("path", F.lit(LICENSE_FILE)), F.lit(False))
    return named_back(found.select(
        *kept, F.when(hit, F.col("_best.license")).alias("own_license"), F.coalesce(-F.col("_best.near"), F.lit(0.0)).alias("similarity"),
        (hit & (named | F.coalesce(F.col("_best.words") >= file_share * F.col("_words"), F.lit(False)))).alias("licence_file")))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame) -> DataFrame:
    """Scanned files with license and inherited_from (a directory; null if the license is its own, or none).

    Of several licence files in a directory the most similar holds (ties: first
    by license). Directories without files are no matter; a null path inherits nothing.
    """
    files, named_back = spared(files, ["_dir", "_n"])
    files = files.withColumn("_dir", parent(F.col("path")))
    near = F.struct((-F.col("similarity")).alias("s"), F.col("own_license").alias("l"))
    holders = files.where("licence_file and path is not null").groupBy(F.col("_dir").alias("_holder")).agg(F.min(near).alias("_l"))
    holders = holders.select("_holder", F.col("_l.l").alias("_license"))
    # ancestors are looked up once for each directory, however many files it has
    dirs = files.where("own_license is null and path is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    steps = dirs.select("_dir", F.explode(F.array_distinct(above)).alias("_holder"))
    nearest = steps.join(holders, "_holder").groupBy("_dir").agg(F.max_by(F.struct("_holder", "_license"), F.length("_holder")).alias("_n"))
    out = files.join(nearest, "_dir", "left")
    own = F.col("own_license").isNotNull()
    return named_back(out.withColumn("license", F.coalesce("own_license", "_n._license")).withColumn(
        "inherited_from", F.when(~own, F.col("_n._holder"))).drop("_dir", "_n"))
