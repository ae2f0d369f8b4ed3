"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

A template of r five-word shingles, t of them distinct, is looked for in windows of W shingles, W the least power of two that
is 2 r and 8 at least, at steps of W / 2. Window and template collide in a band when their minima under that band's hash
agree (one row a band). The template's minimum in a band is one of its shingles, so only windows that hold it can collide:
the stored band table (shingle, band, license) is joined with the documents' shingles on the shingle's hash, and the windows
around a hit are hashed in that band, to see that nothing in them is less. Documents are read once for any library.

A document that holds a share c of the template's shingles, wherever they stand, holds a band's minimum with probability
c, and the W other shingles around it leave it the least with t / (t + W) at least. The bands of a template are set for a
probability MISS that no band collides. Candidates are verified on the whole document: the share of the template's distinct
shingles that the document holds.

Words are runs of ASCII letters and digits, compared in lower case. Everything is DataFrame operations. Band table and
templates are broadcast while their counted rows are few, and joined by shuffles beyond that.

Defined cases: null and empty texts, texts and templates of under five words match nothing; a null doc_id is reported as
null; a row that repeats (doc_id, text), by two 64-bit hashes, is reported once; a document may match several templates, `best` marks the highest
containment, ties going to more shingles and then the lesser id; very long texts are scanned whole; empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common

NGRAM = 5
CONTAINMENT = 0.8
#: The probability that no band finds a template that a document holds.
MISS = 1e-8

#: Notices by which texts state their license (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    "mit": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def grams(text: Column, n: int = NGRAM) -> Column:
    """An array of one array: the hashes of the n-word shingles of a text, in order. (The outer array binds the words once.)"""
    words = F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), F.lit(0))
    one = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.lower(F.array_join(F.slice(w, i, n), " "))))
    return F.transform(F.array(words), lambda w: F.when(F.size(w) >= n, one(w)).otherwise(F.array().cast("array<bigint>")))


def window_size(shingles: Column) -> Column:
    """The least power of two that is twice the shingles of a template, 8 at least."""
    return F.greatest(F.lit(8), F.pow(2, F.ceil(F.log2(2 * shingles)))).cast("int")


def band_table(templates: DataFrame, containment: float, n: int, miss: float) -> DataFrame:
    """(license, n_shingles, w, band, low, s) of templates(license, text): each band's least hash, and the shingle that has it."""
    sets = templates.where("license is not null").select("license", grams(F.col("text"), n)[0].alias("g")).where(F.size("g") > 0)
    sets = sets.select("license", F.array_distinct("g").alias("t"), window_size(F.size("g")).alias("w")).distinct()
    t = F.size("t")
    hit = F.least(F.lit(containment), F.lit(0.999)) * t / (t + F.col("w"))
    bands = F.ceil(F.lit(math.log(miss)) / F.log(1 - hit)).cast("int")
    each = sets.select("license", t.alias("n_shingles"), "w", "t", F.explode(F.sequence(F.lit(1), bands)).alias("band"))
    least = F.array_min(F.transform("t", lambda x: F.struct(F.xxhash64(x, "band").alias("low"), x.alias("s"))))
    return each.withColumn("m", least).select("license", "n_shingles", "w", "band", "m.low", "m.s")


def scan(documents: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, n: int = NGRAM, miss: float = MISS) -> DataFrame:
    """(doc_id, license, containment, n_matched, n_shingles, best) of templates(license, text) found in documents."""
    table = common.stored(band_table(templates, containment, n, miss), "bands")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = [F.xxhash64("doc_id", "text").alias("d1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("d2")]
    shingles = docs.select(*key, F.explode(grams(F.col("text"), n)[0]).alias("s"))
    minima = table.select("s").distinct()
    holding = shingles.join(common.maybe_broadcast(common.stored(minima, "minima")), "s").select("d1", "d2").distinct()
    holding = common.stored(holding, "holding").withColumnsRenamed({"d1": "e1", "d2": "e2"})
    keyed = docs.select("doc_id", "text", *key).join(common.maybe_broadcast(holding), (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left_semi")
    held = common.stored(keyed.dropDuplicates(["d1", "d2"]).select("d1", "d2", "doc_id", grams(F.col("text"), n)[0].alias("g")), "held")
    hits = held.select("d1", "d2", F.posexplode("g").alias("pos", "s")).join(common.maybe_broadcast(table), "s")
    step = F.col("w") / 2
    turn = F.floor(F.col("pos") / step)  # of the two windows that hold the position, counted in steps
    starts = F.transform(F.array(turn, F.greatest(turn - 1, F.lit(0).cast("long"))), lambda k: (k * step).cast("int"))
    windows = hits.select("d1", "d2", "license", "w", "band", "low", F.explode(starts).alias("at"))
    listed = windows.groupBy("d1", "d2").agg(F.collect_set(F.struct("license", "w", "band", "low", "at")).alias("windows"))  # a document's own windows
    meets = lambda x: F.forall(F.slice("g", x["at"] + 1, x["w"]), lambda y: F.xxhash64(y, x["band"]) >= x["low"])
    found = F.array_distinct(F.transform(F.filter("windows", meets), lambda x: x["license"]))
    pairs = common.stored(held.join(listed, ["d1", "d2"]).select("d1", "d2", "doc_id", "g", F.explode(found).alias("license")), "collisions")
    sets = templates.where("license is not null").select("license", F.array_distinct(grams(F.col("text"), n)[0]).alias("t")).where(F.size("t") > 0).distinct()
    both = pairs.join(common.maybe_broadcast(common.stored(sets, "templates")), "license")
    matched, size = F.size(F.array_intersect("t", "g")), F.size("t")
    found = both.select("d1", "d2", "doc_id", "license", F.round(matched / size, 6).alias("containment"), matched.alias("n_matched"), size.alias("n_shingles"))
    found = found.where(F.col("n_matched") / F.col("n_shingles") >= containment)
    rank = F.row_number().over(W.partitionBy("d1", "d2").orderBy(F.desc("containment"), F.desc("n_shingles"), "license"))
    return found.withColumn("best", rank == 1).drop("d1", "d2")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")
    return scan(common.read(spark, sf_dir, "documents"), templates)


_VALUES = ", ".join(f"('{k}', '{' '.join(re.findall('[A-Za-z0-9]+', v)).lower()}')" for k, v in TEMPLATES.items())
OP3_SQL = f"""
WITH t AS (SELECT license, unnest(list_distinct(list_transform(range(1, len(w) - {NGRAM - 2}), lambda i: array_to_string(w[i : i + {NGRAM - 1}], ' ')))) AS g FROM (SELECT license, string_split(words, ' ') AS w FROM (VALUES {_VALUES}) v(license, words))),
n AS (SELECT license, count(*) AS n_shingles FROM t GROUP BY license),
d AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - {NGRAM - 2}), lambda i: lower(array_to_string(w[i : i + {NGRAM - 1}], ' ')))) AS g FROM d)),
m AS (SELECT doc_id, license, count(*) AS n_matched FROM s JOIN t USING (g) GROUP BY doc_id, license),
f AS (SELECT doc_id, license, round(n_matched / n_shingles, 6) AS containment, CAST(n_matched AS INTEGER) AS n_matched, CAST(n_shingles AS INTEGER) AS n_shingles FROM m JOIN n USING (license) WHERE n_matched / n_shingles >= {CONTAINMENT})
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY containment DESC, n_shingles DESC, license) = 1 AS best FROM f
"""
