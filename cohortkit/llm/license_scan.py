"""License scans: cosine of lines to templates, then inheritance by directory.

Every line of a file is a candidate header.  Lines and templates are sparse
TF-IDF vectors over lower-cased words, with document frequencies over all files;
a line is the licence of the template it is most alike to, if the cosine is at
least ``threshold``.  Lines without any of the templates' telling words can't
reach it and are left out first: by Cauchy-Schwarz the cosine is at most the
norm of the shared part of the template over its norm, so the most frequent
template words are dropped as filters only while what is left out stays
below the threshold for every template.

A file is a licence file of its directory if at least ``file_share`` of its
words stand in licence lines.  A file without a licence of its own inherits
from the nearest ancestor directory that has a licence file (the best line's
licence; ties by licence name and path).  Files meet directories by equi-joins on the paths
of their ancestors, salted, as one directory may hold a third of all files.

Native.  Collected: counts of the templates' words only.  Defined results: null
texts have no licence, null paths inherit nothing; repeated rows are files of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written

__all__ = ["scan", "TEMPLATES"]

# Usual licence header lines.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
}

_SALTS = 32


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def scan(files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75, file_share: float = 0.5) -> DataFrame:
    """One row for each file: its id, ``path``, ``own`` licence and ``cosine``,
    ``is_license_file``, and ``license`` with the directory it is inherited from
    (``from_dir``; null for an own one)."""
    base = files.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), path.alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    terms = {name: Counter(re.findall(r"[^\W_]+", text.lower())) for name, text in TEMPLATES.items()}
    vocabulary = sorted(set().union(*terms.values()))
    df = written(base.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "license-df")
    n = base.count()
    idf = {t: math.log((1 + n) / 1.0) + 1 for t in vocabulary}
    idf |= {r.term: math.log((1 + n) / (1 + r.df)) + 1 for r in df.where(F.col("term").isin(vocabulary)).collect()}
    vectors = {name: {t: c * idf[t] for t, c in tf.items()} for name, tf in terms.items()}
    norms = {name: math.sqrt(sum(w * w for w in v.values())) for name, v in vectors.items()}
    left_out: set[str] = set()
    for t in sorted(vocabulary, key=lambda t: idf[t]):  # the most frequent first
        tried = left_out | {t}
        if all(math.sqrt(sum(v[x] ** 2 for x in tried if x in v)) < threshold * norms[name] for name, v in vectors.items()):
            left_out = tried
    telling = [t for t in vocabulary if t not in left_out]
    lines = base.select("row", F.posexplode(F.split("text", "\n")).alias("line", "text")).where(F.lower("text").rlike(r"(?<![\p{L}\p{N}])(" + "|".join(telling) + r")(?![\p{L}\p{N}])"))
    tf = lines.select("row", "line", F.explode(_words(F.col("text"))).alias("term")).groupBy("row", "line", "term").agg(F.count(F.lit(1)).alias("tf"))
    weight = F.col("tf") * (F.log((F.lit(1.0) + n) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    weighed = written(tf.join(df, "term", "left").withColumn("w", weight), "license-terms")
    spark = files.sparkSession
    sides = spark.createDataFrame([(name, t, w / norms[name]) for name, v in vectors.items() for t, w in v.items()], "license string, term string, u double")
    dots = weighed.join(F.broadcast(sides), "term").groupBy("row", "line", "license").agg(F.sum(F.col("w") * F.col("u")).alias("dot"))
    lengths = weighed.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("n_words"))
    alike = dots.join(lengths, ["row", "line"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= threshold)
    best = alike.groupBy("row", "line", "n_words").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"))
    own = best.groupBy("row").agg(F.min("best").alias("best"), F.sum("n_words").alias("license_words"))
    sized = base.select("row", "id", "path", F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")).alias("n_words"))
    file = sized.join(own, "row", "left").select("row", "id", "path", F.col("best.license").alias("own"), (-F.col("best.less")).alias("cosine"),
                                                 F.coalesce(F.col("license_words") >= F.col("n_words") * file_share, F.lit(False)).alias("is_license_file"))
    file = written(file.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")), "license-files")
    dirs = file.where("is_license_file and path is not null").groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "own", "path")).alias("best")).select("dir", F.col("best.own").alias("found"))
    salted = dirs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    pieces = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, F.lit(1), i), "/"))
    open_files = file.where("own is null and path is not null").select("row", F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int").alias("salt"), F.explode(F.array_distinct(ups)).alias("dir"))
    near = open_files.join(salted, ["dir", "salt"]).groupBy("row").agg(F.max_by(F.struct("found", "dir"), F.length("dir")).alias("near"))
    out = file.join(near, "row", "left")
    return out.select(F.col("id").alias(id_col), "path", "own", "cosine", "is_license_file", F.coalesce("own", "near.found").alias("license"), F.col("near.dir").alias("from_dir"))
