"""License scans: notices by TF-IDF cosine to templates, then inheritance along directories.

Built-in functions only. Lines that may state a licence are taken from the whole texts and
compared as sparse vectors; a file without a licence of its own has that of the licence file in its
nearest ancestor directory, found by joining paths with their ancestors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import settle

LEAST_COSINE = 0.55
# A file is a licence file by its name, or if at least this share of its characters is in licence lines.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)^(?:licen[sc]e|copying|unlicense)(?:[._-].*)?$"
MARKER = (
    r"(?i)licen[sc]e|copyright|all rights reserved|permission is hereby granted|redistribution and use"
    r"|public domain|spdx|free software|without warranty|cc[ -]by|cc0"
)

# Sentences of public licences and of common notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the 3-clause BSD License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved"),
]


def _terms(line: Column) -> Column:
    """Lower-case runs of letters and digits; a version's parts are terms of their own."""
    return F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _counted(rows: DataFrame, keys: list[str], line: str) -> DataFrame:
    return rows.select(*keys, F.explode(_terms(F.col(line))).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def notices(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, chars, line_no, line) of the lines that may state a licence; chars of the whole file."""
    own = files.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).cast("string").alias("_t"))
    own = own.where(F.col("_t").rlike(MARKER))
    marked = F.filter(
        F.transform(F.split("_t", "\n"), lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))), lambda x: x["line"].rlike(MARKER)
    )
    return own.select("path", F.length("_t").alias("chars"), F.inline(marked))


def match(found: DataFrame) -> DataFrame:
    """(path, chars, line_no, line, licence, cosine): the template nearest to each line, from LEAST_COSINE on.

    Weights are tf * (ln((1 + lines) / (1 + lines with the term)) + 1), counted over all lines of `found` (stored,
    as it is read several times). Of equal cosines the licence that sorts first is taken.
    """
    spark: SparkSession = found.sparkSession
    keys = ["path", "line_no", "line"]
    distinct = found.select("line").distinct()
    terms = _counted(distinct, ["line"], "line")
    total = found.count()
    held_by = terms.join(found.groupBy("line").count(), "line").groupBy("term").agg(F.sum("count").alias("df"))
    idf = held_by.select("term", (F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    templates = spark.createDataFrame(TEMPLATES, "licence string, words string")
    known = _counted(templates, ["licence", "words"], "words")
    known = known.join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(1.0) + F.log(F.lit(1.0 + total))))
    # A few hundred rows, as many as the templates have words.
    known = F.broadcast(known.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("words")))).select("licence", "words", "term", F.col("w").alias("tw"), "norm"))
    weighed = terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    lengths = weighed.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighed.join(known, "term").groupBy("line", "licence", "words").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.first("norm").alias("norm"))
    scored = dots.join(lengths, "line").withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 9))
    best = scored.where(F.col("cosine") >= LEAST_COSINE).groupBy("line").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    best = best.select(F.col("line").alias("_line"), F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))
    return found.join(best, F.col("line") == F.col("_line")).select(*keys, "chars", "licence", "cosine")


def _directory(path: Column) -> Column:
    """What stands before the last slash; the root is empty."""
    return F.regexp_replace(F.regexp_replace(path, r"[^/]*$", ""), "/+$", "")


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, licence, cosine, how, stated_in) of every file.

    how: 'stated' if a line of the file states a licence (the best line counts, then the earliest),
    'inherited' from the licence file of the nearest directory at or above its own (stated_in), else null.
    A licence file has such a name, or consists of licence lines for the most part; of several
    in one directory the best line counts. Null paths are the empty path, null and empty texts
    state nothing, and files of one path share what any of them states. Whole texts are read; repeated rows
    come back as often as they are there; an empty table gives an empty result.
    """
    found = settle(notices(files, path, text))
    stated = settle(match(found))
    order = F.struct((-F.col("cosine")).alias("c"), F.col("line_no").alias("n"), "licence")
    own = stated.groupBy("path").agg(
        F.min(order).alias("b"), F.sum(F.length("line")).alias("in_lines"), F.max("chars").alias("chars")
    )
    own = own.select("path", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"), (F.col("in_lines") >= FILE_SHARE * F.col("chars")).alias("whole"))
    is_file = F.col("whole") | F.element_at(F.split("path", "/"), -1).rlike(FILE_NAME)
    of_dir = own.where(is_file).groupBy(_directory(F.col("path")).alias("at")).agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("d")
    ).select("at", F.col("d.licence").alias("dir_licence"), (-F.col("d.c")).alias("dir_cosine"))

    every = files.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path")).withColumn("dir", _directory(F.col("path")))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    climbed = every.select("dir").distinct().select("dir", F.explode(F.array_distinct(ancestors)).alias("up"))
    nearest = climbed.join(of_dir, F.col("up") == F.col("at")).groupBy("dir").agg(
        F.max(F.struct(F.length("up").alias("n"), "up", "dir_licence", "dir_cosine")).alias("a")
    ).select(F.col("dir").alias("_dir"), "a.up", "a.dir_licence", "a.dir_cosine")

    done = every.join(own.select(F.col("path").alias("_path"), "licence", "cosine"), F.col("path") == F.col("_path"), "left")
    done = done.join(nearest, F.col("dir") == F.col("_dir"), "left")
    here = F.col("licence").isNotNull()
    return done.select(
        "path",
        F.coalesce("licence", "dir_licence").alias("licence"),
        F.when(here, F.col("cosine")).otherwise(F.col("dir_cosine")).alias("cosine"),
        F.when(here, "stated").when(F.col("dir_licence").isNotNull(), "inherited").alias("how"),
        F.when(here, F.col("dir")).otherwise(F.col("up")).alias("stated_in"),
    )
