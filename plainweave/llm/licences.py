"""Licence scan of a tree of files.

Every line of every file, and the whole text of licence files, is compared
with licence templates by the cosine of sparse TF-IDF vectors. Files without a
licence of their own inherit that of the nearest directory above them with a
licence file, by joins on directory paths. Only DataFrame functions are used.

A text holds a term or not (binary term frequency), so a vector is a set of
terms. In lines only terms of the templates can match; all others weigh like a term no
file has and count in the norm. Weights are integers of thousandths, hence the
same in every engine.

Real notices and licence texts span lines. They are compared with every run of
up to WINDOW paragraphs of a file's header (its leading comment, or the text of
a file without one) and with whole licence files; here every term weighs by the
number of files that have it. The better of line and block decides.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.llm.licence_texts import NOTICES, WHOLE
from plainweave.operators.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LICENCE_FILE = "(?i)^(licen[cs]e|copying|unlicense|notice)([-._].*)?$"
MIN_SCORE = 600_000  # millionths of cosine
UNIT = 1_000_000
WINDOW = 8  # paragraphs of the longest notice, with a copyright line and list items of their own
MARK = "^[ \\t]*(?:/\\*+|\\*+/?|//+|#+|;+|--+|%+|<!--|\"\"\")+"
TEXTS = [*NOTICES, *WHOLE.items()]

# Names of licences and the sentences that refer to them.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def terms(text: Column) -> Column:
    """Distinct runs of letters and digits, A-Z lower-cased."""
    found = F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+")
    return F.array_distinct(F.filter(found, lambda t: t != ""))


def template_terms(templates: dict[str, str]) -> dict[str, list[str]]:
    return {name: sorted(set(re.findall("[a-z0-9]+", text.lower()))) for name, text in templates.items()}


def weight(files: int, having: int) -> int:
    return round(1000 * math.log((1 + files) / (1 + having)))


def header(text: Column) -> Column:
    """The leading comment of a file, or all of it if it begins with none."""
    start = F.ltrim(F.regexp_replace(text, "^\\s*#![^\\n]*\\n", ""))
    start = F.regexp_replace(start, "^\\s+", "")
    lines = F.split(start, "\n")
    code = F.array_position(F.transform(lines, lambda x: ~(x.rlike(MARK) | (F.trim(x) == "") | (x == "\r"))), True)
    run = F.when(code > 0, F.array_join(F.slice(lines, F.lit(1), (code - 1).cast("int")), "\n")).otherwise(start)
    block = lambda mark, end: F.when(start.startswith(mark), F.substring_index(F.substring(start, len(mark) + 1, 2**31 - 1), end, 1))
    return F.coalesce(
        block("/*", "*/"), block("<!--", "-->"), block('"""', '"""'), F.when(start.rlike(MARK), run), start
    )


def blocks(files: DataFrame, texts: list[tuple[str, str]], min_score: int) -> DataFrame:
    """f, block_name and block_score of the files (f, text, is_licence) with a
    notice or licence text in a block of theirs.

    A block with the cosine c to a text shares terms of at least c * c of the
    text's squared norm with it, and so does the header around it: only headers
    that do are taken apart.
    """
    spark = files.sparkSession
    n_files = files.count()
    df = stage(files.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("files")))
    squared = lambda n: F.pow(F.round(1000 * (1 + F.log((1 + F.lit(n_files)) / (1 + F.coalesce(n, F.lit(0)))))), 2).cast("long")
    known = [(name, k, t) for k, (name, text) in enumerate(texts) for t in sorted(set(re.findall("[a-z0-9]+", text.lower())))]
    wanted = spark.createDataFrame(known, "block_name string, text_no int, term string")
    wanted = stage(wanted.join(df, "term", "left").select("block_name", "text_no", "term", squared(F.col("files")).alias("w")))
    norms = F.broadcast(wanted.groupBy("text_no").agg(F.sum("w").alias("text_norm")))  # one row per text
    asked = F.broadcast(wanted)  # the terms of the texts
    outer = files.select("f", "is_licence", F.when(F.col("is_licence"), F.col("text")).otherwise(header(F.col("text"))).alias("x"))
    able = stage(
        outer.select("f", F.explode(terms(F.col("x"))).alias("term")).join(asked, "term").groupBy("f", "text_no").agg(F.sum("w").alias("dot"))
        .join(norms, "text_no").where(F.col("dot") >= (min_score / UNIT) ** 2 * 0.999 * F.col("text_norm")).select("f").distinct()
    )
    taken = stage(outer.join(able, "f"))
    bare = F.regexp_replace(F.regexp_replace("x", "(?m)" + MARK, ""), "\r", "")
    paragraphs = F.filter(F.split(bare, "\n[ \t]*\n\\s*"), lambda x: x.rlike("[A-Za-z0-9]"))
    parts = taken.select("f", F.posexplode(paragraphs).alias("at", "x")).select("f", "at", F.explode(terms(F.col("x"))).alias("term"))
    # a paragraph lies in the blocks that begin up to WINDOW - 1 before it and reach it
    begins = parts.withColumn("first", F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - (WINDOW - 1)), F.col("at"))))
    inside = begins.withColumn("size", F.explode(F.sequence(F.col("at") - F.col("first") + 1, F.lit(WINDOW))))
    whole = taken.where("is_licence").select("f", F.lit(-1).alias("first"), F.lit(0).alias("size"), F.explode(terms(F.col("x"))).alias("term"))
    cut = inside.select("f", "first", "size", "term").distinct().unionByName(whole)
    key = ["f", "first", "size"]
    weighed = stage(cut.join(df, "term").select(*key, "term", squared(F.col("files")).alias("v")))
    of_block = weighed.groupBy(*key).agg(F.sum("v").alias("norm"))
    dots = weighed.join(asked, "term").groupBy(*key, "block_name", "text_no").agg(F.sum("w").alias("dot"))
    score = F.round(UNIT * F.col("dot") / (F.sqrt(F.col("norm").cast("double")) * F.sqrt(F.col("text_norm").cast("double")))).cast("long")
    scored = dots.join(of_block, key).join(norms, "text_no").select("f", "block_name", score.alias("s")).where(F.col("s") >= min_score)
    best = F.min(F.struct((-F.col("s")).alias("s"), "block_name"))
    return scored.groupBy("f").agg(best.alias("b")).select("f", "b.block_name", (-F.col("b.s")).alias("block_score"))


def scan(
    files: DataFrame,
    templates: dict[str, str] | None = None,
    path_col: str = "path",
    text_col: str = "text",
    min_score: int = MIN_SCORE,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """`files` (without their text) with licence, score (millionths, of its
    own licence), origin (own, inherited or null) and licence_path (the file it
    comes from).

    `templates` are compared with lines, `texts` (name, text) with blocks.

    The best line or block decides; of equal scores the first licence by name, of equal
    licence files the first by path. A null text has no licence, a null path is
    empty, rows that repeat a path are judged each on their own, an empty table
    gives an empty result; columns with the names of the new ones are replaced.
    """
    new = ("licence", "score", "origin", "licence_path")
    keep = [c for c in files.columns if c not in (*new, text_col)]
    known = template_terms(templates or TEMPLATES)
    vocabulary = sorted({t for ts in known.values() for t in ts})
    words = F.array(*[F.lit(t) for t in vocabulary])
    path = F.coalesce(F.col(path_col), F.lit(""))
    is_licence = F.element_at(F.split(path, "/"), -1).rlike(LICENCE_FILE)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n")
    parts = F.when(is_licence, F.concat(lines, F.array(text))).otherwise(lines)
    hits = F.transform(
        F.transform(parts, terms),
        lambda t: F.struct(F.array_intersect(t, words).alias("hits"), F.size(t).alias("n")),
    )
    lined = stage(
        files.select(
            *[F.col(c).alias(f"k_{c}") for c in keep], path.alias("path"), is_licence.alias("is_licence"),
            text.alias("text"), F.monotonically_increasing_id().alias("f"),
            F.filter(hits, lambda h: F.size(h["hits"]) > 0).alias("lines"),
        )
    )
    in_file = F.explode(F.array_distinct(F.flatten(F.transform("lines", lambda h: h["hits"]))))
    having = dict(  # at most the vocabulary of the templates
        tuple(r) for r in lined.select(in_file.alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect()
    )
    n_files = lined.count()
    squares = {t: max(1, weight(n_files, having.get(t, 0))) ** 2 for t in vocabulary}
    other = max(1, weight(n_files, 0)) ** 2
    squared = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, squares[t])])

    def total(found: Column) -> Column:
        return F.aggregate(found, F.lit(0).cast("long"), lambda a, t: a + F.element_at(squared, t))

    # a line cannot reach the score if too little of its norm is in known terms
    least = (min_score / UNIT) ** 2
    normed = F.transform(
        "lines",
        lambda h: F.struct(
            h["hits"].alias("hits"), total(h["hits"]).alias("own"),
            ((h["n"] - F.size(h["hits"])).cast("long") * F.lit(other)).alias("rest"),
        ),
    )
    able = F.filter(normed, lambda h: h["own"] >= least * (h["own"] + h["rest"]) * 0.999)
    ranked = sorted(known, reverse=True)
    options = F.array(*[
        F.struct(
            F.lit(k).alias("rank"), F.array(*[F.lit(t) for t in known[name]]).alias("terms"),
            F.lit(sum(squares[t] for t in known[name])).cast("long").alias("norm"),
        )
        for k, name in enumerate(ranked)
    ])
    scored = F.flatten(F.transform(
        able,
        lambda h: F.transform(options, lambda o: F.struct(
            F.round(
                UNIT * total(F.array_intersect(h["hits"], o["terms"]))
                / (F.sqrt((h["own"] + h["rest"]).cast("double")) * F.sqrt(o["norm"].cast("double")))
            ).cast("long").alias("score"),
            o["rank"].alias("rank"),
        )),
    ))
    best = F.array_max(F.filter(scored, lambda s: s["score"] >= min_score))
    names = F.array(*[F.lit(n) for n in ranked])
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    found = stage(blocks(lined.select("f", "text", "is_licence"), TEXTS if texts is None else texts, min_score))
    by_line = lined.withColumn("best", best).select(
        *[f"k_{c}" for c in keep], "path", "is_licence", "f", directory.alias("dir"),
        F.when(F.col("best").isNotNull(), F.get(names, F.col("best.rank"))).alias("line_name"), F.col("best.score").alias("line_score"),
    )
    line, block = F.struct((-F.col("line_score")).alias("s"), F.col("line_name").alias("n")), F.struct((-F.col("block_score")).alias("s"), F.col("block_name").alias("n"))
    better = F.least(F.when(F.col("line_name").isNotNull(), line), F.when(F.col("block_name").isNotNull(), block))
    judged = stage(
        by_line.join(found, "f", "left").withColumn("better", better).select(
            *[f"k_{c}" for c in keep], "path", "is_licence", "dir", F.col("better.n").alias("own"), (-F.col("better.s")).alias("score"),
        )
    )
    # of a directory's licence files the best, then the first by name and path
    first = F.min(F.struct((-F.col("score")).alias("s"), "own", "path"))
    given = stage(
        judged.where(F.col("is_licence") & F.col("own").isNotNull()).groupBy("dir").agg(first.alias("f"))
        .select(F.col("dir").alias("above"), F.col("f.own").alias("given"), F.col("f.path").alias("given_path"))
    )
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    climbed = judged.select("dir").distinct().select("dir", F.posexplode(above).alias("depth", "above"))
    nearest = stage(
        climbed.join(given, "above").groupBy("dir")
        .agg(F.max(F.struct("depth", "given", "given_path")).alias("g"))
        .select("dir", "g.given", "g.given_path")
    )
    own = F.col("own").isNotNull()
    return judged.join(nearest, "dir", "left").select(
        *[F.col(f"k_{c}").alias(c) for c in keep],
        F.coalesce("own", "given").alias("licence"), "score",
        F.when(own, "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
        F.when(own, F.col("path")).otherwise(F.col("given_path")).alias("licence_path"),
    )
