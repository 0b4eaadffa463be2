"""Licence scan by diagonal voting, in DataFrame operations only.

All word bigrams of all texts are joined to the bigram positions of the licence
templates (a fixed table). A match votes for its diagonal, text position less
template position; a place of a base phrase is a diagonal that has all the phrase's
votes. For notices, the votes of neighbouring diagonals (words put in or left out), up to a quarter of the template's length to either
side, are merged around each diagonal; a span counts if the merged votes cover enough of the template, and of spans
that overlap the best is kept. Words are compared besides their hashes, so votes are exact.

Defined results: null text is empty; repeated rows each get a row; rows are told apart
by doc_id and text, so equal ids do not mix. Extra columns are ignored. Lower-casing goes
by Spark's lower(): no letter outside A-Z can turn a word into a phrase word of the
base (none has k, and dotted I keeps its dot as a mark), which translate() of A-Z would not change.
"""

from __future__ import annotations

import re
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage_table

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Openings of public licence notices, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution": "cc-by",
}
KEY = ["doc_id", "text_hash", "n_words"]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def templates(base: dict[str, str], notices: dict[str, str]) -> list[tuple]:
    """(template, label, base, words, position, word, next word) of every template bigram."""
    out = []
    for n, (text, label) in enumerate([*base.items(), *notices.items()]):
        words = re.split(r"[^0-9a-z]+", text.lower())
        if not 2 <= len(words) <= 64:
            raise ValueError(f"a template has 2 to 64 words: {text!r}")
        out += [(n, label, n < len(base), len(words), i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return out


def drift_of(length: int) -> int:
    """Diagonals to either side that belong together, for a template of so many words."""
    return max(2, -(-length // 4))


def cast_votes(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """The votes of each (document, template, diagonal) as a mask, where they could count, and one row without template for each document."""
    spark = docs.sparkSession
    values = ", ".join(f"({n}, '{label}', {is_base}, {length}, {pos}, '{a}', '{b}')" for n, label, is_base, length, pos, a, b in templates(base, notices))
    table = F.broadcast(spark.sql(f"SELECT *, xxhash64(tw, tnext) AS h FROM VALUES {values} AS t(tmpl, label, is_base, length, tpos, tw, tnext)"))  # the template lists fix its size
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), SEPARATORS), "")
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words.alias("words"))
    # one more place, with no word, stands for the row itself
    grams = F.arrays_zip(F.concat("words", F.array(F.lit(""))).alias("w"), F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))).alias("next"))
    rows = cut.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.posexplode(grams).alias("pos", "gram"))
    rows = rows.select("doc_id", "text_hash", "n_words", "pos", F.col("gram.w").alias("w"), F.col("gram.next").alias("next")).withColumn("h", F.xxhash64("w", "next"))
    voted = rows.join(table, (rows.h == table.h) & (rows.w == table.tw) & (rows.next == table.tnext), "left")
    votes = voted.groupBy(*KEY, "tmpl", "label", "is_base", "length", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("mask"), F.count_if(F.col("w") == "").alias("copies")
    )
    full = F.bit_count("mask") == F.col("length") - 1
    return votes.where(F.col("tmpl").isNull() | ~F.col("is_base") | full)


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, coverage: float = 0.6) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    score: share of its template's bigrams that the best verified span has (1 for a base phrase); spans:
    (label, start, end in words, coverage) of all base places and verified notice spans.
    The votes, far fewer than the words, are written out, so that the texts are read once.
    """
    key = KEY
    votes = stage_table(cast_votes(docs, base, notices), "licence-votes")
    places = votes.where("tmpl IS NULL OR is_base").select(*key, "copies", F.when(F.col("tmpl").isNotNull(), F.struct("label", F.col("diagonal").cast("long").alias("start"), (F.col("diagonal") + F.col("length")).cast("long").alias("end"), F.lit(1.0).alias("coverage"))).alias("base"), F.lit(None).cast("struct<label:string,start:bigint,end:bigint,coverage:double>").alias("notice"))

    own = W.partitionBy(*key, "tmpl")
    drifts = {drift_of(t[3]) for t in templates(base, notices) if not t[2]} or {2}
    scale = lcm(*drifts)  # diagonals are scaled, so that one frame is as wide as each template's drift
    drift = F.greatest(F.lit(2), F.ceil(F.col("length") / 4)).cast("long")
    along = own.orderBy("scaled")
    least = F.lit(coverage) * (F.col("length") - 1)
    near = votes.where("NOT is_base").withColumn("all", F.sum(F.bit_count("mask")).over(own)).where(F.col("all") >= least)
    low, high = F.length(F.regexp_extract(F.bin("mask"), "0*$", 0)), F.length(F.bin("mask")) + 1
    near = near.withColumn("start", F.col("diagonal") + low).withColumn("end", F.col("diagonal") + high).withColumn("scaled", F.col("diagonal") * F.floor(F.lit(scale) / drift))
    about = along.rangeBetween(-scale, scale)
    near = near.select(*key, "tmpl", "label", "length", "scaled", F.bit_count(F.bit_or("mask").over(about)).alias("hits"), F.min("start").over(about).alias("start"), F.max("end").over(about).alias("end"))
    near = near.where(F.col("hits") >= least).withColumn("new", F.when(F.col("start") < F.lag("end").over(along), 0).otherwise(1))
    near = near.withColumn("band", F.sum("new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    best = F.max_by(F.struct("hits", "start", "end"), F.struct("hits", F.col("start") - F.col("end"), -F.col("start")))
    spans = near.groupBy(*key, "tmpl", "label", "length", "band").agg(best.alias("best")).select(*key, "label", "length", "best.*")
    spans = spans.withColumn("coverage", F.col("hits") / (F.col("length") - 1))
    spans = spans.select(*key, F.lit(0).cast("long").alias("copies"), F.lit(None).cast("struct<label:string,start:bigint,end:bigint,coverage:double>").alias("base"), F.struct("label", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "coverage").alias("notice"))

    joined = lambda c: F.array_join(F.array_sort(c), ",")
    out = places.unionByName(spans).groupBy(*key).agg(
        F.sum("copies").alias("copies"), F.count("base").alias("n_base"), F.min("base.start").alias("first_word"), F.max("base.start").alias("last_word"),
        joined(F.collect_set("base.label")).alias("base_labels"), joined(F.collect_set(F.coalesce("base.label", "notice.label"))).alias("labels"),
        F.coalesce(F.max(F.greatest("base.coverage", "notice.coverage")), F.lit(0.0)).alias("score"), F.array_sort(F.collect_list(F.coalesce("base", "notice"))).alias("spans"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy", "copies", "text_hash")
