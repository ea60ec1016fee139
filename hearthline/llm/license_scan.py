"""License scan by diagonal voting; DataFrame functions only.

All rolling word k-grams of all texts are joined by hash to the places where they stand in license
templates. A match votes for the diagonal ``place in text - place in template``. Votes of one text and
template whose diagonals lie close together (words put in or left out) are merged, and the merged
span is verified: the matched words themselves are equal, the votes cover enough of the template's
k-grams, and the span in the text is not much longer than the template.

The templates are a short list; their side of the join is counted and broadcast, and no text or
k-gram is shuffled but for the few matches. With a list beyond ``Settings.broadcast_rows`` k-grams Spark
chooses the join.

Defined results: a null or empty text has no words, no label and score 0; repeated rows get equal
results, as votes are distinct per id and text; a null id is an id. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that name a license.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, and wording by which a text is put under that license.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)


@dataclass(frozen=True)
class Settings:
    k: int = 3  # words of a k-gram
    slack: int = 2  # diagonals this far apart are neighbours
    coverage: float = 0.6  # of a template's k-grams
    stretch: float = 1.5  # of a span against its template
    broadcast_rows: int = 100_000  # k-grams of all templates; beyond, the join is left to Spark


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _grams(words: str, k: int) -> Column:
    """Hash and words of each k-gram."""
    places = f"if(size({words}) >= {k}, sequence(0, size({words}) - {k}), cast(array() as array<int>))"
    parts = [f"get({words}, i + {j})" for j in range(k)]
    fields = ", ".join(f"'g{j}', {p}" for j, p in enumerate(parts))
    return F.expr(f"transform({places}, i -> named_struct('h', xxhash64({', '.join(parts)}), {fields}))")


def template_places(spark, templates, settings: Settings) -> DataFrame:
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, label string, text string")
    frame = frame.select("template", "label", words_of(F.col("text")).alias("w"))
    frame = frame.select("template", "label", F.size("w").alias("length"), F.posexplode(_grams("w", settings.k)).alias("t_at", "t"))
    return frame.select(
        "template", "label", "length", "t_at", F.col("t.h").alias("t_h"), *[F.col(f"t.g{j}").alias(f"t_g{j}") for j in range(settings.k)]
    )


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text", templates=TEMPLATES, settings: Settings = Settings()) -> DataFrame:
    """Verified spans: ``id, text_hash, label, template, first_word, last_word, coverage``."""
    words = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("w"))
    every = words.select("id", "text_hash", F.posexplode(_grams("w", settings.k)).alias("at", "g"))
    every = every.select("id", "text_hash", "at", *[F.col(f"g.{n}").alias(n) for n in ("h", *[f"g{j}" for j in range(settings.k)])])
    places = template_places(docs.sparkSession, templates, settings)
    if places.count() <= settings.broadcast_rows:
        places = F.broadcast(places)
    same = F.col("h") == F.col("t_h")
    for j in range(settings.k):
        same &= F.col(f"g{j}") == F.col(f"t_g{j}")
    votes = every.join(places, same).select("id", "text_hash", "template", "label", "length", "at", "t_at").distinct()
    votes = votes.withColumn("diagonal", F.col("at") - F.col("t_at"))
    own = ["id", "text_hash", "template", "label", "length"]
    along = Window.partitionBy(*own).orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > settings.slack, F.lit(True))
    votes = votes.withColumn("new", new.cast("int"))
    votes = votes.withColumn("run", F.sum("new").over(along.rangeBetween(Window.unboundedPreceding, 0)))
    merged = votes.groupBy(*own, "run").agg(
        F.count_distinct("t_at").alias("covered"), F.min("at").alias("first_word"), (F.max("at") + settings.k - 1).alias("last_word")
    )
    covered = F.col("covered") / (F.col("length") - settings.k + 1)
    long = F.col("last_word") - F.col("first_word") + 1
    return merged.withColumn("coverage", covered).where(
        (covered >= settings.coverage) & (long <= settings.stretch * F.col("length"))
    ).select("id", "text_hash", "label", "template", "first_word", "last_word", "coverage")


def _phrase_places(words: str, phrase: str) -> Column:
    parts = phrase.split(" ")
    test = " and ".join(f"get({words}, i + {j}) = '{p}'" for j, p in enumerate(parts))
    return F.expr(
        f"if(array_contains({words}, '{parts[-1]}') and size({words}) >= {len(parts)}, "
        f"filter(sequence(0, size({words}) - {len(parts)}), i -> {test}), cast(array() as array<int>))"
    )


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES,
         settings: Settings = Settings()) -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""
    base = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("w"))
    found = {f"p{i}": _phrase_places("w", p) for i, p in enumerate(phrases)}
    base = base.select("id", "text_hash", F.size("w").alias("n_words"), *[c.alias(n) for n, c in found.items()])
    every = F.concat(*[F.col(n) for n in found])
    named = F.filter(
        F.array(*[F.when(F.size(n) > 0, F.lit(v)) for n, v in zip(found, phrases.values())]), lambda x: x.isNotNull()
    )
    base = base.select(
        "id", "text_hash", F.col("n_words").cast("long"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(named)).alias("base"),
    )
    more = spans(docs, id, text, templates, settings).groupBy("id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("coverage").alias("best")
    ).select(F.col("id").alias("m_id"), F.col("text_hash").alias("m_hash"), "more", "best")
    none = F.expr("cast(array() as array<string>)")
    joined = base.join(more, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left")
    return joined.select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
