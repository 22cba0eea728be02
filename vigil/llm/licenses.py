"""License scans by a positional index of rare words.  DataFrame functions only.

A template is a licence notice with its label and the phrases that it must keep.  Of its words the
``per_template`` ones that the fewest documents hold are indexed with all their positions, and so is the
rarest word of each key phrase.  A file's ``file_words`` highest-IDF index words are looked up, at all their positions; a word at place p
of the file and place t of a template votes for the notice starting at p - t.  A start is taken if at least
``least`` of the template's indexed places (all of them, if it has fewer) agree on it and every key phrase stands
word by word at its place.  The vote's share of the indexed places is the score of the finding.

Frequencies are those of the whole corpus; the index holds a few words per template, so it is broadcast.  Words
that are not in it never leave the scan, and no text is shuffled: a key phrase is compared with the words around its rarest word
where that word is found.

Base labels come from phrases alone: a place is a run of consecutive words equal to the phrase's.

Defined results: null text is empty; an empty text has no words, places or labels and score 0; a base
place without a template's finding scores ``BASE_SCORE``; repeated rows each get their row; a row with a null id is a document like others;
an empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
#: Phrases whose places are the base labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
BASE_SCORE = 0.5

# Fixed values: (name, label, words of the notice, key phrases).  Wording of the public licence notices.
TEMPLATES = (
    ("mit-notice", "mit", "released under the mit license", ("mit license",)),
    ("mit-text", "mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("apache-notice", "apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-text", "apache",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
     "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
     "under the license is distributed on an as is basis without warranties or conditions of any kind",
     ("except in compliance with the license", "apache org licenses license 2 0")),
    ("gpl-notice", "gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    ("gpl-text", "gpl",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version",
     ("gnu general public license", "free software foundation")),
    ("lgpl-text", "lgpl",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation", ("gnu lesser general public license",)),
    ("agpl-text", "agpl",
     "it under the terms of the gnu affero general public license as published by the free software foundation",
     ("gnu affero general public license",)),
    ("bsd-text", "bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl-text", "mpl",
     "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc-text", "isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("for any purpose with or without fee",)),
    ("cc-by-nc-notice", "cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa-notice", "cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("unlicense-text", "unlicense",
     "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("boost-text", "boost",
     "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license", ("any person or organization obtaining",)),
    ("zlib-text", "zlib",
     "this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software", ("without any express or implied warranty",)),
)


def lower_text(text: str) -> Column:
    """The text in lower case.  Words are compared with ASCII words alone, so the case of other letters is of no
    account, but for the one letter whose lower case is in a-z: the Kelvin sign, which gives way to a letter that has no case."""
    return F.lower(F.replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit("\u212a"), F.lit("\u0138")))


def words(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def phrase_places(found: Column, lowered: Column, phrase: str) -> Column:
    """Places (words from 0) at which the phrase's words stand consecutively; ``lowered``: the text, or those of its words that matter here."""
    parts = phrase.split()
    k = len(parts)
    # the last word is compared first; texts without the phrase's longest word are not walked
    here = lambda i: F.forall(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(parts[j]).alias("w")) for j in range(k - 1, -1, -1)]),
                              lambda x: F.get(found, i + x["j"]) == x["w"])
    walk = F.filter(F.sequence(F.lit(0), F.size(found) - k), lambda i: (F.get(found, i + (k - 1)) == parts[-1]) & here(i))
    none = F.array().cast("array<int>")
    return F.when((F.size(found) >= k) & F.contains(lowered, F.lit(max(parts, key=len))), walk).otherwise(none)


def template_words(spark: SparkSession) -> DataFrame:
    """(template, label, t, word, phrase, at): every word of every template; where it belongs to a key phrase, the
    phrase's words and its place in it (a word of several phrases has a row for each)."""
    rows = []
    for name, label, text, phrases in TEMPLATES:
        tokens = text.split()
        where = []
        for ph in phrases:
            p = ph.split()
            where.append((next(i for i in range(len(tokens)) if tokens[i:i + len(p)] == p), p))
        for t, word in enumerate(tokens):
            hold = [(f"'{' '.join(p)}'", t - first) for first, p in where if first <= t < first + len(p)] or [("null", "null")]
            rows += [f"('{name}', '{label}', {t}, '{word}', {p}, {at})" for p, at in hold]
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS x(template, label, t, word, phrase, at)")
    return table.withColumn("phrase", F.split("phrase", " "))


def rare_index(found: DataFrame, per_template: int) -> DataFrame:
    """(template, label, t, word, df, phrase, at, places, phrases): positions of each template's rarest words,
    by the documents of ``found`` (column ``words``) that hold them.  ``phrase`` is set at its rarest word alone."""
    tw = template_words(found.sparkSession)
    vocabulary = F.broadcast(tw.select("word").distinct())
    df = (found.select(F.explode(F.array_distinct("words")).alias("word")).join(vocabulary, "word")
          .groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    full = tw.join(F.broadcast(df), "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarest = F.dense_rank().over(Window.partitionBy("template").orderBy("df", F.length("word").desc(), "word"))
    in_phrase = F.row_number().over(Window.partitionBy("template", "phrase").orderBy("df", F.length("word").desc(), "word", "t"))
    ranked = full.select("*", (rarest <= per_template).alias("rare"), ((in_phrase == 1) & F.col("phrase").isNotNull()).alias("key"))
    whole = Window.partitionBy("template")
    kept = (ranked.where(F.col("rare") | F.col("key"))
            .select("template", "label", "t", "word", "df", F.when(F.col("key"), F.col("phrase")).alias("phrase"),
                    F.when(F.col("key"), F.col("at")).alias("at")).distinct())
    return kept.select("*", F.size(F.collect_set("t").over(whole)).alias("places"), F.size(F.collect_set("phrase").over(whole)).alias("phrases"))


def findings(found: DataFrame, *, per_template: int = 4, file_words: int = 64, least: int = 3) -> DataFrame:
    """(key, template, label, start, score): notices verified in the files of ``found`` (key, words)."""
    index = rare_index(found, per_template)
    placed = F.slice(F.col("words"), F.greatest(F.col("pos") - F.col("at") + 1, F.lit(1)), F.size("phrase"))
    kept = F.when(F.col("phrase").isNotNull(), (F.col("pos") >= F.col("at")) & (placed == F.col("phrase")))
    # a hit votes for the start pos - t; its key phrase is compared on the spot
    hits = (found.select("key", "words", F.posexplode("words").alias("pos", "word")).join(F.broadcast(index), "word")
            .select("key", "word", "df", "template", "label", "t", (F.col("pos") - F.col("t")).alias("start"), "places", "phrases",
                    F.when(kept, F.col("phrase")).alias("phrase"))
            .groupBy("key", "word", "df", "template", "label", "start", "places", "phrases")
            .agg(F.collect_set("t").alias("ts"), F.collect_set("phrase").alias("ps")))
    highest = F.dense_rank().over(Window.partitionBy("key").orderBy("df", "word"))
    starts = (hits.withColumn("nth", highest).where(F.col("nth") <= file_words)
              .groupBy("key", "template", "label", "start", "places", "phrases")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("votes"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("ps")))).alias("verified")))
    return (starts.where((F.col("votes") >= F.least(F.lit(least), F.col("places"))) & (F.col("verified") == F.col("phrases")))
            .select("key", "template", "label", "start", (F.col("votes") / F.col("places")).alias("score")))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", per_template: int = 4, file_words: int = 64,
         least: int = 3) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``base`` (places by label), ``base_labels``, ``notices`` (verified
    template, start and score), ``labels`` and ``score``."""
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), lower_text(text).alias("lowered"))
    # a text and its id name a file; equal rows have equal findings
    longest = F.array(*[F.lit(max(phrase.split(), key=len)) for phrase, _ in BASE])
    base = base.select(F.struct("doc_id", F.md5("lowered").alias("digest")).alias("key"), words(F.col("lowered")).alias("words"),
                       F.array_join(F.filter(longest, lambda w: F.contains("lowered", w)), " ").alias("near"))
    # the words are taken once and written: frequencies, votes, places and counts read the list
    base = written(base, "words")
    hits = findings(base.select("key", "words"), per_template=per_template, file_words=file_words, least=least)
    notices = hits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "template", "score"))).alias("notices"),
                                      F.collect_set("label").alias("more"), F.max("score").alias("best"))
    places = base.select("key", F.size("words").cast("long").alias("n_words"), F.filter(F.array(*[
        F.struct(F.lit(label).alias("label"), phrase_places(F.col("words"), F.col("near"), phrase).alias("places"))
        for phrase, label in BASE]), lambda x: F.size(x["places"]) > 0).alias("base"))
    named = lambda c: F.array_sort(F.array_distinct(c))
    base_labels = named(F.transform("base", lambda x: x["label"]))
    more = F.coalesce("more", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)))
    joined = places.withColumn("_k", F.struct("key")).join(notices.withColumn("_k", F.struct("key")).drop("key"), "_k", "left")
    return joined.select("key.doc_id", "n_words", "base", base_labels.alias("base_labels"),
                         F.coalesce("notices", F.array().cast("array<struct<start:int,template:string,score:double>>")).alias("notices"),
                         named(F.concat(base_labels, more)).alias("labels"), score.alias("score"))
