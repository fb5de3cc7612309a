"""License scans by diagonal voting over rolling hashes of word grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.words import Words, find_words, grams, id_type, map_texts

#: Phrases whose every place counts, and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Well-known sentences of licenses and notices, and their labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved"),
)

#: Grams of these words alone stand everywhere and give no vote.
COMMON = frozenset("a and any are as at be by for in is it of on or that the this to under with you".split())

#: Words of a gram: of phrases and short templates, and of templates of LONG words or more.
GRAM, LONG_GRAM, LONG = 2, 3, 12
#: Diagonals so far apart, in words, are one place with words put in or left out; a place is no longer than that.
NEIGHBOUR = 2
#: Share of a template's voting grams, in the template's order, from which a place is a match.
COVERAGE = 0.85


def words_of(text: str) -> list[str]:
    return find_words(pa.array([text])).strings().to_pylist()


def gram_rows(phrases=PHRASES, templates=TEMPLATES) -> list[tuple[int, str, bool, int, str, int, int]]:
    """(template, label, base, at, gram, all voting grams, words of a gram) of each voting gram of each phrase and template."""
    rows = []
    for n, (label, text, base) in enumerate([*((label, text, True) for label, text in phrases), *((label, text, False) for label, text in templates)]):
        words = words_of(text)
        k = LONG_GRAM if not base and len(words) >= LONG else GRAM
        places = [i for i in range(len(words) - k + 1) if base or not set(words[i : i + k]) <= COMMON]
        rows += [(n, label, base, i, " ".join(words[i : i + k]), len(places), k) for i in places]
    return rows


def rolled(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of each k words in a row of one text, the hash rolled from the words' hashes."""
    if len(w.doc) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = np.flatnonzero(w.doc[: len(w.doc) - k + 1] == w.doc[k - 1 :])
    return whole, grams(w.hashes(), k)[whole]


def template_grams(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """gram_rows() with their hashes as a table of fixed size, a few hundred rows."""
    rows = [(*r, int(rolled(find_words(pa.array([r[4]])), r[6])[1].view(np.int64)[0])) for r in gram_rows(phrases, templates)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, at int, t_gram string, votes_all int, k int, t_hash long").drop("k")


def word_grams(docs: DataFrame, known: list[tuple[int, int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, pos, hash, gram, n_words): the rolling hash of every run of words of each known length with its place,
    and for each row of docs one without a hash that has its number of words. text_key is a hash of the text; it tells rows
    with one id apart. known: (words, hash) of templates' grams; of runs with such a hash the words come along, to be compared.
    """
    spelled = {k: np.unique(np.array([h for n, h in known if n == k], dtype=np.int64).view(np.uint64)) for k in sorted({n for n, _ in known})}

    def make():
        def f(ids: pa.Array, texts: pa.Array) -> list:
            keys = np.array([xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "surrogatepass")) for t in texts.to_pylist()], dtype=np.uint64).view(np.int64)
            n, w, doc, pos, hashes, rows, strings = len(ids), find_words(texts), [], [], [], [], []
            words = None
            for k, own in spelled.items():
                whole, h = rolled(w, k)
                met = np.flatnonzero(np.isin(h, own))
                if words is None and len(met):
                    words = w.strings()
                rows.append(met + n + sum(map(len, hashes)))
                strings += [" ".join(words[i : i + k].to_pylist()) for i in whole[met].tolist()]
                doc.append(w.doc[whole])
                pos.append(whole - w.first[w.doc[whole]])
                hashes.append(h)
            doc, more = np.concatenate([np.arange(n), *doc]), sum(map(len, hashes))
            spots = np.full(n + more, -1, dtype=np.int64)
            spots[np.concatenate(rows)] = np.arange(len(strings))
            spelt = pa.array(strings, pa.string()).take(pa.array(spots, mask=spots < 0))
            keyed = pa.array(np.concatenate([np.zeros(n, np.uint64), *hashes]).view(np.int64), mask=np.arange(n + more) < n)
            return [ids.take(pa.array(doc)), keys[doc], np.concatenate([np.full(n, -1), *pos]).astype(np.int32), keyed, spelt, pa.concat_arrays([pa.array(w.counts.astype(np.int64)), pa.nulls(more, pa.int64())])]

        return f

    fields = [("doc_id", id_type(docs, id_col)), ("text_key", T.LongType()), ("pos", T.IntegerType()), ("hash", T.LongType()), ("gram", T.StringType()), ("n_words", T.LongType())]
    return map_texts(docs, fields, make, id_col, text_col)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License phrases and templates in every row of docs.

    Every rolling hash of GRAM and of LONG_GRAM words is joined with those of the templates' positions, and the words of a
    hit are compared. Votes are gathered on each diagonal (the gram's place less its place in the template). A phrase stands
    where one diagonal has all its grams. For templates, each diagonal is merged with those up to NEIGHBOUR after it, so a
    place is at most that much longer or shorter than the template, and is verified: a voting gram counts if its first
    place there comes after those of all grams before it in the template, and COVERAGE of them have to count.

    Columns: doc_id, n_words, n_base (places of phrases), first_word, last_word (their least and greatest first word, else
    null), base_labels, labels (with the templates'; both distinct, sorted, comma-joined), score (the best place's share of
    votes, 0 if none). A null or empty text has no words and no labels; ids may be null; repeated rows give repeated rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    table = template_grams(spark, phrases, templates)
    known = [(len(r[0].split(" ")), r[1]) for r in table.select("t_gram", "t_hash").collect()]  # of the fixed lists above
    key = ["doc_id", "text_key"]
    met = (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram"))
    hits = word_grams(docs, known, id_col, text_col).join(F.broadcast(table), met, "left").filter("template IS NOT NULL OR n_words IS NOT NULL")
    diagonals = hits.groupBy(*key, "template", "label", "base", "votes_all", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.count("n_words").alias("copies"), F.max("n_words").alias("n_words")
    )
    along = W.partitionBy(*key, "template").orderBy("diagonal").rangeBetween(0, NEIGHBOUR)
    near = F.collect_list(F.struct("diagonal", "ats")).over(along)
    own = F.filter(near, lambda d: ~F.col("base") | (d["diagonal"] == F.col("diagonal")))
    votes = F.array_sort(F.flatten(F.transform(own, lambda d: F.transform(d["ats"], lambda at: F.struct(at.alias("at"), (at + d["diagonal"]).alias("pos"))))))
    none = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("last"), F.lit(0).alias("n"))

    def count(seen, vote):
        new = vote["at"] > seen["at"]  # the first place of this gram
        return F.struct(vote["at"].alias("at"), F.when(new, F.greatest(seen["last"], vote["pos"])).otherwise(seen["last"]).alias("last"), (seen["n"] + F.when(new & (vote["pos"] > seen["last"]), 1).otherwise(0)).alias("n"))

    places = diagonals.withColumn("share", F.when(F.col("template").isNotNull(), F.aggregate(votes, none, count)["n"] / F.col("votes_all")))
    phrase, good = F.col("base") & (F.col("share") >= 1), F.when(F.col("base"), F.col("share") >= 1).otherwise(F.col("share") >= COVERAGE)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        places.groupBy(*key)
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("copies").alias("copies"),
            F.count(F.when(phrase, 1)).alias("n_base"),
            F.min(F.when(phrase, F.col("diagonal").cast("long"))).alias("first_word"),
            F.max(F.when(phrase, F.col("diagonal").cast("long"))).alias("last_word"),
            joined(F.when(phrase, F.col("label"))).alias("base_labels"),
            joined(F.when(good, F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(good, F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .drop("copy", "copies", "text_key")
    )
