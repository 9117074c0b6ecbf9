"""License scan: an exact set-similarity join of text lines with license notices, natively in SQL."""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ascii_lower, materialise, replacing, row_keys, set_aside

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices as they stand in files, and their labels.
TEMPLATES = [
    ("Released under the MIT License.", "mit"),
    ("Licensed under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache-2"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "bsd-3"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache-2"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mpl-2"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "epl-2"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "unlicense"),
    ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", "zlib"),
    ("Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at", "boost-1"),
]
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD_RE = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_joined(text: Column) -> Column:
    """The words of a text, lower-cased, each after one space, with a space at the end."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " ")), F.lit(" "))


def spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def template_words(notice: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in notice))))


def with_rare_words(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, text: str) -> DataFrame:
    """The rows that may match: those that hold one of n - o + 1 words of some notice, anywhere; the
    longest are taken, those that another notice needs too before others of ten letters. By the
    prefix filter that goes for any order of words, so no match is lost; it spares nearly all texts
    the splitting. Unicode lower case is the same for ASCII words; with others there's no filter."""
    words: set[str] = set()
    for notice, _ in templates:
        own = template_words(notice)
        words.update(sorted(own, key=lambda w: (-min(len(w), 10), w not in words, -len(w), w))[: len(own) - math.ceil(threshold * len(own) - 1e-9) + 1])
    if not words or not "".join(words).isascii():
        return docs
    some = F.transform(F.array(F.lower(F.col(f"`{text}`"))), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in sorted(words)]))  # lower-cased once
    return docs.filter(F.get(some, 0))


def matching_lines(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, id: str, text: str) -> DataFrame:
    """(_k1, _k2, line, label, containment) for each line that holds at least ``threshold`` of the
    distinct words of a notice. Exact: a notice of n words asks for an overlap of
    o = ceil(threshold * n), so in any common order of words the first n - o + 1 words of the
    notice and the first b - o + 1 of the line's b must share one; that order is by the number of
    lines in the corpus, rarest first. Lines are kept down to the notices' vocabulary, as no other
    word can overlap. What is broadcast is one row for each word of the notices."""
    spark = docs.sparkSession
    sets = [(template_words(t), label) for t, label in templates]
    needed = [math.ceil(threshold * len(w) - 1e-9) for w, _ in sets]
    vocabulary = sorted({w for words, _ in sets for w in words})
    line = F.col("line")
    own = F.array_intersect(F.split(F.btrim(words_joined(line)), " "), F.array(*[F.lit(w) for w in vocabulary]))
    blocks = docs.select(*row_keys(id, text), F.posexplode(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n")).alias("line_no", "line"))
    blocks = materialise(blocks.select("_k1", "_k2", "line_no", own.alias("words")).filter(F.size("words") >= min(needed)), "license-blocks")
    counts = {r["w"]: r["n"] for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}  # as many rows as the notices have words
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    postings = []
    for i, ((words, label), o) in enumerate(zip(sets, needed, strict=True)):
        ordered = sorted(words, key=place.__getitem__)
        postings += [(w, i, label, ordered, o, at) for at, w in enumerate(ordered[: len(ordered) - o + 1])]
    postings = F.broadcast(spark.createDataFrame(postings, "word string, notice int, label string, wanted array<string>, o int, at int"))
    rank = F.create_map(*[x for w, i in place.items() for x in (F.lit(w), F.lit(i))])
    ordered = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(F.element_at(rank, w).alias("r"), w.alias("w")))), lambda s: s["w"])
    probes = blocks.select("_k1", "_k2", "line_no", ordered.alias("words")).select("*", F.size("words").alias("b"), F.posexplode(F.slice("words", 1, F.greatest(F.lit(0), F.size("words") - min(needed) + 1))).alias("j", "word"))
    found = probes.join(postings, "word").filter(
        (F.col("b") >= F.col("o"))  # length
        & (F.col("j") <= F.col("b") - F.col("o"))  # the line's prefix for this notice
        & (1 + F.least(F.size("wanted") - F.col("at") - 1, F.col("b") - F.col("j") - 1) + F.least(F.col("at"), F.col("j")) >= F.col("o"))  # position
    )
    overlap = F.size(F.array_intersect("words", "wanted"))
    return found.filter(overlap >= F.col("o")).select("_k1", "_k2", "line_no", "notice", "label", (overlap / F.size("wanted")).alias("containment"))


def matching_windows(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, id: str, text: str) -> DataFrame:
    """(_k1, _k2, notice, label, containment) for each window of words, across line ends, that holds at
    least ``threshold`` of the distinct words of a notice; so wrapped notices are found, with comment
    marks at the line starts too. A window is as long as the notice, and by 1 / threshold longer to make up for words put in.

    Exact, by the filters of ``matching_lines``: only texts that hold enough of a notice's words at all are
    looked at (length), and a window that reaches o = ceil(threshold * n) holds one of the notice's n - o + 1 rarest
    words (prefix), so windows are looked for around these alone."""
    spark = docs.sparkSession
    sets = [(template_words(t), math.ceil(len(NOT_WORD_RE.sub(" ", t).split()) / threshold), label) for t, label in templates]
    needed = [math.ceil(threshold * len(w) - 1e-9) for w, _, _ in sets]
    vocabulary = sorted({w for words, _, _ in sets for w in words})
    known = F.array(*[F.lit(w) for w in vocabulary])
    texts = docs.select(*row_keys(id, text), F.split(F.btrim(words_joined(F.col(f"`{text}`"))), " ").alias("all"))
    texts = texts.withColumn("own", F.array_intersect("all", known)).filter(F.size("own") >= min(needed))
    enough = F.array_compact(F.array(*[F.when(F.size(F.array_intersect("own", F.array(*[F.lit(w) for w in words]))) >= o, F.lit(i)) for i, ((words, _, _), o) in enumerate(zip(sets, needed, strict=True))]))
    texts = texts.withColumn("notices", enough).filter(F.size("notices") > 0).dropDuplicates(["_k1", "_k2"])
    texts = materialise(texts.select("_k1", "_k2", "all", "own", "notices"), "license-texts")
    counts = {r["w"]: r["n"] for r in texts.select(F.explode("own").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}  # as many rows as the notices have words
    rows = []
    for i, ((words, length, label), o) in enumerate(zip(sets, needed, strict=True)):
        rare = sorted(words, key=lambda w: (counts.get(w, 0), w))[: len(words) - o + 1]
        rows.append((i, label, words, rare, length, o))
    wanted = F.broadcast(spark.createDataFrame(rows, "notice int, label string, wanted array<string>, rare array<string>, n int, o int"))
    each = texts.select("_k1", "_k2", "all", F.explode("notices").alias("notice")).join(wanted, "notice")
    anchors = each.select("*", F.explode(F.filter(F.transform("all", lambda w, at: F.when(F.array_contains("rare", w), at)), lambda at: at.isNotNull())).alias("at"))
    near = anchors.select("_k1", "_k2", "notice", "label", "wanted", "n", "o", F.slice("all", F.greatest(F.lit(1), F.col("at") + 2 - F.col("n")), F.col("n") + F.least(F.col("at"), F.col("n") - 1)).alias("around")).distinct()
    near = near.filter(F.size(F.array_intersect("around", "wanted")) >= F.col("o"))
    most = F.array_max(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("around") - F.col("n") + 1)), lambda s: F.size(F.array_intersect(F.slice("around", s, F.col("n")), "wanted"))))
    return near.withColumn("most", most).filter(F.col("most") >= F.col("o")).select("_k1", "_k2", "notice", "label", (F.col("most") / F.size("wanted")).alias("containment"))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None, threshold: float = 0.9, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Labels the licenses that texts name.

    Base: places where the words of a phrase stand in a row (places may touch but a phrase must
    not overlap itself). The method adds the label of each notice of which some text block (a line, or a
    window of words across line ends) holds at least ``threshold`` of the distinct words; a block that holds the
    words of two notices (as the Affero one holds the General one's) gets both labels. Null texts are empty. Rows
    are documents: null and repeated ids stay apart, equal rows get equal results, an empty table gives an empty one. Returns the
    columns of ``docs`` but the text (names below are replaced) and ``n_words``, ``n_base``,
    ``first_word``, ``last_word`` (null without a place), ``base_labels``, ``labels`` (sorted,
    comma-joined, maybe empty), ``score`` (the largest containment found, 0 without).
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    inner, named = set_aside(replacing(docs, *[n for n in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score") if n not in (id, text)]), text)
    one = docs.select(*inner, *row_keys(id, text), words_joined(F.col(f"`{text}`")).alias("_t"))
    n_words = F.when(F.trim("_t") == "", 0).otherwise(spaces(F.col("_t")) - 1)
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        whole, t = f" {phrase} ", F.col("_t")
        there = F.contains(t, F.lit(whole))
        places.append(F.when(there, F.regexp_count(t, F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(there, spaces(F.substring(t, F.lit(1), F.locate(whole, t) - 1))))
        back = F.reverse(t)
        lasts.append(F.when(there, n_words - spaces(F.substring(back, F.lit(1), F.locate(whole[::-1], back) - 1)) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    one = one.select(
        *[c for c in one.columns if c != "_t"], n_words.cast("long").alias("n_words"), sum(places, F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*firsts)).cast("long").alias("first_word"), F.array_max(F.array(*lasts)).cast("long").alias("last_word"),
        F.sort_array(F.array_distinct(F.array_compact(F.array(*labels)))).alias("_base"),
    )
    likely = with_rare_words(docs, templates, threshold, text)
    found = [f(likely, templates, threshold, id, text).select("_k1", "_k2", "label", "containment") for f in (matching_lines, matching_windows)]
    more = found[0].union(found[1]).groupBy("_k1", "_k2").agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_score"))
    both = one.join(more, ["_k1", "_k2"], "left")
    every = F.sort_array(F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>"))))
    return both.select(*named, "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), F.coalesce("_score", F.lit(0.0)).alias("score"))
