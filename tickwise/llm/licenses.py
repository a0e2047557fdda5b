"""License scan by diagonal voting, in DataFrame functions only.

Every window of k words of every text is joined by its hash to the windows of
the license templates.  A text that holds a template, even with words put in
or left out, has many matches on one or a few neighbouring diagonals (place in
the text minus place in the template); votes are counted by diagonal,
neighbouring diagonals are merged, and the span that is left must cover enough
of the template without stretching over much else, and no other license may
have all the windows it matched: a notice of a near relative is the relative's.  A chain of copies, too long for one, is taken apart again.
Of spans that overlap, only the best-covering template's is kept.

Scale: the window table of the templates is under two thousand rows, the only
thing broadcast.  Windows with a word that no template has are left out inside
the row; the rest are exploded and joined without a shuffle; only the matches are shuffled, partially aggregated, and by document, so a license that
a third of all documents hold is spread like the documents are.
"""
from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import table, whole_text

#: Fixed value: a word of this scan, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are the base labels.
PHRASES = (("mit", ("under", "the", "mit", "license")), ("apache-2", ("apache", "license", "version", "2")), ("cc-by-nc", ("cc", "by", "nc")))

K = 4
#: Diagonals this near each other belong to one place.
NEIGHBOUR = 4
#: Least share of a template's windows that a place must have, and most length against the template's.
COVER, STRETCH = 0.5, 1.5

#: Notices by which texts are put under a license, as they are usually worded.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)
#: The GNU licenses as their notices name them, the versions, and what the notice calls the work.
GNU = (
    ("gpl-2", "General Public License", "2", "program"), ("gpl-3", "General Public License", "3", "program"), ("agpl", "Affero General Public License", "3", "program"),
    ("lgpl", "Lesser General Public License", "2.1", "library"), ("lgpl", "Lesser General Public License", "3", "library"),
)
#: The Creative Commons licenses with the names of their parts, and the versions with their ports.
CC_PARTS = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
CC = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("4.0 International", "3.0 Unported", "2.5 Generic", "2.0 Generic", "1.0 Generic")
#: Identifiers that stand in a file's license line.
SPDX = (
    ("mit", "MIT"), ("apache-2", "Apache-2.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("isc", "ISC"), ("gpl-2", "GPL-2.0"), ("gpl-3", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"),
    ("agpl", "AGPL-3.0"), ("mpl-2", "MPL-2.0"), ("epl", "EPL-1.0"), ("epl", "EPL-2.0"), ("boost", "BSL-1.0"), ("zlib", "Zlib"), ("unlicense", "Unlicense"), ("cc0", "CC0-1.0"),
)


def _families() -> list[tuple[str, str]]:
    """The notices of license families, whose members differ in a name, a part or a version."""
    out = []
    for label, name, version, work in GNU:
        out += [(label, f"This work is licensed under the GNU {name}, version {version}."), (label, f"This work is licensed under the GNU {name} v{version if '.' in version else version + '.0'}.")]
        out.append((label, f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."))
    for parts in CC:
        for version in CC_VERSIONS:
            name = "-".join(CC_PARTS[p] for p in parts.split("-"))
            names = {name, name if version[0] == "4" else name.replace("NoDerivatives", "NoDerivs")}
            if version[0] == "1":
                names.add(name.replace("NonCommercial-NoDerivatives", "NoDerivs-NonCommercial"))
            out += [(f"cc-{parts}", f"This work is licensed under a Creative Commons {n} {version} License.") for n in sorted(names)]
    out += [(label, f"SPDX-License-Identifier: {name}") for label, name in SPDX]
    return out + [(f"cc-{parts}", f"SPDX-License-Identifier: CC-{parts.upper()}-4.0") for parts in CC]


TEMPLATES = tuple(dict.fromkeys(_families())) + TEMPLATES


def words_of(text: Column) -> Column:
    """The words of a text; lower-casing more than A-Z moves no word edge, and templates and phrases are ASCII."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def _windows(words: Column, known: Column, k: int) -> Column:
    """``(at, g, word)`` for each window of k words that are all ``known``: its place, its hash and its first word."""
    def window(i: Column) -> Column:
        return F.struct(i.alias("at"), F.xxhash64(*[F.get(words, i + j) for j in range(k)]).alias("g"), F.get(words, i).alias("word"))

    def whole(i: Column) -> Column:
        return functools.reduce(Column.__and__, [F.get(known, i + j) for j in range(k)])

    return F.when(F.size(known) >= k, F.transform(F.filter(F.sequence(F.lit(0), F.size(known) - k), whole), window))


def _exploded(df: DataFrame, k: int, vocabulary: list[str] | None = None) -> DataFrame:
    """``df`` (with ``words``) with a row per window instead of the words; of a vocabulary, windows that hold no other word."""
    known = F.transform("words", lambda w: F.lit(True) if vocabulary is None else w.isin(vocabulary))
    step = df.withColumn("__h", known).withColumn("__w", _windows(F.col("words"), F.col("__h"), k))
    # the outer form: a plain generator lets Spark infer a filter on the array and compute it twice
    return step.drop("words", "__h").select("*", F.inline_outer("__w")).drop("__w")


def template_windows(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``(t, label, n, t_at, g, word, holders)``: the windows of every template, n of them each, with all labels that have them."""
    rows = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(templates)])
    known = spark.range(1).select(F.inline(rows)).select("t", "label", words_of(F.col("text")).alias("words"))
    known = known.withColumn("n", F.size("words") - k + 1)
    known = _exploded(known, k).withColumnRenamed("at", "t_at")
    return known.withColumn("holders", F.sort_array(F.collect_set("label").over(Window.partitionBy("g", "word"))))


def template_words(templates=TEMPLATES) -> list[str]:
    """All words of the templates, which are ASCII."""
    return sorted({w for _, text in templates for w in re.findall(WORD, text.lower())})


def places(rows: DataFrame, keys: list[str], templates=TEMPLATES, k: int = K, neighbour: int = NEIGHBOUR, cover: float = COVER, stretch: float = STRETCH) -> DataFrame:
    """Verified spans ``keys, label, start, end, score``: rows carry ``keys`` and ``words``; places count words, end exclusive.

    Null words have no spans; equal keys share them; an empty table gives none;
    columns beside the keys and words are ignored.
    """
    known = template_windows(rows.sparkSession, templates, k)
    hits = _exploded(rows.select(*keys, "words"), k, template_words(templates)).join(F.broadcast(known), ["g", "word"])
    votes = hits.groupBy(*keys, "t", "label", "n", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.collect_set("t_at").alias("matched"), F.min("at").alias("start"), (F.max("at") + k).alias("end"), F.collect_set("holders").alias("holders"))  # a set holds a template's windows at most
    by = Window.partitionBy(*keys, "t").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > neighbour, F.lit(True)).cast("int")
    numbered = votes.withColumn("new", new).withColumn("place", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "t", "label", "n", "place").agg(F.sort_array(F.collect_list(F.struct("diagonal", "start", "end", "matched", "holders"))).alias("on"))

    def spot(on: Column) -> Column:
        # a place whose every window another license has too says nothing for this one
        holders = F.flatten(F.transform(on, lambda d: d["holders"]))
        shared = F.aggregate(holders, F.get(holders, 0), F.array_intersect)
        return F.struct(
            F.size(F.array_distinct(F.flatten(F.transform(on, lambda d: d["matched"])))).alias("covered"), F.array_min(F.transform(on, lambda d: d["start"])).alias("start"),
            F.array_max(F.transform(on, lambda d: d["end"])).alias("end"), (F.size(shared) == 1).alias("own"))

    # a diagonal is never longer than the template, so a run of diagonals within the slack is never too long
    words = F.col("n") + (k - 1)
    slack = F.greatest(F.floor((stretch - 1) * words + neighbour), F.lit(0)).cast("int")
    run = lambda d, i: F.filter(F.slice("on", i + 1, slack + 1), lambda o: o["diagonal"] - d["diagonal"] <= slack)
    parts = F.concat(F.transform("on", lambda d: spot(F.array(d))), F.transform("on", lambda d, i: spot(run(d, i))))
    whole = merged.withColumn("whole", spot(F.col("on")))
    fits = F.col("whole.end") - F.col("whole.start") <= stretch * words + neighbour
    found = whole.select(*keys, "t", "label", "n", F.inline(F.when(fits, F.array("whole")).otherwise(parts)))
    return best_of_overlapping(found.withColumn("score", F.col("covered") / F.col("n")).filter((F.col("score") >= cover) & F.col("own")), keys)


def best_of_overlapping(found: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, label, start, end, score``: the spans, best cover first, that meet no better one."""
    by = Window.partitionBy(*keys).orderBy("start", "end", "t")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    numbered = found.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("knot", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))  # spans of one knot meet no other's
    order = F.struct((-F.col("score")).alias("by_score"), (-F.col("covered")).alias("by_cover"), (F.col("end") - F.col("start")).alias("length"), "start", "t", "end", "label", "score")
    knots = numbered.groupBy(*keys, "knot").agg(F.sort_array(F.collect_set(order)).alias("all"))
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda acc, c: F.when(F.exists(acc, lambda o: meets(o, c)), acc).otherwise(F.concat(acc, F.array(c))))
    return knots.select(*keys, F.explode(kept).alias("c")).select(*keys, "c.label", "c.start", "c.end", "c.score")


def base_places(words: Column, text: Column) -> Column:
    """Sorted ``(at, label)`` of every place of a phrase; texts without a phrase's rarest word skip the search."""
    def found(label: str, phrase: tuple[str, ...]) -> Column:
        gate = F.contains(F.lower(text), F.lit(max(phrase, key=len)))
        at = lambda i: F.forall(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(w).alias("w")) for j, w in enumerate(phrase)]), lambda p: F.get(words, i + p["j"]) == p["w"])
        hits = F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - len(phrase)), at), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
        return F.when(gate & (F.size(words) >= len(phrase)), hits).otherwise(F.array().cast("array<struct<at:int,label:string>>"))

    return F.sort_array(F.concat(*[found(label, phrase) for label, phrase in PHRASES]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, **limits) -> DataFrame:
    """The contract's rows, one per input row, with the method's verified ``places``.

    Null text is empty and has no words; null ids and repeated rows give a row
    each; other columns are ignored; an empty table gives no rows.
    """
    text = F.col("text")
    docs = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    # a row is known by id and text: a repeated id with another text stays apart, an exact repeat shares the spans
    rows = docs.withColumns({"key": F.xxhash64("text"), "words": words_of(text)})
    spans = places(rows, ["doc_id", "key"], templates, **limits)
    by_doc = spans.groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best"), F.sort_array(F.collect_set(F.struct("start", "end", "label"))).alias("places"))
    base = rows.withColumn("base", base_places(F.col("words"), text)).select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "base")
    joined = base.withColumnsRenamed({"doc_id": "id", "key": "id_key"}).join(
        by_doc, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("id_key") == F.col("key")), "left")
    labels = F.transform("base", lambda b: b["label"])
    text_of = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    return joined.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.get("base", 0)["at"].cast("long").alias("first_word"), F.get("base", F.size("base") - 1)["at"].cast("long").alias("last_word"),
        text_of(labels).alias("base_labels"), text_of(F.concat(labels, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.array_join(F.transform(F.coalesce("places", F.array().cast("array<struct<start:int,end:int,label:string>>")), lambda p: F.concat_ws(":", p["label"], p["start"], p["end"])), ",").alias("places"))


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
