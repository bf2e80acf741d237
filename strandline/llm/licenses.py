"""Licence families of paragraphs, by a small trained classifier and a comparison with templates.

Fitting happens on the driver over the built-in notices below (a fixed, documented set: every
notice, framed in a few common ways, and windows of it; sentences that merely mention such words
are the unknown class, notices of further licences the class ``other``). Whole notices are held out to calibrate. Scoring is
DataFrame functions only: paragraphs are cut into word n-grams, joined with the broadcast weights (at most ``MAX_FEATURES`` rows)
and summed. A paragraph is a line, or a line and its followers, over which a notice may be wrapped, up to the next line without words
or until it holds ``SPAN`` words, more than twice the longest notice. It is a candidate if it holds one of the ``STEMS`` or ``NAMES``.
A family is confirmed where the paragraph holds enough of the word pairs of one of its notices, for each other family a pair that this one
lacks (such as the version), and no negation. Of overlapping paragraphs the one most like a notice of its family counts; one of
several lines has to be confirmed.

Null and empty texts have no paragraphs and get the empty result. Repeated rows are judged one
by one. Other columns are ignored. Rows are numbered once, in a written table, so any plan may stand behind ``docs``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Short licence notices by family.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License v3.0",
        "Available under the GPLv3.",
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "Available under the GPLv2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License.",
    ),
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license.",
        "Licensed under the BSD 3-Clause License.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc-by": ("Licensed under CC BY 4.0.", "CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "public-domain": ("This work is dedicated to the public domain under CC0 1.0.", "CC0 1.0", "This is free and unencumbered software released into the public domain."),
    "all-rights-reserved": ("All rights reserved.", "Copyright 2020 the authors. All rights reserved."),
}
#: Notices of further licences, found as ``other`` and never confirmed.
FURTHER = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "Licensed under the Eclipse Public License, version 1.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.",
    "This package may be distributed under the terms of the Artistic License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the zlib License.",
    "Licensed under the ISC License.",
    "Use of this software is governed by the Business Source License.",
    "Licensed under the Open Software License, version 3.0.",
    "Licensed under the Microsoft Public License.",
    "This font is licensed under the SIL Open Font License, Version 1.1.",
)
#: Sentences with the same words that name no licence.
OTHER = (
    "A driver license is required to rent a car.",
    "The company licensed its technology to a partner last year.",
    "The restaurant lost its liquor license after the inspection.",
    "He copyrighted the song and sold the rights.",
    "Civil rights were discussed at the public meeting.",
    "The court granted permission to appeal.",
    "The public domain of the city includes its parks.",
    "The warranty of the machine covers free repairs for two years.",
    "A software update was released under heavy pressure.",
    "The license plate was missing when the car was found.",
    "She is a licensed nurse and works in the general hospital.",
    "Seats are reserved for the public.",
    "The general public was free to use the version in the museum.",
    "Apache helicopters flew over the valley.",
    "The MIT campus is open to visitors.",
    "Mozilla is a foundation; redistribution of funds was planned.",
)
FRAMES = ("{}", "Note: {}", "{} See the file for details.", "# {}", "Copyright 2019 the authors. {}")
#: A paragraph without any of these is no candidate.
STEMS = ("licens", "licenc", "copyright", "reserved", "redistribut", "public domain", "hereby granted", "unencumbered", "creative commons", "general public")
#: Names of licences that stand in notices without a stem.
NAMES = ("cc by", "cc-by", "cc0", "gplv2", "gplv3")
SPAN = 96
MAX_FEATURES, ORDERS = 4096, (1, 2, 3)
CONFIRM = 0.5
NONE, ELSE = "unknown", "other"
#: What takes a notice back; the words between are few.
NEGATION = r"\b(not|never|nor|no longer)( [a-z]+){0,2} (licensed|released|available|distributed|governed|covered|under)\b"
WORD = "[a-z0-9][a-z0-9.+-]*"


def tokens(text: str) -> list[str]:
    return [w.rstrip(".-+") for w in re.findall(WORD, text.lower())]


def features(words: list[str]) -> set[str]:
    """Word n-grams."""
    return {" ".join(words[i : i + n]) for n in ORDERS for i in range(len(words) - n + 1)}


def _examples() -> list[tuple[str, str, bool]]:
    """Text, class and whether it calibrates: of each family with three notices one is held out whole, and every fifth other sentence."""
    out = []
    for family, notices in [*NOTICES.items(), (ELSE, FURTHER)]:
        for k, notice in enumerate(notices):
            held = len(notices) > 2 and k % 5 == 2
            out += [(frame.format(notice), family, held) for frame in FRAMES]
            words = notice.split()
            if len(words) > 16:
                out += [(" ".join(words[i : i + 14]), family, held) for i in range(0, len(words) - 13, 3)]
    out += [(frame.format(s), NONE, k % 5 == 2) for k, s in enumerate(OTHER) for frame in FRAMES[:4]]
    out += [(f"the {a} of it", NONE, False) for a in STEMS]
    return [row for row in out if any(a in row[0].lower() for a in (*STEMS, *NAMES))]


def fit(steps: int = 400, rate: float = 2.0, ridge: float = 1e-4) -> dict:
    """Multinomial logistic regression by gradient descent, deterministic.

    A model without the held-out notices sets the temperature (least log loss on them) and the least probability
    at which no held-out unknown is taken for a family; the weights are then fitted on all examples.
    """
    rows = [(features(tokens(t)), y, held) for t, y, held in _examples()]
    classes = [*NOTICES, ELSE, NONE]

    def soft(z):
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def matrix(part, place):
        x = np.zeros((len(part), len(place)))
        for i, (f, *_) in enumerate(part):
            x[i, [place[g] for g in f if g in place]] = 1.0
        return x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True))), np.array([classes.index(r[1]) for r in part])

    def train(part):
        counts: dict[str, int] = {}
        for f, *_ in part:
            for g in f:
                counts[g] = counts.get(g, 0) + 1
        vocabulary = sorted(counts, key=lambda g: (-counts[g], g))[:MAX_FEATURES]
        x, y = matrix(part, place := {g: i for i, g in enumerate(vocabulary)})
        w, b, goal = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes)), np.eye(len(classes))[y]
        for _ in range(steps):
            d = (soft(x @ w + b) - goal) / len(part)
            w -= rate * (x.T @ d + ridge * w)
            b -= rate * d.sum(axis=0)
        return vocabulary, place, w, b

    _, place, w, b = train([r for r in rows if not r[2]])
    x, y = matrix([r for r in rows if r[2]], place)
    z = x @ w + b
    loss = lambda t: -np.log(soft(z / t)[np.arange(len(y)), y] + 1e-12).mean()
    t = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss)
    unknown = soft(z / t)[y == len(classes) - 1][:, :-1].max(axis=1, initial=0.0)
    vocabulary, _, w, b = train(rows)
    return {"classes": classes, "vocabulary": vocabulary, "weights": w / t, "bias": b / t, "least": float(max(0.5, min(0.9, unknown.max(initial=0.0))))}


def _hit(column: str) -> str:
    """SQL: the text holds a stem or name, whatever stands between the words of one; the text is read once."""
    apart = "[^a-z0-9.+-]+"
    return f"{column} RLIKE '" + "|".join(a.replace(" ", apart) for a in (*STEMS, *NAMES)) + "'"


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _row and, where the text holds a stem or name, its lower-cased body. To be written before it is used twice."""
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), body.alias("body"))
    return rows.select("doc_id", "_row", F.expr(f"CASE WHEN {_hit('body')} THEN body END").alias("body"))


def candidates(rows: DataFrame) -> DataFrame:
    """Of ``numbered`` rows: doc_id, _row, paragraph (its first line's place * SPAN + further lines), words and n-grams of every paragraph with a stem or name."""
    lines = rows.where("body IS NOT NULL").select("doc_id", "_row", F.split("body", "\n", -1).alias("lines"))
    # lines that hold a stem, alone or with the next line; paragraphs begin at most SPAN lines before one
    spots = f"filter(transform(lines, (x, i) -> CASE WHEN {_hit("concat(x, ' ', coalesce(get(lines, i + 1), ''))")} THEN i END), i -> i IS NOT NULL)"
    lines = lines.withColumn("spots", F.expr(spots))
    begins = f"array_distinct(flatten(transform(spots, s -> sequence(greatest(0, s - {SPAN - 1}), s))))"
    lines = lines.select("doc_id", "_row", F.explode(F.expr(f"transform({begins}, i -> struct(i AS at, slice(lines, i + 1, {SPAN}) AS next))")).alias("p"))
    lines = lines.select("doc_id", "_row", "p.at", "p.next").where("get(next, 0) RLIKE '[a-z0-9]'")
    blank = "array_position(transform(next, x -> x RLIKE '[a-z0-9]'), false)"
    lines = lines.withColumn("next", F.expr(f"CASE WHEN {blank} > 0 THEN slice(next, 1, cast({blank} - 1 AS int)) ELSE next END"))
    # words so far, before each line: a paragraph takes lines while it holds less than SPAN
    before = f"aggregate(transform(next, x -> size(regexp_extract_all(x, '({WORD})'))), cast(array(0) AS array<int>), (a, n) -> concat(a, array(element_at(a, -1) + n)))"
    lines = lines.withColumn("next", F.expr(f"slice(next, 1, greatest(1, least(size(next), size(filter({before}, n -> n < {SPAN})))))"))
    lines = lines.where(F.expr(_hit("array_join(next, ' ')")))
    lines = lines.select("doc_id", "_row", "at", F.posexplode(F.expr("transform(next, (x, i) -> array_join(slice(next, 1, i + 1), ' '))")).alias("more", "line"))
    lines = lines.where(F.expr(_hit("line")))
    words = F.transform(F.regexp_extract_all("line", F.lit(f"({WORD})")), lambda w: F.rtrim(w, F.lit(".+-")))
    lines = lines.select("doc_id", "_row", (F.col("at") * SPAN + F.col("more")).alias("paragraph"), words.alias("words"))
    grams = [
        f"transform(sequence(0, size(words) - {n}), i -> array_join(slice(words, i + 1, {n}), ' '))"
        for n in ORDERS
    ]
    grams = [f"CASE WHEN size(words) >= {n} THEN {g} ELSE cast(array() AS array<string>) END" for n, g in zip(ORDERS, grams, strict=True)]
    return lines.select("doc_id", "_row", "paragraph", "words", F.expr(f"array_distinct(concat({', '.join(grams)}))").alias("grams")).where(F.size("grams") > 0)


def _pairs(notice: str) -> set[str]:
    words = tokens(notice)
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def own_pairs() -> dict[str, dict[str, list[str]]]:
    """For each family and each other one (or the further licences) that shares word pairs with it: the pairs that only the family has."""
    pairs = {family: set().union(*map(_pairs, notices)) for family, notices in [*NOTICES.items(), (ELSE, FURTHER)]}
    return {f: {g: sorted(p - q) for g, q in pairs.items() if g != f and p & q} for f, p in pairs.items() if f != ELSE}


def classify(found: DataFrame, model: dict | None = None, confirm: float = CONFIRM) -> DataFrame:
    """``found`` (of ``candidates``) plus family, probability, similarity and confirmed.

    family is ``unknown`` where that class is likeliest or the probability stays under the
    calibrated least. similarity: the largest share of a notice's word pairs that the paragraph
    holds, over the family's notices; confirmed from ``confirm`` on, if for each other family a pair is there that it lacks, and nothing negates it.
    """
    spark, model = found.sparkSession, model or fit()
    classes, width = model["classes"], len(model["classes"])
    rows = [(g, [float(v) for v in model["weights"][i]]) for i, g in enumerate(model["vocabulary"])]
    weights = F.broadcast(spark.createDataFrame(rows, "gram string, w array<double>"))  # at most MAX_FEATURES rows
    scored = found.select("_row", "paragraph", F.explode("grams").alias("gram")).join(weights, "gram")
    scored = scored.groupBy("_row", "paragraph").agg(F.count("*").alias("known"), F.array(*(F.sum(F.col("w")[i]) for i in range(width))).alias("z"))
    bias = "array(" + ", ".join(f"{float(v)!r}D" for v in model["bias"]) + ")"
    scored = scored.withColumn("z", F.expr(f"zip_with(z, {bias}, (a, b) -> a / sqrt(known) + b)"))
    scored = scored.withColumn("e", F.expr("transform(z, v -> exp(v - array_max(z)))"))
    scored = scored.withColumn("best", F.expr("array_position(z, array_max(z)) - 1"))
    scored = scored.withColumn("probability", F.expr("1D / aggregate(e, 0D, (a, v) -> a + v)"))
    names = "array(" + ", ".join(f"'{c}'" for c in classes) + ")"
    family = F.expr(f"CASE WHEN probability >= {model['least']!r}D THEN get({names}, cast(best AS int)) ELSE '{NONE}' END")
    scored = scored.select("_row", "paragraph", family.alias("family"), F.round("probability", 6).alias("probability"))
    out = found.join(scored, ["_row", "paragraph"], "left")
    out = out.withColumn("family", F.coalesce("family", F.lit(NONE)))
    pairs = "transform(sequence(0, size(words) - 2), i -> concat(get(words, i), ' ', get(words, i + 1)))"
    out = out.withColumn("pairs", F.expr(f"CASE WHEN size(words) >= 2 THEN array_distinct({pairs}) ELSE cast(array() AS array<string>) END"))
    own = "CASE family"
    for name, mine in own_pairs().items():
        tests = [f"arrays_overlap(pairs, array({', '.join(map(repr, p))}))" for p in mine.values()] or ["true"]
        own += f" WHEN '{name}' THEN {' AND '.join(tests)}"
    share = "CASE family"
    for name, notices in NOTICES.items():
        each = []
        for notice in notices:
            held = sorted(_pairs(notice))
            each.append(f"size(array_intersect(pairs, array({', '.join(map(repr, held))}))) / {len(held)}D")
        share += f" WHEN '{name}' THEN " + (f"greatest({', '.join(each)})" if len(each) > 1 else each[0])
    out = out.withColumn("similarity", F.round(F.expr(share + " ELSE 0D END"), 6))
    said = ~F.array_join("words", " ").rlike(NEGATION)
    return out.withColumn("confirmed", (F.col("similarity") >= confirm) & F.expr(own + " ELSE false END") & said).drop("pairs", "words", "grams")


def settle(judged: DataFrame) -> DataFrame:
    """Of overlapping paragraphs the one that counts at each line.

    At a line the confirmed one of the greatest similarity, then the shortest, then the first is best. A window
    counts where it is best at all its lines; a line alone counts where no such window covers it.
    """
    sure = (F.col("family") != NONE) & F.col("confirmed")
    judged = judged.withColumns({"at": F.expr(f"paragraph div {SPAN}"), "more": F.expr(f"paragraph % {SPAN}")}).where(sure | (F.col("more") == 0))
    covered = judged.select("*", F.explode(F.expr("sequence(at, at + more)")).alias("spot"))
    order = F.struct(sure.cast("int"), F.when(sure, F.col("similarity")), -F.col("more"), -F.col("at"))
    covered = covered.withColumn("best", F.row_number().over(Window.partitionBy("_row", "spot").orderBy(order.desc())) == 1)
    whole = covered.groupBy("_row", "paragraph").agg(F.bool_and("best").alias("whole"))
    covered = covered.join(whole, ["_row", "paragraph"])
    taken = covered.groupBy("_row", "spot").agg(F.bool_or(F.col("whole") & (F.col("more") > 0)).alias("taken"))
    out = covered.where("spot = at").join(taken, ["_row", "spot"])
    return out.where("CASE WHEN more > 0 THEN whole ELSE NOT taken END").drop("at", "more", "spot", "best", "whole", "taken")


def scan(docs: DataFrame, stage, text: str = "text", model: dict | None = None) -> DataFrame:
    """Per document: doc_id, families (confirmed, sorted, comma-joined), n_confirmed, n_unconfirmed, n_unknown.

    ``stage(df)`` writes and rereads the row numbers with the texts that hold a stem, and the candidate paragraphs; both are few.
    """
    rows = stage(numbered(docs, text))
    found = stage(candidates(rows))
    judged = settle(stage(classify(found, model)))
    sure = (F.col("family") != NONE) & F.col("confirmed")
    per = judged.groupBy("_row").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(sure, F.col("family")))), ",").alias("families"),
        F.count_if(sure).alias("n_confirmed"),
        F.count_if((F.col("family") != NONE) & ~F.col("confirmed")).alias("n_unconfirmed"),
        F.count_if(F.col("family") == NONE).alias("n_unknown"),
    )
    out = rows.select("doc_id", "_row").join(per, "_row", "left")
    return out.select("doc_id", F.coalesce("families", F.lit("")).alias("families"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_confirmed", "n_unconfirmed", "n_unknown")))
