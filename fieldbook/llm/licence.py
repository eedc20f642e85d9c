"""Licence notices in texts: a paragraph classifier on sparse word n-grams, confirmed by comparison
with templates (operator 5).

Only built-in functions over the documents; the classifier itself is fitted on the driver, on the
small table of labelled examples."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import columns_as

UNKNOWN = "unknown"

#: Wordings of public licence notices, by family.
TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "boost": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "cc-by-nc-sa": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The software is provided as is, without warranty of any kind, express or implied",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}

#: Pairs that tell a family from those with like wordings.  A notice needs one of them where its
#: template has any.
NEEDED = {
    "agpl": ["affero general", "agpl 3"],
    "apache": ["the apache", "apache license", "apache 2"],
    "boost": ["boost software", "bsl 1"],
    "bsd": ["the bsd", "bsd 3"],
    "cc-by": ["cc by", "commons attribution"],
    "cc-by-nc": ["by nc", "attribution noncommercial"],
    "cc-by-nc-nd": ["nc nd", "noncommercial noderivatives"],
    "cc-by-nc-sa": ["nc sa", "noncommercial sharealike"],
    "cc-by-nd": ["by nd", "attribution noderivatives"],
    "cc-by-sa": ["by sa", "attribution sharealike"],
    "cc0": ["under cc0", "cc0 1"],
    "epl": ["eclipse public", "epl 2"],
    "gpl": ["gnu general", "gpl 3"],
    "isc": ["the isc", "isc license", "identifier isc"],
    "lgpl": ["lesser general", "lgpl 3"],
    "mit": ["the mit", "mit license", "identifier mit"],
    "mpl": ["mozilla public", "mpl 2"],
    "unlicense": ["identifier unlicense", "unencumbered software"],
}

#: Pairs of a stricter or other family: a notice of this one has none of them.
BARRED = {
    "cc-by": [*NEEDED["cc-by-nc"], *NEEDED["cc-by-nd"], *NEEDED["cc-by-sa"]],
    "cc-by-nc": [*NEEDED["cc-by-nc-nd"], *NEEDED["cc-by-nc-sa"]],
    "gpl": ["affero general", "lesser general"],
}

#: Sentences that sound alike and are no notice.
OTHERS = [
    "Drivers must carry a license at all times.",
    "The doctor was licensed under the law of the state.",
    "The record was released under the label's own name.",
    "All rights reserved.",
    "This work is part of a larger study.",
    "The software is sold with a warranty of two years.",
    "Permission is granted by the owner of the house.",
    "The terms of the agreement are public.",
    "A new version of the program is free.",
    "The general public may use the park free of charge.",
]

#: Words that make no n-gram on their own.
COMMON = "a an and any are as at be by for from in is it may of on or that the this to with without you".split()


def ngrams_of(text: str) -> list[str]:
    """The driver's twin of ``ngrams``."""
    words = [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:]) if not (a in COMMON and b in COMMON)]
    return list(dict.fromkeys(pairs))


def ngrams(text: Column) -> Column:
    """Pairs of neighbouring words in lower case, also over line breaks; words are runs of ASCII
    letters and digits."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))


def literal(values: list) -> str:
    """SQL for an array of texts or of numbers, nested or not."""
    if isinstance(values, list):
        return "array(" + ", ".join(map(literal, values)) + ")"
    return f"'{values}'" if isinstance(values, str) else f"{values!r}D"


class Model:
    """Multinomial logistic regression over the pairs of the examples; a pair of no example has no
    weight.  ``temperature`` and ``least`` come from a fit without every fourth wording, on those
    wordings: the first makes the probabilities true, the second is the least probability at which
    a family is believed, so that at most one in a hundred of the others is.  The weights are then
    fitted on all wordings."""

    def __init__(self, templates: dict[str, list[str]], others: list[str], copies: int = 40, seed: int = 0):
        self.families = [UNKNOWN, *sorted(templates)]
        self.templates = {f: [set(ngrams_of(t)) for t in templates[f]] for f in templates}
        self.words = {f: [len(re.findall("[a-z0-9]+", t.lower())) for t in templates[f]] for f in templates}
        self.pairs = sorted({p for t in [*sum(templates.values(), []), *others] for p in ngrams_of(t)})
        place = {p: k for k, p in enumerate(self.pairs)}
        random, rows, labels, wordings = np.random.default_rng(seed), [], [], []

        def example(pairs: list[str], share: float, label: int, wording: int) -> None:
            x = np.zeros(len(self.pairs) + 1)
            x[[place[p] for p in pairs if random.random() < share]] = 1
            x[-1] = 1
            rows.append(x)
            labels.append(label)
            wordings.append(wording)

        texts = [(k, t) for k, f in enumerate(self.families[1:], 1) for t in templates[f]] + [(0, t) for t in others]
        for n, (k, t) in enumerate(texts):
            for _ in range(copies):
                example(ngrams_of(t), random.uniform(0.75, 1), k, n)
                if k:
                    example(ngrams_of(t), random.uniform(0, 0.3), 0, n)  # scraps are no notice
        x, y = np.array(rows), np.array(labels)
        fit = np.array(wordings) % 4 != 0
        held, truth, grid = x[~fit] @ self._fitted(x[fit], y[fit]), y[~fit], np.linspace(0.3, 3, 28)
        loss = [-np.log(self._softmax(held / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        p = self._softmax(held / self.temperature)[:, 1:].max(axis=1)[truth == 0]
        self.least = float(np.quantile(p, 0.99))
        w = self._fitted(x, y)
        self.weights, self.bias = w[:-1] / self.temperature, w[-1] / self.temperature

    def _fitted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        w = np.zeros((x.shape[1], len(self.families)))
        hot = np.eye(len(self.families))[y]
        velocity = np.zeros_like(w)
        for _ in range(400):
            velocity = 0.9 * velocity - 0.5 * (x.T @ (self._softmax(x @ w) - hot) / len(y) + 1e-4 * w)
            w = w + velocity
        return w

    def wordings(self) -> tuple[str, int]:
        """SQL for the templates: family, number of pairs, pairs, needed and barred pairs, and the
        words that a notice may reach over (the wording's own, and twice as many); and the most
        words that any may."""
        rows, most = [], 0
        for f, templates in self.templates.items():
            for t, n in zip(templates, self.words[f]):
                need = [p for p in NEEDED.get(f, []) if p in t]
                for span in (n + 4, 2 * n + 8) if t else ():
                    most = max(most, span)
                    sets = ", ".join(f"{literal(sorted(v))} as {name}" if v else f"cast(array() as array<string>) as {name}" for name, v in (("pairs", t), ("need", need), ("bar", BARRED.get(f, []))))
                    rows.append(f"struct({self.families.index(f)} as family, {len(t)} as n, {span} as span, {sets})")
        return f"array({', '.join(rows)})", most

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def licences(docs: DataFrame, model: Model | None = None, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, paragraph, family, probability, coverage, confirmed``: the notices in all
    documents (``paragraph``: number of the word where one begins), and the passages without any
    that the classifier takes for one.

    Line breaks do not count: word pairs are those of the whole text, and known pairs that are
    nearer to each other than the longest wording reaches make a passage.  In a passage every
    stretch that has at least the given part of the pairs of a template within the words that it
    may reach over, one pair of the family's evidence and none that is barred is a candidate.
    Of candidates that overlap the one with most pairs counts, less a third for each word that it
    reaches over, so that none takes its pairs from two notices.
    It is confirmed if the classifier gives its family the model's least probability.

    Null and empty texts have no notices; null and repeated ids are kept; an empty table gives an
    empty result; further columns are ignored.  No shuffle, no Python in tasks."""
    model = model or Model(TEMPLATES, OTHERS)
    wordings, most = model.wordings()
    base = columns_as(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), ngrams(F.col("text")).alias("own"))
    pairs = F.expr(literal(model.pairs))
    placed = F.filter(F.transform("own", lambda p, k: F.struct(k.alias("at"), p.alias("pair"))), lambda h: h["pair"].isin(model.pairs))
    hits = base.where(F.arrays_overlap("own", pairs)).select("doc_id", placed.alias("hits"))
    # The first hits of passages, and the end.
    first = F.filter(F.sequence(F.lit(1), F.size("hits")), lambda k: (k == 1) | (F.get("hits", k - 1)["at"] - F.get("hits", k - 2)["at"] > most))
    hits = hits.withColumn("first", F.concat(first, F.array(F.size("hits") + 1)))
    passage = F.transform(F.slice("first", 1, F.size("first") - 1), lambda k, n: F.slice("hits", k, F.get("first", n + 1) - k))
    hits = hits.select("doc_id", F.explode(passage).alias("hits"))

    found_here = f"""flatten(transform(hits, (h, k) -> transform(filter({wordings}, t -> array_contains(t.pairs, h.pair)), t -> struct(
        h.at as start, t as t, filter(slice(hits, k + 1, t.span + 1), x -> x.at < h.at + t.span and array_contains(t.pairs, x.pair)) as own))))"""
    # A stretch ends with the last pair that it has not had before.
    once = "transform(candidates, c -> struct(c.start as start, c.t as t, filter(c.own, (x, k) -> array_position(c.own.pair, x.pair) = k + 1) as own))"
    stretch = """transform(candidates, c -> struct(
        element_at(c.own, -1).at - c.start - 3 * size(c.own) as cost, c.start as start, element_at(c.own, -1).at as stop, c.t.family as family,
        size(c.own) / c.t.n as coverage, c.t.need as need, c.t.bar as bar))"""
    inside = "array_distinct(filter(hits, x -> x.at between c.start and c.stop).pair)"
    proven = f"filter(candidates, c -> c.coverage >= {coverage!r}D and (size(c.need) = 0 or arrays_overlap({inside}, c.need)) and not arrays_overlap({inside}, c.bar))"
    kind = "array<struct<start:int,stop:int,family:int,coverage:double>>"
    apart = f"""aggregate(array_sort(candidates), cast(array() as {kind}), (a, c) -> if(exists(a, b -> b.start <= c.stop and c.start <= b.stop), a,
        concat(a, array(struct(c.start as start, c.stop as stop, c.family as family, c.coverage as coverage)))))"""
    hits = hits.withColumn("candidates", F.expr(found_here)).withColumn("candidates", F.expr(once)).withColumn("candidates", F.expr(stretch)).withColumn("candidates", F.expr(proven))
    whole = F.expr(f"cast(array(struct(hits[0].at, element_at(hits, -1).at, 0, 0.0D)) as {kind})")
    hits = hits.withColumn("notices", F.expr(apart)).withColumn("notice", F.explode(F.when(F.size("notices") > 0, F.col("notices")).otherwise(whole)))
    hits = hits.select("doc_id", "notice.*", F.expr("array_distinct(filter(hits, x -> x.at between notice.start and notice.stop).pair)").alias("hits"))

    table = F.expr(f"map_from_arrays({literal(model.pairs)}, {literal(model.weights.tolist())})")
    known = F.transform("hits", lambda p: F.element_at(table, p))
    scores = F.aggregate(known, F.expr(literal(model.bias.tolist())), lambda a, w: F.zip_with(a, w, lambda x, y: x + y))
    scored = hits.withColumn("scores", scores)
    parts = F.transform("scores", lambda s: F.exp(s - F.array_max("scores")))
    scored = scored.withColumn("parts", parts).withColumn("best", (F.array_position("parts", F.array_max("parts")) - 1).cast("int"))
    total = F.aggregate("parts", F.lit(0.0), lambda a, x: a + x)
    chosen = F.when(F.col("family") > 0, F.col("family")).otherwise(F.col("best"))
    scored = scored.withColumn("chosen", chosen).withColumn("probability", F.get("parts", "chosen") / total).where((F.col("chosen") > 0) & (F.col("probability") >= model.least))
    families = F.expr(literal(model.families))
    return scored.select("doc_id", F.col("start").alias("paragraph"), F.get(families, "chosen").alias("family"), "probability", "coverage", (F.col("family") > 0).alias("confirmed"))


def by_document(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_notices, licences, probability`` for every row of ``docs``: the number of
    confirmed notices, their families in order, and the largest probability among them.  Rows
    with the same id count as one document."""
    ids = columns_as(docs, doc_id=id_col).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    per = found.where("confirmed").groupBy(F.col("doc_id").alias("id")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("family")).alias("families"), F.max("probability").alias("probability")
    )
    return ids.join(per, ids["doc_id"].eqNullSafe(per["id"]), "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_notices"), F.coalesce("families", F.array().cast("array<string>")).alias("licences"), "probability"
    )
