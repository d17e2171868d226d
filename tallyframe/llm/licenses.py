"""Licence scan: a trained paragraph classifier whose predictions are confirmed against templates.

The classifier is a multinomial logistic regression over sparse word 1- and 2-grams, with a class for
paragraphs of no licence.  It is fitted on the driver from variations of the templates below and
from a bounded sample, ``PARAGRAPHS`` lines of at most ``SAMPLE`` documents; a held-out part of these
examples sets the temperature of its probabilities and the least probability that counts.

Every line of every document is classified, and so are windows of ``WINDOW`` words, overlapping by half,
of every paragraph (what stands between blank lines), for notices run over line breaks or stand inside
long lines.  n-grams that no template has weigh nothing, so a word costs a lookup.  Every family that is
likely enough against the unknown class is a prediction, so a notice may name two.

A prediction counts as confirmed if at least 0.8 of the five-word shingles of one of the family's
templates stand in the text, or 0.8 of the text's own in one template, where it is a part of a longer
one.  For windows the text is the run of windows with the prediction and half a window on either side.
Templates of under ``BRIEF`` words are confirmed only by a line of their very words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col, text_of

#: Documents of the fitting sample, the ones with the least hash.
SAMPLE = 400
#: Lines of them, the ones with the least hash, and the characters of the longest.
PARAGRAPHS, LINE_CHARS = 3000, 2000
#: Words of a window, and words from which a template may stand inside other text.
WINDOW, BRIEF = 32, 4
SHINGLE = 5
SIMILARITY = 0.8
#: Words from which a part of a longer template counts.
PART = 10
UNKNOWN = "unknown"
#: Public wordings of each licence family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "License: MIT",
        "MIT License",
        "The MIT License (MIT)",
        "licensed under either of Apache License, Version 2.0 or MIT license",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "License: Apache 2.0",
        "Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "License: GPLv3",
        "GPLv3",
        "GNU GENERAL PUBLIC LICENSE Version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "License: GPLv2",
        "GNU GENERAL PUBLIC LICENSE Version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "License: BSD",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "EPL-2.0": (
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ),
    "ISC": (
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
}
#: Everyday uses of the words of licences, which belong to no family.
ORDINARY = (
    "The driver lost the license after the accident and had to apply for a new one.",
    "The council granted a license to the restaurant under strict conditions.",
    "The general said that the public was free to use the new version of the park.",
    "A copy of the notice was sent to every person in the building.",
    "The program is available in four languages and runs every day.",
    "All rights of the members are described in the second part of the document.",
    "The work was released in two parts, and the second version was better.",
    "They were under no obligation to distribute the remaining copies.",
)
_LINE = b"\x01"
#: A-Z to lower case, ASCII marks to spaces; other bytes stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 or c == 1 else 32 for c in range(256))


def words_of(text: str | bytes) -> list[bytes]:
    """Folded words of a paragraph."""
    return (text.encode() if isinstance(text, str) else text).translate(_FOLD).split()


def _shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    k = min(SHINGLE, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


class Model(NamedTuple):
    """A fitted classifier; small whatever the corpus, for its features come from the templates."""

    families: list[str]
    unigrams: dict[bytes, int]
    bigrams: np.ndarray  # feature of a pair of unigrams, or -1
    weights: np.ndarray  # (features, classes)
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, ids: np.ndarray, paragraph: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """(paragraphs, classes) from the unigram ids (-1: none) of all words and their paragraph numbers."""
        known = ids >= 0
        one, at_one = ids[known], paragraph[known]
        pair = known[:-1] & known[1:] & (paragraph[:-1] == paragraph[1:])
        two = self.bigrams[ids[:-1][pair], ids[1:][pair]]
        at_two = paragraph[:-1][pair][two >= 0]
        score = np.zeros((len(n_words), len(self.bias)), np.float32)
        for features, at in ((one, at_one), (two[two >= 0], at_two)):
            if len(at):
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                score[at[first]] += np.add.reduceat(self.weights[features], first, axis=0)
        score = (score / np.sqrt(np.maximum(n_words, 1))[:, None] + self.bias) / self.temperature
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.unigrams.get
        return np.array([get(w, -1) for w in words], np.int64)


def _features(model: Model, examples: list[list[bytes]]) -> np.ndarray:
    """Dense design matrix of the (bounded) examples."""
    x = np.zeros((len(examples), len(model.weights)), np.float32)
    for i, words in enumerate(examples):
        ids = model.ids(words)
        np.add.at(x[i], ids[ids >= 0], 1)
        pair = (ids[:-1] >= 0) & (ids[1:] >= 0)
        two = model.bigrams[ids[:-1][pair], ids[1:][pair]]
        np.add.at(x[i], two[two >= 0], 1)
        x[i] /= np.sqrt(max(len(words), 1))
    return x


def _examples(prose: list[list[bytes]], rng: np.random.Generator, families: list[str]) -> tuple[list[list[bytes]], np.ndarray]:
    """Variations of the templates and ordinary paragraphs, with their classes."""
    out, label = [], []
    around = [w for p in prose for w in p] or words_of(" ".join(ORDINARY))
    some = lambda most: [around[i] for i in rng.integers(0, len(around), rng.integers(0, most + 1))]
    for family, wordings in TEMPLATES.items():
        for wording in wordings:
            words = words_of(wording)
            for k in range(24):
                kept = words
                if k and len(words) > 2 * PART and k % 2:
                    start = int(rng.integers(0, len(words) - PART))
                    kept = words[start : start + int(rng.integers(PART, len(words) - start + 1))]
                if k % 3 == 2:
                    kept = [w for w in kept if rng.random() > 0.08]
                most = 0 if k == 0 or len(words) < BRIEF else 4 if k % 4 else WINDOW // 2
                out.append(some(most) + kept + some(most))
                label.append(families.index(family))
            mixed = [w for w in words if rng.random() < 0.3] + some(12)  # its words without its wording
            out.append([mixed[i] for i in rng.permutation(len(mixed))])
            label.append(families.index(UNKNOWN))
    for paragraph in [*prose, *map(words_of, ORDINARY)]:
        out.append(paragraph)
        label.append(families.index(UNKNOWN))
    return out, np.array(label)


def train(prose: list[str], seed: int = 11, epochs: int = 30) -> Model:
    """Fit the classifier; ``prose`` are lines of the sample, those that hold a template's shingles left out."""
    rng = np.random.default_rng(seed)
    known = set().union(*(_shingles(words_of(t)) for ts in TEMPLATES.values() for t in ts))
    ordinary = [w for w in map(words_of, prose) if w and not known & _shingles(w)]
    families = [*TEMPLATES, UNKNOWN]
    texts = [words_of(t) for ts in TEMPLATES.values() for t in ts]
    unigrams = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    pairs = sorted({(unigrams[a], unigrams[b]) for t in texts for a, b in zip(t, t[1:], strict=False)})
    bigrams = np.full((len(unigrams), len(unigrams)), -1, np.int32)
    for i, (a, b) in enumerate(pairs):
        bigrams[a, b] = len(unigrams) + i
    n = len(unigrams) + len(pairs)
    model = Model(families, unigrams, bigrams, np.zeros((n, len(families)), np.float32), np.zeros(len(families), np.float32), 1.0, 0.5)
    examples, label = _examples(ordinary, rng, families)
    x, held = _features(model, examples), rng.random(len(label)) < 0.25
    w, b = model.weights.copy(), model.bias.copy()
    moment, second = np.zeros_like(w), np.zeros_like(w)
    rows, step = np.flatnonzero(~held), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(rows), max(1, len(rows) // 256)):
            p = _softmax(x[part] @ w + b)
            p[np.arange(len(part)), label[part]] -= 1
            g, step = x[part].T @ p / len(part) + 1e-5 * w, step + 1
            moment, second = 0.9 * moment + 0.1 * g, 0.99 * second + 0.01 * g * g
            w -= 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            b -= 0.05 * p.mean(axis=0)
    # calibration on the examples held out: the temperature of least loss, then the least probability that
    # keeps all but one in a thousand of the unknown ones out
    logits = x[held] @ w + b
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(held.sum()), label[held]] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))
    p = odds(_softmax(logits / temperature))
    false = np.sort(p.max(axis=1)[label[held] == families.index(UNKNOWN)])
    least = max(0.5, float(false[int(0.999 * (len(false) - 1))]) if len(false) else 0.5)
    return model._replace(weights=w, bias=b, temperature=temperature, least=min(least, 0.9))


def odds(p: np.ndarray) -> np.ndarray:
    """(texts, families) each family's probability against the unknown class alone, which comes last."""
    return p[:, :-1] / (p[:, :-1] + p[:, -1:] + 1e-30)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_TEMPLATE_SHINGLES = {family: [(words_of(t), _shingles(words_of(t))) for t in ts] for family, ts in TEMPLATES.items()}


def match(family: str, words: list[bytes], core: list[bytes] | None = None) -> tuple[float, set[int]] | None:
    """How well the best template of the family stands in the text, or the text (of a longer one, its ``core``) in a
    template, with the places of the shingles they share; None below ``SIMILARITY``."""
    core = words if core is None else core
    at = {k: [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] for k in range(1, SHINGLE + 1)}
    own, best = _shingles(core), None
    for spelt, template in _TEMPLATE_SHINGLES[family]:
        if len(spelt) < BRIEF:
            score = float(words == spelt)
        else:
            score = len(template.intersection(at[min(SHINGLE, len(spelt))])) / len(template)
            if len(core) >= PART and len(spelt) >= SHINGLE:
                score = max(score, len(template & own) / len(own))
        if score >= SIMILARITY and (best is None or score > best[0]):
            best = score, {i for i, x in enumerate(at[min(SHINGLE, len(spelt))]) if x in template}
    return best


def confirmed(family: str, words: list[bytes]) -> bool:
    return match(family, words) is not None


def _windows(line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, first word, end) of the windows of all paragraphs that are more than a line or a window, from the
    numbers of the words' lines, in which a blank line leaves a gap."""
    cut = np.flatnonzero(np.r_[True, np.diff(line) > 1, True])
    begin, end = cut[:-1], cut[1:]
    more = (end - begin > WINDOW) | (line[end - 1] > line[begin])
    begin, end = begin[more], end[more]
    n = np.maximum(-(-(end - begin) // (WINDOW // 2)) - 1, 1)
    which = np.repeat(np.arange(len(n)), n)
    first = begin[which] + (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)) * (WINDOW // 2)
    return which, first, np.minimum(first + WINDOW, end[which])


def scan_text(text: bytes, model: Model) -> tuple[int, int, int, str, float | None]:
    """(lines with a word, predictions, confirmed ones, confirmed families, highest probability of a confirmed one).

    A prediction is a line with likely families, or a run of windows with one that no line in it was confirmed to have."""
    words = text.replace(b"\n", b" " + _LINE + b" ").translate(_FOLD).split()
    ids = model.ids(words)
    mark = np.array([w == _LINE for w in words], bool) if _LINE in words else np.zeros(len(words), bool)
    keep = np.flatnonzero(~mark)
    if not len(keep):
        return 0, 0, 0, "", None
    ids, words = ids[keep], [words[i] for i in keep]
    line = np.cumsum(mark)[keep]
    _, number = np.unique(line, return_inverse=True)
    size = np.bincount(number)
    start = np.cumsum(np.r_[0, size])
    # (prediction, family, probability, how well it matches, where)
    claims: list[tuple[int, str, float, float, set[int]]] = []
    predicted = 0

    def claim(f: int, probability: float, low: int, high: int, core: list[bytes] | None = None) -> None:
        if best := match(model.families[f], words[low:high], core):
            claims.append((predicted, model.families[f], probability, best[0], {low + i for i in best[1]}))

    p = odds(model.probabilities(ids, number, size))
    last = -1
    for i, f in zip(*np.nonzero(p >= model.least), strict=True):
        predicted, last = predicted + (i != last), i
        claim(f, float(p[i, f]), int(start[i]), int(start[i + 1]))
    by_line: dict[str, set[int]] = {}
    for _, family, _, _, places in claims:
        by_line.setdefault(family, set()).update(places)
    which, first, end = _windows(line)
    if len(which):
        length = end - first
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first, length)
        p = odds(model.probabilities(ids[at], np.repeat(np.arange(len(first)), length), length))
        for f in np.flatnonzero((p >= model.least).any(axis=0)):
            hits = np.flatnonzero(p[:, f] >= model.least)
            breaks = np.flatnonzero((np.diff(hits) > 1) | (np.diff(which[hits]) != 0)) + 1
            for run in np.split(hits, breaks):
                a, b = int(first[run[0]]), int(end[run[-1]])
                own = np.searchsorted(which, [which[run[0]], which[run[0]] + 1])
                low, high = max(a - WINDOW // 2, int(first[own[0]])), min(b + WINDOW // 2, int(end[own[1] - 1]))
                if not by_line.get(model.families[f], set()).isdisjoint(range(low, high)):
                    continue  # its line was found
                predicted += 1
                claim(f, float(p[run, f].max()), low, high, words[a:b])
    # wordings of two families may differ in a number: of claims on the same words the better match stays
    at_place: dict[int, list] = {}
    for c in claims:
        for i in c[4]:
            at_place.setdefault(i, []).append(c)
    stay = [c for c in claims if not any(g[1] != c[1] and g[3] > c[3] and g[4] >= c[4] for g in at_place[min(c[4])])]
    found: dict[str, float] = {}
    for _, family, probability, _, _ in stay:
        found[family] = max(found.get(family, 0.0), probability)
    right = len({c[0] for c in stay})
    return len(size), int(predicted), right, ",".join(sorted(found)), max(found.values(), default=None)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
                 paragraphs: int = PARAGRAPHS) -> DataFrame:
    """One row per document: id, n_paragraphs, n_predicted, n_confirmed, families, probability.

    ``n_paragraphs`` counts the lines with a word, ``n_predicted`` and ``n_confirmed`` the predictions (see
    :func:`scan_text`).  ``families`` lists the confirmed families by name, empty if there are none; ``probability`` is
    the highest calibrated probability among them.  Null counts as the empty text; rows that repeat an id are scanned
    each on its own; an empty table gives an empty result.  The classifier is fitted on at most ``paragraphs`` lines, of
    at most ``LINE_CHARS`` characters, of at most ``sample`` documents.
    """
    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("t"))
    # the fitting sample: the least hashes first, so that only the lines of the sample travel
    hashed = rows.withColumn("h", F.xxhash64("id"))
    top = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    taken = []
    if top is not None:
        lines = hashed.filter(F.col("h") <= top).limit(sample).select(F.explode(F.split("t", "\n")).alias("line"))
        some = lines.filter(F.length("line").between(1, LINE_CHARS)).withColumn("h", F.xxhash64("line"))
        taken = some.orderBy("h", "line").limit(paragraphs).collect()
    model = train([r["line"] for r in taken])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t")
            found = [scan_text(texts[i].as_py(), model) for i in range(len(texts))]
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["id", "n_paragraphs", "n_predicted", "n_confirmed", "families", "probability"])

    return rows.select("id", F.col("t").cast("binary").alias("t")).mapInArrow(
        run, f"id {kind}, n_paragraphs long, n_predicted long, n_confirmed long, families string, probability double")
