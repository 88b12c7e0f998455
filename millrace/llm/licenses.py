"""Licence notices in texts: a trained paragraph classifier, an unknown class, and a check against templates.

A paragraph is a line.  Its features are the word n-grams (1 to 3) that occur in the templates;
logistic regressions say whether it is a licence notice at all and which family it names.  They
are trained on varied templates, on corpus paragraphs that share words, but no phrase, with them,
and on their words out of order.  A notice is given a family only if the family's probability passes a bound calibrated on
families held out one at a time, its phrases agree with a template of that family, and phrases that
no other family has speak for it; otherwise it is ``unknown``.  The bound is calibrated on what decides, all three together.
Lines of a wrapped notice are pieces of a template and count each; they are trained on too.  If the line as a whole does not agree, the span of a template's length that
agrees best is judged by itself, so text around a notice does not hide it.

Rules: null and empty texts have no notices; case and punctuation do not count; every line counts
by itself, so a notice that occurs twice is found twice.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.linear import Rows, fit, sigmoid
from millrace.llm.store import named

UNKNOWN = "unknown"
#: Words of a feature at most.
SIZES = (1, 2, 3)
#: Texts whose paragraphs serve as negatives, on average, and how many of those paragraphs are used at most.
NEGATIVE_TEXTS = 3_000
NEGATIVES = 6_000
#: Varied copies of every template for training.
VARIANTS = 24
PENALTY = 1e-3
#: Least probability of being a notice, least share of a paragraph's phrases that its template has,
#: and share of the notices of families held out (with their relatives) that may be given a wrong family.
NOTICE = 0.5
AGREEMENT = 0.5
WRONG_FAMILY = 0.025
#: Words of a line of a wrapped notice.
LINE_WORDS = 11

# Common notices by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "Reserved": (
        "All rights reserved.",
        "Copyright (c) 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}


@dataclass
class Model:
    grams: np.ndarray  # sorted hashes of the templates' n-grams
    templates: np.ndarray  # templates x grams: which template has which
    family_of: np.ndarray  # family of each template
    sizes: np.ndarray  # words of each template
    families: list[str]
    notice: tuple[np.ndarray, float]
    family: tuple[np.ndarray, np.ndarray]  # grams x families, bias of each
    bound: float  # least probability of a family
    held_out: float  # share of held-out families' notices that would pass as another family
    only: np.ndarray  # the family that alone has a gram, -1 if several have it


def _paragraphs(column: pa.Array, known: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Of every block: text, line number, gram and n-gram counts of lines with a known gram.

    Yields ``(text, line, begin, gram, size)`` arrays: paragraph i has ``gram[begin[i]:begin[i+1]]``;
    ``size`` is the number of its words.  Without ``known`` all grams are kept.  The last array has
    the grams as they occur: rows of line (as paragraph i), gram, first word in the line and words.
    """
    newline = np.zeros(256, bool)
    newline[10] = True
    for begin, _, found in W.blocks(pc.utf8_lower(column.cast(pa.large_string())), W.NOT_ALNUM):
        lines = W.find(found.data, found.offsets, newline)
        if not len(found.starts):
            continue
        line = np.searchsorted(lines.starts, found.starts, "right") - 1
        hashes = found.hashes()
        owner, grams, spots = [], [], []
        for size in SIZES:
            gram = W.ngrams(hashes, size, 1)
            at = np.arange(len(gram))
            whole = line[at] == line[at + size - 1]
            if known is not None and len(known):
                place = np.searchsorted(known, gram)
                whole &= known[np.minimum(place, len(known) - 1)] == gram
            owner.append(line[at[whole]])
            grams.append(gram[whole])
            spots.append(np.stack([at[whole], np.full(int(whole.sum()), size)]))
        owner, gram = np.concatenate(owner), np.concatenate(grams)
        spots = np.concatenate(spots, axis=1)
        spots = np.stack([owner.astype(np.uint64), gram, (spots[0] - np.searchsorted(line, owner)).astype(np.uint64), spots[1].astype(np.uint64)])
        spots = spots[:, np.argsort(owner, kind="stable")]
        pairs = np.unique(np.stack([owner.astype(np.uint64), gram]), axis=1) if len(owner) else np.zeros((2, 0), np.uint64)
        owner, gram = pairs[0].astype(np.int64), pairs[1]
        ids, first = np.unique(owner, return_index=True)
        number = np.arange(len(lines.starts)) - np.repeat(lines.first[:-1], lines.counts)
        spots[0] = np.searchsorted(ids, spots[0].astype(np.int64))
        sizes = np.bincount(line, minlength=len(lines.starts))[ids]
        yield lines.text[ids] + begin, number[ids], np.append(first, len(gram)), gram, sizes, spots


def _grams_of(texts: list[str], known: np.ndarray | None = None) -> list[np.ndarray]:
    """The grams of each of some one-line texts."""
    out = [np.zeros(0, np.uint64)] * len(texts)
    for text, _, begin, gram, *_ in _paragraphs(pa.array(texts, pa.string()), known):
        for i, t in enumerate(text.tolist()):
            out[t] = gram[begin[i] : begin[i + 1]]
    return out


def _piece(text: str, pick: random.Random) -> str:
    """A line's worth of the text, as wrapped notices have it."""
    words = text.split()
    begin = pick.randrange(max(1, len(words) - LINE_WORDS + 1))
    return " ".join(words[begin : begin + LINE_WORDS])


def _names(only: np.ndarray, mine: np.ndarray, family: int) -> bool:
    """Whether grams that one family alone has speak for this one."""
    counts = np.bincount(only[mine][only[mine] >= 0], minlength=family + 1)
    return counts[family] > 0 and counts[family] == counts.max()


def _varied(text: str, noise: list[str], pick: random.Random) -> str:
    """The text with a few words lost, changed or put around it."""
    words = [w for w in text.split() if pick.random() > 0.08]
    words = [pick.choice(noise) if pick.random() < 0.04 else w for w in words]
    words = [pick.choice(noise) for _ in range(pick.choice((0, 0, 0, 2, 5)))] + words
    return " ".join(words + [pick.choice(noise) for _ in range(pick.choice((0, 0, 0, 2, 5)))])


def _fit_notice(lists: list[np.ndarray], families: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """A model of being a notice at all (family >= 0)."""
    weights, _, bias = fit(Rows(lists), np.zeros((len(lists), 0)), (families >= 0).astype(float), width, PENALTY, 150)
    return weights, bias


def _fit_families(lists: list[np.ndarray], families: np.ndarray, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A model for each family among the notices; one without notices says no."""
    notices = np.flatnonzero(families >= 0)
    rows, own, none = Rows([lists[i] for i in notices]), families[notices], np.zeros((len(notices), 0))
    weights, bias = np.zeros((width, count)), np.full(count, -30.0)
    for k in np.unique(own).tolist():
        weights[:, k], _, bias[k] = fit(rows, none, (own == k).astype(float), width, PENALTY, 150)
    return weights, bias


def learn(df: DataFrame, text: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES) -> Model:
    """Train on ``templates`` and on a bounded sample of the paragraphs of ``df``."""
    families = sorted(templates)
    flat = [(k, t) for k, f in enumerate(families) for t in templates[f]]
    family_of = np.array([k for k, _ in flat])
    own = _grams_of([t for _, t in flat])
    known = np.unique(np.concatenate(own))
    table = np.zeros((len(flat), len(known)), bool)
    for i, grams in enumerate(own):
        table[i, np.searchsorted(known, grams)] = True

    rows = named(df, text).filter(F.col(text).isNotNull())
    unit = F.pmod(F.xxhash64(F.col(text), F.lit(23)), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.filter(unit < NEGATIVE_TEXTS / max(rows.count(), 1))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for _, _, begin, gram, size, _ in _paragraphs(batch.column(0), known):
                for i in range(len(size)):
                    grams = np.searchsorted(known, gram[begin[i] : begin[i + 1]])
                    if table[:, grams].sum(axis=1).max() < max(3, size[i]):  # shares words, not phrases
                        lists.append(grams.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], ["grams"])

    found = sample.mapInArrow(near, "grams array<bigint>").distinct()
    lists = [np.array(r.grams) for r in found.orderBy(F.xxhash64("grams"), "grams").limit(NEGATIVES).collect()]
    pick = random.Random(11)
    noise = [f"word{i}" for i in range(50)] + [w for _, t in flat for w in t.split()]
    varied = [(k, _varied(t, noise, pick)) for k, t in flat for _ in range(VARIANTS)] + flat
    varied += [(k, _piece(t, pick)) for k, t in flat if len(t.split()) > 1.5 * LINE_WORDS for _ in range(VARIANTS)]
    # The templates' words out of order: words alone are no notice.
    bare = [w for _, t in flat for w in t.split()]
    mixed = [" ".join(pick.sample(bare, pick.randrange(1, 16))) for _ in range(len(flat) * VARIANTS)]
    lists += [np.searchsorted(known, g) for g in _grams_of(mixed, known)]
    negatives = len(lists)
    lists += [np.searchsorted(known, g) for g in _grams_of([t for _, t in varied], known)]
    target = np.array([-1] * negatives + [k for k, _ in varied])
    notice = _fit_notice(lists, target, len(known))
    family = _fit_families(lists, target, len(families), len(known))

    by_family = np.stack([table[family_of == k].any(axis=0) for k in range(len(families))]) if families else table
    only = np.where(by_family.sum(axis=0) == 1, by_family.argmax(axis=0), -1)
    # How sure the others are of a family that they were not shown: each is held out in turn.
    wrong: list[float] = []
    counts = _word_counts([t for _, t in varied])

    def alone_in(held: np.ndarray) -> np.ndarray:
        """The family that alone has a gram when those of ``held`` are not shown."""
        shown = by_family & ~held[:, None]
        return np.where(shown.sum(axis=0) == 1, shown.argmax(axis=0), -1)

    def agrees(grams: np.ndarray, words: int, k: int, alone: np.ndarray) -> bool:
        phrases = AGREEMENT * max(1, 3 * words - 3)
        return table[family_of == k][:, grams].sum(axis=1).max() >= phrases and _names(alone, grams, k)

    for k in range(len(families)):
        # Relatives, whose templates this family's own agree with, are held out with it.
        out = np.arange(len(families)) == k
        alone = alone_in(out)
        for t in np.flatnonzero(family_of == k):
            grams, words = np.flatnonzero(table[t]), _word_counts([flat[t][1]])[0]
            out |= np.array([j != k and agrees(grams, words, j, alone) for j in range(len(families))])
        out[k], alone = True, alone_in(out)
        shown = [i for i in range(negatives, len(lists)) if not out[target[i]]]
        weights, bias = _fit_families([lists[i] for i in shown], target[shown], len(families), len(known))
        for i in np.flatnonzero(target == k):
            shares = sigmoid(weights[lists[i]].sum(axis=0) + bias)
            named_as = int(shares.argmax())
            passes = not out[named_as] and agrees(lists[i], counts[i - negatives], named_as, alone)
            wrong.append(float(shares[named_as]) if passes else 0.0)
    wrong.sort()
    # The least bound that WRONG_FAMILY of them pass at most.
    held = wrong[max(0, len(wrong) - 1 - int(len(wrong) * WRONG_FAMILY))] if wrong else 0.0
    bound = max(0.5, float(np.nextafter(held, 2.0)))
    held_out = sum(x >= bound for x in wrong) / max(1, len(wrong))
    sizes = np.array([found.counts[0] for _, t in flat for *_, found in W.blocks(pa.array([t.lower()], pa.large_string()), W.NOT_ALNUM)])
    return Model(known, table, family_of, sizes, families, notice, family, bound, held_out, only)


def _word_counts(texts: list[str]) -> list[int]:
    return [int(n) for *_, found in W.blocks(pa.array([t.lower() for t in texts], pa.large_string()), W.NOT_ALNUM) for n in found.counts]


def _span(m: Model, place: np.ndarray, word: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How well each template agrees with the best span of its length, and the grams of the best of all."""
    agreement, best, most = np.zeros(len(m.sizes)), place[:0], (0.0, 0)
    for t in np.flatnonzero(m.templates[:, place].any(axis=1)).tolist():
        own, words = m.templates[t, place], int(m.sizes[t])
        starts = np.unique(word[own])
        held = np.zeros(len(starts), np.int64)
        for size in SIZES:
            mine = np.sort(word[own & (length == size)])
            held += np.searchsorted(mine, starts + words - size, "right") - np.searchsorted(mine, starts)
        phrases = max(1, 3 * words - 3)
        for i in np.argsort(-held, kind="stable").tolist():
            if held[i] / phrases <= agreement[t]:
                break  # repeats only lower a span's count
            within = (word >= starts[i]) & (word + length <= starts[i] + words)
            grams = np.unique(place[within])
            share = min(1.0, m.templates[t, grams].sum() / phrases)
            agreement[t] = max(agreement[t], share)
            if (share, words) > most:
                best, most = grams, (share, words)
    return agreement, best


def scan(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line, family, probability, agreement`` for every notice; lines with words count from 0."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as the templates
    rows = named(df, doc_id, text)
    key = rows.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        names = np.array([*m.families, UNKNOWN], object)
        for batch in batches:
            for text_at, line, begin, gram, size, spots in _paragraphs(batch.column(1), m.grams):
                if not len(size):
                    continue
                place = np.searchsorted(m.grams, gram)
                p = sigmoid(np.add.reduceat(m.notice[0][place], begin[:-1]) + m.notice[1])
                spot_at = np.searchsorted(spots[0], np.arange(len(size) + 1, dtype=np.uint64))
                spot_place = np.searchsorted(m.grams, spots[1])
                phrase = np.zeros(len(size), bool)
                phrase[spots[0][spots[3] == max(SIZES)].astype(np.int64)] = True
                spans = {}
                for i in np.flatnonzero((p >= NOTICE) | phrase).tolist():
                    own = slice(spot_at[i], spot_at[i + 1])
                    spans[i] = _span(m, spot_place[own], *spots[2:, own].astype(np.int64))
                    if p[i] < NOTICE and spans[i][0].max(initial=0) >= AGREEMENT:
                        p[i] = max(p[i], sigmoid(m.notice[0][spans[i][1]].sum() + m.notice[1]))
                some = np.flatnonzero(p >= NOTICE)
                best, agreement = np.full(len(some), len(m.families)), np.zeros(len(some))
                for j, i in enumerate(some.tolist()):
                    mine = place[begin[i] : begin[i + 1]]
                    shares = sigmoid(m.family[0][mine].sum(axis=0) + m.family[1])
                    k = int(shares.argmax())
                    # n words have 3n - 3 distinct grams at most.
                    phrases = max(1, 3 * int(size[i]) - 3)
                    agreement[j] = min(1.0, m.templates[m.family_of == k][:, mine].sum(axis=1).max() / phrases)
                    if shares[k] >= m.bound and agreement[j] >= AGREEMENT and _names(m.only, mine, k):
                        best[j] = k
                        continue
                    of, mine = spans[i]
                    shares = sigmoid(m.family[0][mine].sum(axis=0) + m.family[1])
                    k = int(shares.argmax())
                    if shares[k] >= m.bound and of[m.family_of == k].max() >= AGREEMENT and _names(m.only, mine, k):
                        best[j], agreement[j] = k, of[m.family_of == k].max()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text_at[some])),
                        pa.array(line[some].astype(np.int64)),
                        pa.array(names[best], pa.string()),
                        pa.array(p[some]),
                        pa.array(agreement),
                    ],
                    [doc_id, "line", "family", "probability", "agreement"],
                )

    return rows.mapInArrow(run, f"`{doc_id}` {key}, line bigint, family string, probability double, agreement double")
