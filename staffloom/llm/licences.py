"""Licence scan by a paragraph classifier, confirmed against templates.

A paragraph is a line of the text, a sentence of it, or a stretch of words that stand in
templates. Its features are the hashed runs of one to three words;
a softmax regression (`fit`) gives the odds of each licence family and of `unknown`. It is
trained on the templates below, cut, thinned and mixed with lines of the corpus, against a
bounded sample of the corpus's own lines (`max_documents` documents, the first by a hash of
the key) and templates with their words in disorder. The odds are calibrated on a part
held out of training, by one temperature; a family is predicted if its calibrated odds
reach one half. A prediction for a line or sentence counts only if at least `CONFIRMED` of
its runs of three words stand in a template of that family. Where neither is found, the
stretches are judged: runs that stand in templates, no more than `GAP` words apart. A
stretch counts if it holds `CONFIRMED` of the runs of one template of its family, or
`MATCHED` runs of them, so that notices inside a paragraph and their parts are found
whatever stands around. A whole line of one family is one span.

Since no line without a run of a template can be confirmed, such lines are not
classified; the outcome is the same (`plain=True` classifies them all).

Nulls: a NULL text is empty and holds none; a NULL key is passed through; repeated rows
give repeated rows; an empty table gives an empty result. Lines may be of any length.
Other columns are not looked at.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
# Notices by which public licences are known (fixed values).
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD License",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This article is published under the terms of CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "This article is published under the terms of CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "ISC License",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "MIT License",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "reserved": [
        "All rights reserved. No part of this publication may be reproduced, stored or transmitted in any form or by any means without the prior written permission of the publisher.",
        "All rights reserved. Reproduction without permission is prohibited.",
        "All rights reserved.",
    ],
}
FAMILIES = [*TEMPLATES, UNKNOWN]
PLACES = 1 << 16
MAX_DOCUMENTS = 400
LINES_PER_DOCUMENT = 8
VARIANTS = 60
CONFIRMED = 0.5
# Words between two runs of a stretch, and runs that tell without half a template.
GAP, MATCHED = 4, 8
EPOCHS, BATCH, RATE, PULL = 12, 64, 0.5, 1e-5
_WORD = re.compile(r"[0-9a-zß-￿]+(?:[.-][0-9a-z]+)*")
_SENTENCE = re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=[\"'(\[]*[A-Z])")


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def runs(words: list[str], n: int) -> set[tuple[str, ...]]:
    """Runs of `n` words; fewer words are one run."""
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


_RUNS = {
    f: set().union(*(runs(words_of(t), 3) for t in texts)) for f, texts in TEMPLATES.items()
}
_ANY = set().union(*_RUNS.values())
# Runs of each template; those of two words tell anywhere only as an identifier.
_WHOLE = {
    f: [r for t in texts if len(words_of(t)) > 2 or t.startswith("SPDX") for r in [runs(words_of(t), 3)]]
    for f, texts in TEMPLATES.items()
}
_PAIRS = {r for r in _ANY if len(r) == 2}
_SHORT = {r for sets in _WHOLE.values() for one in sets for r in one if len(r) < 3}


def contained(words: list[str], family: str) -> float:
    """The share of the line's runs of three words that stand in the family's templates."""
    own = runs(words, 3)
    return len(own & _RUNS[family]) / len(own) if own else 0.0


def places(words: list[str]) -> np.ndarray:
    grams = {" ".join(r) for n in (1, 2, 3) for r in runs(words, n)}
    return np.array(sorted({xxhash.xxh32_intdigest(g) % PLACES for g in grams}), np.int64)


@dataclass
class Classifier:
    weight: np.ndarray  # places x families
    bias: np.ndarray
    temperature: float = 1.0

    def odds(self, found: np.ndarray) -> np.ndarray:
        x = self.bias + (self.weight[found].sum(axis=0) / np.sqrt(len(found)) if len(found) else 0)
        x = (x - x.max()) / self.temperature
        return np.exp(x) / np.exp(x).sum()

    def family(self, line: str, plain: bool = False) -> str:
        """Family of a line, or `unknown`."""
        words = words_of(line)
        if not words or not (plain or runs(words, 3) & _ANY):
            return UNKNOWN
        odds = self.odds(places(words))
        best = int(odds.argmax())
        sure = odds[best] >= 0.5 and FAMILIES[best] != UNKNOWN
        return FAMILIES[best] if sure and contained(words, FAMILIES[best]) >= CONFIRMED else UNKNOWN


    def stretch(self, words: list[str]) -> str:
        """Family of a stretch of template words, or `unknown`."""
        odds = self.odds(places(words))
        best = int(odds.argmax())
        if odds[best] < 0.5 or FAMILIES[best] == UNKNOWN:
            return UNKNOWN
        own = {tuple(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}
        held = [(len(own & r), len(r)) for r in _WHOLE[FAMILIES[best]]]
        sure = any(n >= CONFIRMED * of for n, of in held) or len(own & _RUNS[FAMILIES[best]]) >= MATCHED
        return FAMILIES[best] if sure else UNKNOWN

    def parts(self, line: str, plain: bool = False) -> list[tuple[int, int, str]]:
        """(start, end, family) of what carries a licence in a line."""
        if not plain and not _touches(words_of(line)):
            return []
        found: list[tuple[int, int, str]] = []
        cuts = [m.span() for m in _SENTENCE.finditer(line)]
        for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(line)]):
            family = self.family(line[a:b], plain)
            new = [(a, b, family)] if family != UNKNOWN else self._stretches(line, a, b)
            for one in new:
                if found and found[-1][2] == one[2] and not words_of(line[found[-1][1] : one[0]]):
                    one = (found.pop()[0], *one[1:])
                found.append(one)
        whole = self.family(line, plain)
        if whole != UNKNOWN and {f for _, _, f in found} <= {whole}:
            return [(0, len(line), whole)]
        return found

    def _stretches(self, line: str, a: int, b: int) -> list[tuple[int, int, str]]:
        low = line[a:b].lower()
        if len(low) != b - a:  # a letter that is two in lower case
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line[a:b])
        found = list(_WORD.finditer(low))
        words = [m.group() for m in found]
        hits = [
            (i, i + n)
            for n, known in ((2, _SHORT), (3, _ANY))
            for i in range(len(words) - n + 1)
            if tuple(words[i : i + n]) in known
        ]
        joined: list[list[int]] = []
        for i, j in sorted(hits):
            if joined and i - joined[-1][1] <= GAP:
                joined[-1][1] = max(j, joined[-1][1])
            else:
                joined.append([i, j])
        judged = ((i, j, self.stretch(words[i:j])) for i, j in joined)
        return [(a + found[i].start(), a + found[j - 1].end(), f) for i, j, f in judged if f != UNKNOWN]


def _touches(words: list[str]) -> bool:
    """Whether any run of a template stands in the words."""
    if len(words) < 3:
        return tuple(words) in _ANY
    return not _ANY.isdisjoint(zip(words, words[1:], words[2:])) or not _PAIRS.isdisjoint(zip(words, words[1:]))


def examples(lines: list[str], seed: int = 5) -> tuple[list[list[str]], np.ndarray]:
    """Words and class of varied templates, of templates in disorder, and of `lines`."""
    rng = random.Random(seed)
    found: list[tuple[list[str], int]] = []
    other = [w for w in map(words_of, lines) if w]
    for k, texts in enumerate(TEMPLATES.values()):
        for text in texts:
            words = words_of(text)
            found.append((words, k))
            for _ in range(VARIANTS):
                # A line of the template as it may be wrapped, or more of it.
                start = rng.randrange(max(1, len(words) - 8))
                length = rng.randint(min(len(words), 8), len(words))
                part = [w for w in words[start : start + length] if rng.random() > 0.04] or words
                beside = rng.choice(other)[: rng.randint(0, 5)] if other and len(part) > 8 else []
                found.append((part + beside if rng.random() < 0.5 else beside + part, k))
            for _ in range(VARIANTS // 6):
                found.append((rng.sample(words, len(words)), len(TEMPLATES)))
    for words in other:
        if max(contained(words, f) for f in TEMPLATES) < CONFIRMED:
            found.append((words, len(TEMPLATES)))
    rng.shuffle(found)
    return [w for w, _ in found], np.array([k for _, k in found])


def fit(lines: list[str], seed: int = 5) -> Classifier:
    """Train on nine tenths of the examples, calibrate the temperature on the rest."""
    texts, classes = examples(lines, seed)
    rows = [places(w) for w in texts]
    last = len(rows) * 9 // 10
    n = len(FAMILIES)
    weight, bias = np.zeros((PLACES, n)), np.zeros(n)
    seen, seen_bias = np.full((PLACES, n), 1e-3), np.full(n, 1e-3)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(last)
        for at in range(0, last, BATCH):
            batch = order[at : at + BATCH]
            size = np.array([len(rows[i]) for i in batch])
            ids = np.concatenate([rows[i] for i in batch])
            doc = np.repeat(np.arange(len(batch)), size)
            part = 1 / np.sqrt(size)
            x = np.zeros((len(batch), n))
            np.add.at(x, doc, weight[ids])
            x = x * part[:, None] + bias
            p = np.exp(x - x.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), classes[batch]] -= 1
            touched, place = np.unique(ids, return_inverse=True)
            g = np.zeros((len(touched), n))
            np.add.at(g, place, (p * part[:, None])[doc] / len(batch))
            g += PULL * weight[touched]
            seen[touched] += g * g
            weight[touched] -= RATE * g / np.sqrt(seen[touched])
            gb = p.mean(axis=0)
            seen_bias += gb * gb
            bias -= RATE * gb / np.sqrt(seen_bias)
    made = Classifier(weight, bias)
    held = [(rows[i], classes[i]) for i in range(last, len(rows))]

    def loss(temperature: float) -> float:
        made.temperature = temperature
        return -sum(np.log(made.odds(r)[k] + 1e-12) for r, k in held)

    made.temperature = min([0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0], key=loss)
    return made


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_documents: int = MAX_DOCUMENTS
) -> Classifier:
    """Fit with lines of up to `max_documents` documents, the first by a hash of the key,
    `LINES_PER_DOCUMENT` of each, as examples of what is no licence."""
    ids = docs.select(F.col(key).alias("key")).dropna().distinct()
    ids = ids.orderBy(F.xxhash64("key"), "key").limit(max_documents)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(ids), "key")
    lines = F.slice(F.split("text", "\n"), 1, LINES_PER_DOCUMENT)
    heads = rows.dropna().select("key", F.transform(lines, lambda c: F.left(c, F.lit(1_000))).alias("lines"))
    # Of the texts of one key one teaches, however often the key is repeated.
    heads = heads.groupBy("key").agg(F.min(F.struct(F.xxhash64("lines").alias("h"), "lines")).alias("one"))
    told = heads.select(F.explode("one.lines").alias("line")).distinct()
    return fit(sorted(r["line"] for r in told.collect()))


def spans(text: str | None, classifier: Classifier, plain: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, family) of the lines of a whole text, or parts of them, that carry a
    licence."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        out += [(at + a, at + b, family) for a, b, family in classifier.parts(line, plain)]
        at += len(line) + 1
    return out


def scanned(
    df: DataFrame, classifier: Classifier, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_licences, families (in order, joined by commas), spans
    (family:start:end in text order)."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [spans(t, classifier) for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([len(s) for s in found], pa.int64()),
                pa.array([",".join(sorted({f for _, _, f in s})) for s in found], pa.string()),
                pa.array([",".join(f"{f}:{a}:{b}" for a, b, f in s) for s in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_licences", "families", "spans"])

    return rows.mapInArrow(run, f"`{key}` {kind}, n_licences bigint, families string, spans string")
