"""Licence scan: a trained paragraph classifier.

A paragraph is a line. A notice may be wrapped over lines, or be anywhere in a
long one: templates are sought in the words of all lines up to one without
words, and a notice's paragraph is the line where it begins.

Words (letters, digits and non-ASCII bytes, A-Z in lower case) and word pairs
are hashed to ``FEATURES`` sparse features of a multinomial logistic regression
over licence families and ``unknown``. The model is trained here: on the
notices in ``NOTICES``, each also with words dropped, added or put into a longer
paragraph, against a bounded sample of paragraphs of the corpus
(``BACKGROUND_ROWS`` documents with the lowest hashes). A temperature fitted on
variants left out of training calibrates the probabilities, that of ``unknown``
among them.

A notice is reported wherever at least ``LEAST_OVERLAP`` of a template's word
pairs are within twice its length and 20 words, and its family is likelier than
``LEAST_PROBABILITY`` by the words of that match and ``MARGIN`` on each side. So
the rest of the paragraph doesn't count, and a paragraph may have several.

Families are those of ``NOTICES``, with the paragraphs of ``TEXTS`` where there is
a text. A match that is a licence by the classifier, but of no family that
likely, and a paragraph with ``LEAST_WORDS`` different words of licences within
``NEAR_WORDS`` are reported as ``unknown licence``.

Defined cases: a null or empty text has no paragraphs; lines without words are
not counted; null ids are scanned; repeated rows are reported alike; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import mix64, utf8
from docferry.llm.licence_texts import TEXTS
from docferry.llm.toxicity import tokens
from docferry.llm.words import word_hashes

FEATURES = 1 << 15
BACKGROUND_ROWS = 1_000
BACKGROUND_LINES = 3_000
VARIANTS = 40
LEAST_PROBABILITY = 0.5
LEAST_OVERLAP = 0.6
BLOCK_WORDS = 200_000
MARGIN = 2
UNKNOWN = "unknown"
OTHER = "unknown licence"
TEXT_VARIANTS = 4
LEAST_TEXT_WORDS = 8

# Short notices by which public licences are named in texts.
NOTICES = {
    "Apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License.",
               "SPDX-License-Identifier: Apache-2.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "This library is licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation.",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "AGPL": ["This work is licensed under the GNU Affero General Public License, version 3.",
             "SPDX-License-Identifier: AGPL-3.0-only"],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction.",
            "SPDX-License-Identifier: MIT"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met.",
            "Released under the BSD 3-Clause License.",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "SPDX-License-Identifier: CC-BY-ND-4.0",
                 "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA 4.0.", "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                    "International License."],
    "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND 4.0.", "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                    "International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
            "Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "All-Rights-Reserved": ["All rights reserved.",
                            "This document is confidential and proprietary and may not be reproduced without the prior "
                            "written permission of the copyright owner."],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License 2.0.",
            "Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0"],
    "Unlicense": ["Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"],
    "Zlib": ["Released under the zlib License.", "SPDX-License-Identifier: Zlib"],
    "BSL": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "BUSL": ["Licensed under the Business Source License 1.1.", "SPDX-License-Identifier: BUSL-1.1"],
    "CDDL": ["The contents of this file are subject to the terms of the Common Development and Distribution License.",
             "SPDX-License-Identifier: CDDL-1.0"],
    "EUPL": ["Licensed under the European Union Public Licence, version 1.2.", "SPDX-License-Identifier: EUPL-1.2"],
    "OFL": ["This Font Software is licensed under the SIL Open Font License, Version 1.1.",
            "SPDX-License-Identifier: OFL-1.1"],
    "ODbL": ["This database is made available under the Open Database License.", "SPDX-License-Identifier: ODbL-1.0"],
    "WTFPL": ["Do What The Fuck You Want To Public License", "SPDX-License-Identifier: WTFPL"],
    "GFDL": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
             "Documentation License.", "SPDX-License-Identifier: GFDL-1.3-or-later"],
    "Artistic": ["Licensed under the Artistic License 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    # Any other one; {} stands for words of its own.
    OTHER: ["Licensed under the {} License, version 2.0.", "This work is licensed under the {} License.",
            "Released under the {} License.", "Distributed under the {} License.",
            "Made available under the terms of the {} License.", "SPDX-License-Identifier: {}",
            "Use of this software is governed by the terms of the {} license agreement.",
            "By using this software you agree to be bound by the terms of this license.",
            "Permission to use, copy, modify and distribute this software and its documentation is hereby granted.",
            "You are granted a non-exclusive, non-transferable, revocable license to use the software.",
            "This software is provided as is without warranty of any kind, express or implied."],
}
# Words of licences: a paragraph with ``LEAST_WORDS`` different ones near each
# other is compared, too, if no template fits it.
WORDS = ("license licenses licensed licensee licensor licence licences sublicense copyright copyrighted copyrights "
         "warranty warranties redistribute redistributed redistribution redistributions merchantability "
         "noninfringement infringement patent patents liability liable permission permitted granted grant grants "
         "derivative disclaimer disclaims royalty irrevocable perpetual proprietary trademark trademarks rights "
         "reserved")
LEAST_WORDS = 4
NEAR_WORDS = 40
FAMILIES = [UNKNOWN, *NOTICES]
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _number_free(words: list[bytes]) -> list[bytes]:
    """Version numbers don't tell families apart."""
    return [b"0" if w.isdigit() else w for w in words]


def known_paragraphs(family: str) -> list[tuple[list[list[bytes]], int]]:
    """The family's notices, cut at words of their own, and the paragraphs of
    its texts; with the number of variants to train on."""
    found = [([_number_free(tokens(part.encode())) for part in notice.split("{}")], VARIANTS)
             for notice in NOTICES[family]]
    for text in TEXTS.get(family, []):
        words, _, block = blocks(text.encode())
        ends = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *ends], [*ends, len(words)], strict=True):
            if b - a >= LEAST_TEXT_WORDS:
                found.append(([words[a:b]], TEXT_VARIANTS))
    return found


def features(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each word, and of each pair (``FEATURES`` where the word is a
    paragraph's last one: a feature of weight 0)."""
    single = (mix64(hashes) & np.uint64(FEATURES - 1)).astype(np.int64)
    pair = np.full(len(hashes), FEATURES, np.int64)
    if len(hashes) > 1:
        mixed = mix64(hashes[:-1] * _P1 + hashes[1:] * _P2)
        pair[:-1] = (mixed & np.uint64(FEATURES - 1)).astype(np.int64)
        pair[ends - 1] = FEATURES
    return single, pair


def logits(weights: np.ndarray, bias: np.ndarray, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row for each paragraph (all have words). A paragraph's features are
    scaled by the root of its length, so long ones are no surer by length."""
    ends = np.cumsum(lengths)
    single, pair = features(hashes, ends)
    total = np.add.reduceat(weights[single] + weights[pair], ends - lengths, axis=0)
    return total / np.sqrt(lengths)[:, None].astype(np.float32) + bias


def train(background: list[list[bytes]], seed: int = 5, steps: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, bias and temperature from the notices and ordinary paragraphs."""
    rng = np.random.default_rng(seed)
    spare = [w for p in background for w in p[:20]] or [b"text"]
    xs, ys = [], []
    for y, family in enumerate(FAMILIES[1:], 1):
        for parts, variants in known_paragraphs(family):
            for n in range(variants + 1):
                words = parts[0]
                for part in parts[1:]:  # the place of words of its own
                    words = words + [spare[i] for i in rng.integers(0, len(spare), 1 + int(rng.integers(0, 4)))] + part
                if not n:
                    xs.append(words)
                    ys.append(y)
                    continue
                kept = [w for w in words if rng.random() > 0.08]
                pad = [spare[i] for i in rng.integers(0, len(spare), 2 * int(rng.integers(0, 12)))]
                xs.append(pad[: len(pad) // 2] + kept + pad[len(pad) // 2:])
                ys.append(y)
    for words in background:
        xs.append(words)
        ys.append(0)
    pairs = [(x, y) for x, y in zip(xs, ys, strict=True) if x]
    order = rng.permutation(len(pairs))
    held = set(order[: len(pairs) // 5].tolist())

    def arrays(chosen):
        lengths = np.array([len(pairs[i][0]) for i in chosen])
        hashes = word_hashes().of([w for i in chosen for w in pairs[i][0]])
        return hashes, lengths, np.array([pairs[i][1] for i in chosen])

    hashes, lengths, y = arrays([i for i in range(len(pairs)) if i not in held])
    k = len(FAMILIES)
    single, pair = features(hashes, np.cumsum(lengths))
    # Only features that occur are trained; the others keep weight 0.
    active, place = np.unique(np.concatenate([single, pair, [FEATURES]]), return_inverse=True)
    single, pair = place[:len(single)], place[len(single):-1]
    both = np.concatenate([single, pair])
    by_feature = np.argsort(both, kind="stable")
    firsts = np.flatnonzero(np.diff(both[by_feature], prepend=-1))
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(lengths)), lengths)
    scale = 1 / np.sqrt(lengths)
    w, bias = np.zeros((len(active), k)), np.zeros(k)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros(k), np.zeros(k)
    target = np.eye(k)[y]
    for t in range(1, steps + 1):
        z = np.add.reduceat(w[single] + w[pair], starts, axis=0) * scale[:, None] + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) / len(lengths)
        spread = (d * scale[:, None])[row]
        g = 1e-6 * w
        g[both[by_feature][firsts]] += np.add.reduceat(np.concatenate([spread, spread])[by_feature], firsts, axis=0)
        g[-1] = 0.0  # the place without a feature
        gb = d.sum(axis=0)
        mw, vw = 0.9 * mw + 0.1 * g, 0.99 * vw + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= 0.1 * (mw / a) / (np.sqrt(vw / b) + 1e-8)
        bias -= 0.1 * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    w[-1] = 0.0
    full = np.zeros((FEATURES + 1, k))
    full[active] = w
    w = full
    w, bias = w.astype(np.float32), bias.astype(np.float32)
    hashes, lengths, y = arrays(sorted(held))
    z = logits(w, bias, hashes, lengths)
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 41):
        s = z / temperature
        s = s - s.max(axis=1, keepdims=True)
        loss = float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())
        best = min(best, (loss, float(temperature)))
    return w, bias, best[1]


def pair_codes(hashes: np.ndarray) -> np.ndarray:
    """64-bit hash of each word and the next one."""
    return mix64(hashes[:-1] * _P1 + hashes[1:] * _P2)


class Templates:
    """The word pairs of every notice and where a text has enough of them."""

    def __init__(self) -> None:
        pairs: list[np.ndarray] = []
        self.family, self.reach, short = [], [], []
        seen = set()
        for y, family in enumerate(FAMILIES[1:], 1):
            for parts, variants in known_paragraphs(family):
                codes = np.unique(np.concatenate([pair_codes(word_hashes().of(words)) for words in parts]))
                if (y, codes.tobytes()) not in seen:
                    seen.add((y, codes.tobytes()))
                    pairs.append(codes)
                    self.family.append(y)
                    self.reach.append(2 * sum(map(len, parts)) + 20)
                    short.append(variants == VARIANTS)
        # Pairs that no other family has: a match of a notice has one of them
        # (if there are any), and so has one of a text's paragraph.
        self.own: list[set[int]] = []
        for k, codes in enumerate(pairs):
            others = [c for c, f, n in zip(pairs, self.family, short, strict=True) if f != self.family[k] and n == short[k]]
            self.own.append(set(np.setdiff1d(codes, np.concatenate(others)).tolist()))
        # The last one are the single words of licences.
        self.family.append(FAMILIES.index(OTHER))
        self.reach.append(NEAR_WORDS)
        pairs.append(np.unique(mix64(word_hashes().of(tokens(WORDS.encode())))))
        self.own.append(set())
        self.size = np.array([len(c) for c in pairs])
        self.need = np.minimum(np.ceil(self.size * LEAST_OVERLAP - 1e-9).astype(np.int64), self.size)
        self.need[-1] = LEAST_WORDS
        owner = np.repeat(np.arange(len(pairs)), self.size)
        codes = np.concatenate(pairs)
        order = np.argsort(codes, kind="stable")
        self.owner = owner[order]
        self.codes, self.first, self.count = np.unique(codes[order], return_index=True, return_counts=True)

    def _hits(self, hashes: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """template, position, pair: every pair of a template in the words, in
        order of template and position."""
        codes = np.concatenate([pair_codes(hashes), mix64(hashes)])
        place = np.concatenate([np.arange(len(hashes) - 1), np.arange(len(hashes))])
        whole = np.concatenate([block[:-1] == block[1:], np.ones(len(hashes), bool)])
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        where = np.flatnonzero((self.codes[at] == codes) & whole)
        at, where = at[where], place[where]
        n = self.count[at]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        t = self.owner[np.repeat(self.first[at], n) + step]
        order = np.argsort(t, kind="stable")
        return t[order], np.repeat(where, n)[order], np.repeat(at, n)[order]

    def matches(self, hashes: np.ndarray, block: np.ndarray, share: float = LEAST_OVERLAP):
        """(template, positions of its pairs, first and last position of its
        tightest window) wherever at least ``share`` of a template's pairs are
        within its reach and in one block."""
        if not len(hashes):
            return
        t, p, pair = self._hits(hashes, block)
        need = self.need if share == LEAST_OVERLAP else np.append(
            np.ceil(self.size[:-1] * share - 1e-9).astype(np.int64), LEAST_WORDS)
        reach = np.array(self.reach)
        last = np.arange(len(t)) + need[t] - 1
        inside = np.flatnonzero(last < len(t))
        last = last[inside]
        ok = (t[last] == t[inside]) & (block[p[last]] == block[p[inside]]) & (p[last] - p[inside] < reach[t[inside]])
        starts = inside[ok]
        for group in np.split(starts, np.flatnonzero(np.diff(t[starts])) + 1):
            if len(group):
                k = int(t[group[0]])
                end = int(np.searchsorted(t, k, side="right"))
                yield from self._windows(k, int(need[k]), group.tolist(), end, p, pair, block)

    def _windows(self, k: int, need: int, starts: list[int], end: int, p, pair, block):
        i = 0
        while i < len(starts):
            best, tight, j = None, None, i
            while j < len(starts) and p[starts[j]] < p[starts[i]] + self.reach[k]:
                row, seen = starts[j], {}
                first, stop = int(p[row]), int(p[row]) + self.reach[k]
                while row < end and p[row] < stop and block[p[row]] == block[first]:
                    if int(pair[row]) not in seen:
                        seen[int(pair[row])] = int(p[row])
                        if len(seen) == need and (tight is None or int(p[row]) - first < tight[1] - tight[0]):
                            tight = (first, int(p[row]))
                        top = row
                    row += 1
                if len(seen) >= need:
                    rank = (len(seen), first - int(p[top]))
                    if best is None or rank > best[0]:
                        best = (rank, starts[j], top, seen)
                j += 1
            if best is None:
                i = j
                continue
            _, low, top, found = best
            at = list(found.values())
            before = [s for s in starts[i:j] if s < low]
            if before:  # a lesser match before the best one
                yield from self._windows(k, need, before, low, p, pair, block)
            if tight[0] < at[0] or tight[1] > at[-1]:
                tight = (at[0], at[-1])
            if not self.own[k] or not self.own[k].isdisjoint(self.codes[list(found)].tolist()):
                yield k, at, *tight
            while i < len(starts) and starts[i] <= top:
                i += 1


@cache
def templates() -> Templates:
    return Templates()


def paragraphs(text: bytes) -> list[list[bytes]]:
    found = (_number_free(tokens(line)) for line in text.split(b"\n"))
    return [w for w in found if w]


def blocks(text: bytes) -> tuple[list[bytes], list[int], list[int]]:
    """Words, the number of each word's line and the block of lines: lines go
    on in the next one, up to a line without words."""
    words, lines, block = [], [], []
    n = b = 0
    for line in text.split(b"\n"):
        found = _number_free(tokens(line))
        if found:
            words += found
            lines += [n] * len(found)
            block += [b] * len(found)
            n += 1
        else:
            b += 1
    return words, lines, block


def _probabilities(model, hashes: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Of every family, for each range of words."""
    weights, bias, temperature = model
    lengths = np.array([b - a for a, b in ranges])
    z = logits(weights, bias, np.concatenate([hashes[a:b] for a, b in ranges]), lengths) / temperature
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def find(hashes: np.ndarray, block: np.ndarray, model, known: Templates) -> list[tuple[int, int, float, float]]:
    """(position, family, probability, overlap) of the notices in the words.
    Every template with enough pairs is weighed by its own words and a few
    around; of matches that share most of their pairs the largest is kept."""
    found = list(known.matches(hashes, block))
    if not found:
        return []

    def around(a: int, b: int) -> tuple[int, int]:
        low, high = max(a - MARGIN, 0), min(b + 2 + MARGIN, len(block))
        return (low + int(np.searchsorted(block[low:high], block[a])),
                low + int(np.searchsorted(block[low:high], block[a], side="right")))

    z = _probabilities(model, hashes, [r for _, at, a, b in found for r in (around(at[0], at[-1]), around(a, b))])
    family = np.array([known.family[k] for k, *_ in found])
    p = z[np.arange(len(z)), np.repeat(family, 2)].reshape(-1, 2).max(axis=1)
    licence = 1 - z[:, 0].reshape(-1, 2).min(axis=1)
    other = FAMILIES.index(OTHER)
    taken: set[int] = set()
    out = []
    # Known families first; what is left is the licence of another family, or
    # of one of several that the words don't tell apart.
    at_place: dict[int, list[int]] = {}
    for i, (_, at, *_) in enumerate(found):
        if family[i] != other:
            for x in at:
                at_place.setdefault(x, []).append(i)

    def shared(i: int) -> bool:
        """Another family's template fits the same words as well or better."""
        at, mine = found[i][1], len(found[i][1]) / known.size[found[i][0]]
        same = Counter(j for x in at for j in at_place[x] if family[j] != family[i])
        return any(2 * n > len(at) and len(found[j][1]) >= len(at) and len(found[j][1]) / known.size[found[j][0]] >= mine
                   for j, n in same.items())

    sure = [i for i in range(len(found)) if family[i] != other and p[i] >= LEAST_PROBABILITY and not shared(i)]
    rest = sorted(set(range(len(found))) - set(sure))
    for chosen, kind, chance in ((sure, family, p), (rest, np.full(len(found), other), licence)):
        for i in sorted(chosen, key=lambda i: (-len(found[i][1]), -chance[i], found[i][1][0], found[i][0])):
            k, at, *_ = found[i]
            if chance[i] < LEAST_PROBABILITY or 2 * sum(x in taken for x in at) > len(at):
                continue
            taken.update(range(min(at), max(at) + 1) if kind[i] == other else at)
            out.append((at[0], int(kind[i]), float(chance[i]), len(at) / int(known.size[k])))
    return sorted(out)


def scan_texts(texts: list[bytes], model, known: Templates) -> list[tuple[int, list[tuple[int, int, float, float]]]]:
    """For each text: its number of paragraphs, and the confirmed notices as
    (paragraph where it begins, family, probability, overlap)."""
    out = []
    words: list[bytes] = []
    place: list[tuple[int, int]] = []
    block: list[int] = []

    def flush():
        if words:
            for at, *hit in find(word_hashes().of(words), np.array(block), model, known):
                text, line = place[at]
                out[text][1].append((line, *hit))
        words.clear(), place.clear(), block.clear()

    for text in texts:
        found, lines, own = blocks(text)
        out.append((lines[-1] + 1 if lines else 0, []))
        base = block[-1] + 1 if block else 0
        words += found
        place += [(len(out) - 1, n) for n in lines]
        block += [base + b for b in own]
        if len(words) >= BLOCK_WORDS:
            flush()
    flush()
    return out


def background(docs: DataFrame, rows: int = BACKGROUND_ROWS, lines: int = BACKGROUND_LINES) -> list[list[bytes]]:
    """Ordinary paragraphs of a bounded sample; those that repeat a notice's
    words are left out.

    The sample is the ``rows`` documents, repeated rows once, with the lowest
    hashes, and of their lines those with the ``lines`` lowest hashes of the line
    and how often it was there before. Only hashes are sorted; texts are cut
    into lines in tasks, and only the lines of the sample reach the driver."""
    texts = docs.filter("text IS NOT NULL").select(F.col("text").cast("string").alias("text"),
                                                   F.xxhash64("doc_id", "text").alias("h"))
    lowest = texts.select("h").distinct().orderBy("h").limit(rows)

    def cut(batches):
        known = templates()
        for batch in batches:
            out = []
            for text in utf8(batch.column(0)):
                words, at_line, block = blocks(text)
                notices = {at_line[x] for _, at, *_ in known.matches(word_hashes().of(words), np.array(block), 0.5)
                           for p in at for x in (p, min(p + 1, len(words) - 1))}
                out += [b" ".join(w) for n, w in enumerate(paragraphs(text)) if n not in notices]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["line"])

    def deal(batches):
        for batch in batches:
            out = [(xxhash.xxh3_64_intdigest(line, seed=k).to_bytes(8, "big"), line)
                   for line, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                   for k in range(min(n, lines))]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in out], pa.binary()),
                                              pa.array([line for _, line in out], pa.binary())], names=["h", "line"])

    # ``rows`` hashes: small by construction.
    sample = texts.join(F.broadcast(lowest), "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))
    counted = sample.select("text").mapInArrow(cut, "line binary").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.mapInArrow(deal, "h binary, line binary").orderBy("h", "line").limit(lines).toArrow()
    return [line.split() for line in dealt.column("line").to_pylist()]


OUT = ("doc_id long, n_paragraphs int, "
       "findings array<struct<paragraph:int,family:string,probability:double,overlap:double>>")


def scan(docs: DataFrame, model) -> DataFrame:
    """One row for each document with the licences found in it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()),
                               ("probability", pa.float64()), ("overlap", pa.float64())]))

    def find(batches):
        known = templates()
        for batch in batches:
            found = scan_texts(utf8(batch.column(1)), shared.value, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int32()),
                 pa.array([[dict(paragraph=p, family=FAMILIES[f], probability=q, overlap=o)
                            for p, f, q, o in hits] for _, hits in found], kind)],
                names=["doc_id", "n_paragraphs", "findings"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(find, OUT)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Train on ``docs``' own background and scan them."""
    return scan(docs, train(background(docs)))
