"""Operator 4: licence scans by the Dice coefficient over word bigrams.

Texts are normalised (lower case, letters and digits only).  Every window of
consecutive words, over line and paragraph breaks, is compared with the
templates by multisets of bigrams.  With coefficient at least t a window has
t / (2 - t) to (2 - t) / t times the template's bigrams and at least the former
number in common; so it holds one of any set that is larger than the rest, and
texts without such rare bigrams are not looked at further.  Of templates that
reach the threshold at one place, the one furthest above it names the licence.
"""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sedimenta.llm.store import column

THRESHOLD = 0.8
_WORD = re.compile(r"[^\W_]+")

# Short notices and standard headers; whole texts are in licence_texts.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
}

# The GNU headers differ in the licence, its version and the mark before "either".
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
for _id, _kind, _version in (
        ("GPL-1.0", "GPL", "1"), ("GPL-2.0", "GPL", "2"), ("GPL-3.0", "GPL", "3"), ("LGPL-2.1", "LGPL", "2.1"),
        ("LGPL-3.0", "LGPL", "3"), ("AGPL-3.0", "AGPL", "3")):
    _what = "library" if _id == "LGPL-2.1" else "program"
    TEMPLATES[_id] = [f"This work is licensed under the {_GNU[_kind]}, version {_version}."] + [
        f"This {w} is free software: you can redistribute it and/or modify it under the terms of the {_GNU[_kind]} as published "
        f"by the Free Software Foundation, {either}" for w in dict.fromkeys((_what, "program")) for either in (
            f"either version {_version} of the License, or (at your option) any later version.", f"version {_version} of the License.")]
TEMPLATES["LGPL-2.0"] = [t.replace("Lesser", "Library").replace("2.1", "2") for t in TEMPLATES["LGPL-2.1"]]
for _short, _long in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _port in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES[f"CC-{_short}-{_version}"] = [
            f"Licensed under CC {_short} {_version}.",
            f"This work is licensed under a Creative Commons {_long} {_version} {_port} License."]
WHOLE = (
    "Apache-2.0", "Artistic-1.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0",
    "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense")
for _id in WHOLE:
    _text = pkgutil.get_data("sedimenta.llm", f"licence_texts/{_id}.txt").decode()
    TEMPLATES.setdefault(_id, []).append(_text)
    if "END OF TERMS AND CONDITIONS" in _text:
        # Often copied without the advice that follows.
        TEMPLATES[_id].append(_text[:_text.index("END OF TERMS AND CONDITIONS")])


def normal_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


# Words of notices that name no licence, and the most words of a notice.
GENERIC = frozenset(
    "a an and are available be distributed in international is it licence license licensed of program project released "
    "software terms the this under unported v version was work".split())
NOTICE = 20


class Index:
    """Templates by bigram, with the bigrams of which a match has one at least."""

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.threshold, self.rows, self.number, self.rare, bags = threshold, [], {}, {}, []
        for name, texts in sorted(templates.items()):
            for text in texts:
                words = normal_words(text)
                bag = Counter(zip(words, words[1:]))
                size = sum(bag.values())
                if not size:
                    continue
                least = int(np.ceil(threshold * size / (2 - threshold) - 1e-9))
                names = frozenset(words) - GENERIC if len(words) <= NOTICE else frozenset()
                left = size - least
                for b in sorted(bag, key=lambda b: (-len(b[0]) - len(b[1]), b)):
                    self.rare.setdefault(b, []).append(len(self.rows))
                    left -= bag[b]
                    if left < 0:
                        break
                for b in bag:
                    self.number.setdefault(b, len(self.number))
                self.rows.append((name, size, least, names))
                bags.append(bag)
        self.count = np.zeros((len(bags), len(self.number)), np.int16)
        for row, bag in zip(self.count, bags):
            for b, c in bag.items():
                row[self.number[b]] = c

    def windows(self, n: int, words: list[str], place: np.ndarray, number: np.ndarray):
        """(margin, coefficient, licence, start, end) of windows that reach the
        threshold; a better one that overlaps may leave lesser ones out."""
        name, size, least, names = self.rows[n]
        t = self.threshold
        hit = self.count[n][number] > 0
        h, g = place[hit], number[hit]
        if len(h) < least:
            return
        # A hit counts from start a on if as many equal ones as the template has lie not all behind a.
        order = np.argsort(g, kind="stable")
        at = np.arange(len(g))
        fresh = np.concatenate(([True], np.diff(g[order]) != 0))
        rank = at - np.maximum.accumulate(np.where(fresh, at, 0))
        cap = self.count[n][g[order]].astype(np.int64)
        full = rank >= cap
        earlier = np.full(len(h), -1)
        earlier[order[full]] = order[(at - cap)[full]]
        most = int(size * (2 - t) / t + 1e-9)
        starts = np.flatnonzero(np.searchsorted(h, h + most) - at >= least)
        ends = np.searchsorted(h, h + 2 * most)
        i, best, until = 0, t, -1
        while i < len(starts):
            a = starts[i]
            if h[a] >= until:
                best = t
            common = np.cumsum(earlier[a:ends[a]] < a)
            length = h[a:ends[a]] - h[a] + 1
            value = 2 * common / (length + size)
            bound = value.max()
            reached = np.flatnonzero(value >= max(t, best) - 1e-12)
            for j in reached[np.argsort(-value[reached], kind="stable")]:
                # What is shorter than a notice has to name the licence.
                if length[j] >= size or names <= set(words[h[a]:h[a] + length[j] + 1]):
                    yield 2 * common[j] - t * (length[j] + size), value[j], name, h[a], h[a] + length[j]
                    best, until = value[j], h[a] + length[j]
                    break
            # A start d words on gains at most the factor 1 + d / (least + size).
            d = min(most, (best / bound - 1) * (least + size) - 1e-6)
            # Beyond the best window only the threshold counts.
            d = min(d, max(until - h[a], (t / bound - 1) * (least + size) - 1e-6)) if until > h[a] else d
            i = max(i + 1, int(np.searchsorted(h[starts], h[a] + d)))

    def scan(self, text: str) -> dict[str, float]:
        """The licences found in a text, each with its best coefficient."""
        words = normal_words(text)
        pairs = list(zip(words, words[1:]))
        if self.rare.keys().isdisjoint(pairs):
            return {}
        number = np.array([self.number.get(b, -1) for b in pairs])
        place = np.flatnonzero(number >= 0)
        number = number[place]
        matches = []
        for n in sorted({n for b in pairs if b in self.rare for n in self.rare[b]}):
            if self.rows[n][2] <= len(pairs):
                matches += self.windows(n, words, place, number)
        found, kept = {}, []
        for m in sorted(matches, key=lambda m: (-m[0], m[2:])):
            margin, value, name, start, end = m
            if not any(k[0] > margin + 1e-9 and k[2] != name and k[3] < end and start < k[4] for k in kept):
                kept.append(m)
                found[name] = max(float(value), found.get(name, 0.0))
        return found


def _scan(batches, templates, threshold):
    index = Index(templates, threshold)
    for batch in batches:
        best, value, names = [], [], []
        for i in range(batch.num_rows):
            found = index.scan(batch.column(1)[i].as_py() or "")
            top = min(found, key=lambda k: (-found[k], k), default=None)
            best.append(top)
            value.append(round(found[top], 6) if top else 0.0)
            names.append(",".join(sorted(found)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(best, pa.string()), pa.array(value, pa.float64()), pa.array(names, pa.string())],
            ["doc_id", "licence", "dice", "licences"])


def licence_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, licence, dice, licences)`` per row of ``docs(doc_id, text)``.

    ``licence`` is the best template's (ties: the first name), NULL with
    ``dice`` 0 where none reaches the threshold, as for NULL and empty texts;
    ``licences`` lists the best of each place that does.  Rows are judged one by one, so repeated
    rows and NULL ids are fine; other columns are ignored.
    """
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return texts.mapInArrow(
        partial(_scan, templates=TEMPLATES if templates is None else templates, threshold=threshold),
        "doc_id long, licence string, dice double, licences string")
