"""License scan: MinHash bands over overlapping text windows, then exact containment (operator 4).

A template of m words belongs to a class of span S >= 1.25 m + 1 words.  Windows of a class
start every 2 ** k <= S / 4 words and are one such stride longer than S, so any occurrence of up to S words lies
whole in a window.  An occurrence that holds the share c of the template's t shingles gives the
two a Jaccard similarity of at least c t / (window's shingles + t - c t); a class has as many
bands (of one minhash each) as make the chance of missing that similarity at most MISS.  What
the bands retrieve is decided by the exact containment of shingles.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import map_rows
from tillcast.llm.graph import union_all
from tillcast.llm.shingles import WordHashes, gram_hashes, mix

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-4
BLOCK_TEMPLATES = 200
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SCHEMA = "doc_id long, template string, containment double, first_word int, words int"

#: Notices by which texts declare a license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so."),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "all-rights-reserved": "All rights reserved.",
    "GPL-2.0-or-later-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation."),
    "GPL-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details."),
    "LGPL-2.1-or-later-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0-or-later-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "AGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "MIT-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"),
    "BSD-3-Clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution"),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software."),
} | {
    f"CC-BY{code}-4.0-notice": (
        f"This work is licensed under a Creative Commons Attribution-{name} 4.0 International License.")
    for code, name in (("-SA", "ShareAlike"), ("-ND", "NoDerivatives"), ("-NC", "NonCommercial"),
                       ("-NC-SA", "NonCommercial-ShareAlike"), ("-NC-ND", "NonCommercial-NoDerivatives"))
} | {f"CC-BY{code}-4.0-short": f"Licensed under CC BY{code} 4.0." for code in ("-ND", "-NC-SA", "-NC-ND")}

#: Whole licenses, in license_texts.
BODIES = ("Apache-2.0", "Artistic", "CC0-1.0", "GFDL-1.3", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0")


def all_templates() -> list[tuple[str, str]]:
    """(name, text) of the notices and of the whole licenses."""
    whole = {f"{n}-whole": pkgutil.get_data("tillcast.llm", f"license_texts/{n}.txt").decode() for n in BODIES}
    return sorted((TEMPLATES | whole).items())


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters and digits; punctuation separates."""
    return re.sub(r"[\W_]+", " ", text.lower()).encode().split()


def band_count(template_shingles: int, window_shingles: int, contained: float, miss: float = MISS) -> int:
    """Bands of one minhash each that miss an occurrence with probability ``miss`` at most."""
    t, held = template_shingles, max(1, math.ceil(contained * template_shingles))
    s = held / (window_shingles + t - held)
    return 1 if s >= 1 else math.ceil(math.log(miss) / math.log(1 - s))


@dataclass(frozen=True)
class Template:
    name: str
    shingles: np.ndarray
    size: int             # words of a shingle
    span: int             # longest occurrence that a window is sure to hold whole

    @staticmethod
    def of(name: str, text: str, shingle: int) -> Template | None:
        h = WordHashes().of(words_of(text))
        if not len(h):
            return None
        size = min(shingle, len(h))
        need = math.ceil(1.25 * len(h)) + 1
        span = math.ceil(2 ** (math.ceil(2 * math.log2(need)) / 2))      # few classes: powers of sqrt 2
        return Template(name, np.unique(gram_hashes(h, size)), size, span)


@dataclass(frozen=True)
class Bands:
    """The windows and bands of one class, and the minima of its templates by band.  Every class takes
    the first of the same seeds, and its stride is a power of two."""
    size: int
    level: int            # windows start every 2 ** level shingles
    blocks: int           # strides that a window covers
    lows: np.ndarray      # (bands, templates)
    templates: tuple

    @staticmethod
    def of(templates: list[Template], contained: float) -> Bands:
        size, span = templates[0].size, templates[0].span
        level = max(1, span // 4).bit_length() - 1
        stride = 1 << level
        blocks = -(-(span + stride - size + 1) // stride)
        n = max(band_count(len(t.shingles), blocks * stride, contained) for t in templates)
        lows = np.array([[_permuted(t.shingles, s).min() for t in templates] for s in seeds(n)], np.uint64)
        return Bands(size, level, blocks, lows, tuple(templates))


def seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))


def _permuted(x: np.ndarray, seed) -> np.ndarray:
    return (x ^ seed) * (seed | np.uint64(1))


def _halved(low: np.ndarray) -> np.ndarray:
    """Minima of neighbouring pairs; an odd last one stays alone."""
    pairs = np.minimum(low[:-1:2], low[1::2])
    return np.append(pairs, low[-1]) if len(low) % 2 else pairs


def _window_minima(block: np.ndarray, blocks: int) -> np.ndarray:
    """Minimum of each run of ``blocks`` (fewer at the end), by doubling runs."""
    low, width = block, 1
    while width < blocks and width < len(block):
        by = min(width, blocks - width)
        wider = low.copy()
        np.minimum(low[:-by], low[by:], out=wider[:-by])
        low, width = wider, width + by
    return low


def retrieve(grams: np.ndarray, classes: list[Bands]) -> list[set]:
    """For each class the (first shingle of a window, template) pairs that agree in a band.

    The shingles are permuted once a seed for all classes, and the minima of coarser strides come
    from those of finer ones."""
    found: list[set] = [set() for _ in classes]
    none = grams == NONE
    p = np.empty_like(grams)
    for k, seed in enumerate(seeds(max(len(c.lows) for c in classes))):
        live = [(c, f) for c, f in zip(classes, found) if k < len(c.lows)]
        np.bitwise_xor(grams, seed, out=p)
        np.multiply(p, seed | np.uint64(1), out=p)
        p[none] = NONE
        low = p
        for level in range(max(c.level for c, _ in live) + 1):
            low = _halved(low) if level else low
            for c, f in live:
                if c.level == level:
                    window = _window_minima(low, c.blocks)
                    for j, v in enumerate(c.lows[k]):
                        f.update((int(i) << level, j) for i in np.flatnonzero(window == v))
    return found


def scan(texts: list[str], classes: list[Bands], hashes: WordHashes, contained: float):
    """(text, template, containment, first word, words) of the windows that hold a template.
    Texts are laid end to end; a shingle never spans two of them, and a window that does is
    judged by its part in each."""
    words = [hashes.of(words_of(t or "")) for t in texts]
    ends = np.cumsum([len(w) for w in words])
    flat, owner = np.concatenate(words) if words else np.empty(0, np.uint64), np.repeat(np.arange(len(words)), [len(w) for w in words])
    for size in sorted({c.size for c in classes}):
        mine = [c for c in classes if c.size == size]
        grams = gram_hashes(flat, size)
        if not len(grams):
            continue
        grams[owner[:len(grams)] != owner[size - 1:]] = NONE
        for c, pairs in zip(mine, retrieve(grams, mine)):
            for first, j in sorted(pairs):
                t, last = c.templates[j], min(len(grams), first + (c.blocks << c.level))
                for text in range(owner[first], owner[last - 1] + 1):
                    a, b = max(first, ends[text - 1] if text else 0), min(last, ends[text])
                    share = len(np.intersect1d(grams[a:b], t.shingles)) / len(t.shingles)
                    if share >= contained - 1e-12:
                        begin = int(ends[text - 1]) if text else 0
                        yield text, t.name, share, int(a) - begin, int(min(b + size - 1, ends[text]) - a)


def license_hits(docs: DataFrame, templates: list[tuple[str, str]] | None = None, shingle: int = SHINGLE,
                 contained: float = CONTAINED) -> DataFrame:
    """Windows that hold a template: doc_id, template, containment (share of the template's
    distinct shingles in the window), first_word, words (of the window).

    ``templates``: (name, text) pairs, by default all_templates().  They go to the tasks in blocks of
    BLOCK_TEMPLATES, each block reading the documents once; documents are never shuffled.
    Templates of fewer words than ``shingle`` are one shingle of all their words; those without
    words match nothing.  Null, empty or wordless texts have no window.  Null doc_id is carried;
    repeated rows give their hits each.  No rows on either side: no rows.  Other columns are
    ignored."""
    spark = docs.sparkSession
    known = [Template.of(n, x or "", shingle) for n, x in sorted(templates if templates is not None else all_templates())]
    known = [t for t in known if t]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    parts = []
    for at in range(0, len(known), BLOCK_TEMPLATES):
        by: dict = defaultdict(list)
        for t in known[at:at + BLOCK_TEMPLATES]:
            by[t.size, t.span].append(t)
        shared = spark.sparkContext.broadcast([Bands.of(ts, contained) for _, ts in sorted(by.items())])
        parts.append(map_rows(docs, _scanner(shared, contained), SCHEMA))
    return union_all(parts) if parts else spark.createDataFrame([], SCHEMA)


def _scanner(shared, contained: float):
    def make():
        hashes = WordHashes()

        def fn(cols):
            ids = cols["doc_id"].to_pylist()
            rows = [(ids[i], *rest) for i, *rest in scan(cols["text"].to_pylist(), shared.value, hashes, contained)]
            return {n: [r[k] for r in rows] for k, n in enumerate(("doc_id", "template", "containment", "first_word", "words"))}

        return fn
    return make


def licenses_of(docs: DataFrame, **how) -> DataFrame:
    """One row per document and template found: the best containment, where, and how many windows."""
    return (license_hits(docs, **how).groupBy("doc_id", "template")
            .agg(F.max(F.struct("containment", (-F.col("first_word")).alias("f"))).alias("b"),
                 F.count(F.lit(1)).alias("windows"))
            .select("doc_id", "template", F.col("b.containment").alias("containment"),
                    (-F.col("b.f")).alias("first_word"), "windows"))
