"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Words make five-word shingles.  A template of ``WINDOW`` shingles or more is retrieved by windows of so many; documents are seen through
windows of the same size at every place, so that some of them lie over any occurrence.  Shorter templates need no sketch: any shingle of
theirs retrieves them.  A window that holds at least 0.8 of a template's shingles has a Jaccard similarity of 2/3 or more with it; with bands of two rows
out of ``2 * BANDS`` it is missed with a probability of at most (1 - 4/9) ** BANDS, under one in ten thousand for 16 bands.
What is retrieved counts only if a stretch of as many shingles as the template has holds at least ``CONTAINMENT`` of its distinct ones.

A license has several templates: ``ID-whole`` is its whole text (``license_texts``), the others are its notices; a name begins with the
license's id.  ``SPDX-License-Identifier`` tags, which can be shorter than a shingle, are read as such and give ``ID-spdx``.

Templates are a fixed, small set, so their bands go to every task.  Documents are never shuffled and no sets are compared pairwise.

Null text: no licenses.  Texts of fewer than five words hold no shingle and match nothing but SPDX tags.  Rows are judged alone: repeated rows, null
and repeated doc_ids each give their row.  A very long text is a block of its own, scanned whole.  Other columns, whatever their names, are
not read.  Empty table: empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from loomchain.llm.common import blocks, table, texts

# Common public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

# Other wordings of the notices, by license; the list's places number the templates.  Each has five words at least.
NOTICES = {
    "AGPL-3.0": ["licensed under the GNU Affero General Public License", "GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache-2.0": ["under the Apache License, Version 2.0", "licensed under the Apache License 2.0", "licensed under the Apache 2.0 license", "released under the Apache License 2.0", "under the Apache 2.0 license", "under the Apache-2.0 License"],
    "BSD": ["licensed under the BSD License", "released under the BSD License", "governed by a BSD-style license", "under the 3-clause BSD license", "under the BSD 3-Clause License", "under the 2-clause BSD license", "under the BSD 2-Clause License", "distributed under the BSD License"],
    "CC-BY-4.0": ["licensed under a Creative Commons Attribution 4.0", "licensed under CC BY 4.0", "under the Creative Commons Attribution 4.0 International", "Creative Commons Attribution 4.0 International License", "creativecommons.org/licenses/by/4.0"],
    "CC-BY-NC-4.0": ["under the CC BY-NC 4.0 license", "Creative Commons Attribution-NonCommercial 4.0 International", "creativecommons.org/licenses/by-nc/4.0"],
    "CC-BY-SA-4.0": ["licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "creativecommons.org/licenses/by-sa/4.0"],
    "CC0-1.0": ["CC0 1.0 Universal Public Domain Dedication", "creativecommons.org/publicdomain/zero/1.0", "released under CC0 1.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License version 2", "either version 2 of the License, or (at your option) any later version", "licensed under the GPL v2", "is licensed under the GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License v3", "licensed under the GPL v3", "is licensed under the GPLv3", "released under the GPL v3", "released under the GNU GPL v3"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0", "licensed under the Boost Software License 1.0"],
    "EPL-2.0": ["under the terms of the Eclipse Public License 2.0", "under the terms of the Eclipse Public License v. 2.0", "licensed under the Eclipse Public License"],
    "ISC": ["licensed under the ISC License", "released under the ISC License", "distributed under the ISC License", "under the terms of the ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "licensed under the LGPL v2.1", "licensed under the LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License v3", "licensed under the LGPL v3", "is licensed under the LGPLv3"],
    "MIT": ["licensed under the MIT License", "distributed under the MIT License", "available under the MIT License", "provided under the MIT License", "published under the MIT License", "covered by the MIT License", "licensed under an MIT license", "licensed under the terms of the MIT license", "under the terms of the MIT license", "subject to the MIT License", "use of this source code is governed by an MIT-style license"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "licensed under the MPL 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "released under the Unlicense license"],
}
TEMPLATES |= {f"{name}-notice-{n}": text for name, held in NOTICES.items() for n, text in enumerate(held, 1)}


def all_templates() -> dict[str, str]:
    """The notices and the whole texts; the files are read by the driver alone."""
    return TEMPLATES | {f"{p.stem}-whole": p.read_text() for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


SHINGLE = 5
CONTAINMENT = 0.8
WINDOW = 16
#: Where short templates' shingles are kept among the bands: windows of one shingle.
SHORT = (1, -1)
BANDS = 16
#: Words that a worker's table of hashes may hold before it starts anew.
CACHE_ENTRIES = 100_000

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: A tag's ids end where its line does or another sign comes.
SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.I)
RESULT_SCHEMA = "doc_id long, n_licenses long, licenses string, places string"


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def spdx_tags(text: bytes) -> list[tuple[str, int, int]]:
    """(name, first word, word after the last) of the ids in SPDX tags; without exceptions, which follow WITH."""
    found = []
    for tag in SPDX.finditer(text):
        at, operand = tag.start(1), True
        for x in re.finditer(rb"[A-Za-z0-9.+-]+", tag[1]):
            if x[0] in (b"AND", b"OR", b"WITH"):
                operand = x[0] != b"WITH"
            elif operand:
                # What follows an id without an operator is no part of the expression.
                a = len(words_of(text[: at + x.start()]))
                if name := x[0].decode().strip(".-"):
                    found.append((f"{name}-spdx", a, a + len(words_of(x[0]))))
                operand = None
            elif operand is None:
                break
            else:
                operand = None
    return found


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(29))


def shingles(word_hashes: np.ndarray) -> np.ndarray:
    n = len(word_hashes) - SHINGLE + 1
    out = np.zeros(max(0, n), U)
    for i in range(SHINGLE):
        out = out * _BASE + word_hashes[i : i + len(out)]
    return _mixed(out)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def band_keys(hashes: np.ndarray, widths: Iterable[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(width, band, the keys of every window of ``width`` shingles)."""
    factors = np.random.default_rng(5).integers(0, 1 << 62, 2 * BANDS, dtype=U) * U(2) + U(1)
    for band in range(BANDS):
        one, two = (_mixed(hashes * f) for f in factors[2 * band : 2 * band + 2])
        for width in widths:
            if len(hashes) >= width:
                yield width, band, _mixed(_sliding_min(one, width) * _BASE + _sliding_min(two, width))


class Templates:
    """The templates' shingles and, for each window size and band, sorted keys with the templates they belong to."""

    def __init__(self, texts_of: dict[str, str], containment: float):
        self.names = sorted(texts_of)
        self.containment = containment
        words = WordHashes()
        self.parts = [shingles(np.fromiter((words[w] for w in words_of(texts_of[n].encode())), U)) for n in self.names]
        self.sets = [np.unique(p) for p in self.parts]
        self.widths = sorted({WINDOW for p in self.parts if len(p) >= WINDOW})
        found: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
        for t, p in enumerate(self.parts):
            if len(p) < WINDOW:
                found.setdefault(SHORT, []).append((self.sets[t], t))
            for width, band, keys in band_keys(p, self.widths):
                found.setdefault((width, band), []).append((np.unique(keys), t))
        self.bands = {}
        for at, own in found.items():
            keys, owner = np.concatenate([k for k, _ in own]), np.concatenate([np.full(len(k), t) for k, t in own])
            order = np.argsort(keys, kind="stable")
            self.bands[at] = keys[order], owner[order]
        # Which high bits any key has: one look-up rules out nearly every window.
        self.filters = {}
        for at, (keys, _) in self.bands.items():
            shift = U(64 - max(16, (16 * len(keys)).bit_length()))
            self.filters[at] = np.zeros(1 << (64 - int(shift)), bool), shift
            self.filters[at][0][(keys >> shift).astype(np.int64)] = True

    def retrieve(self, hashes: np.ndarray) -> set[tuple[int, int, int]]:
        """(width, template, window) that share a band key, or a shingle with a short template."""
        out: set[tuple[int, int, int]] = set()
        windows = [(SHORT, hashes)] if SHORT in self.bands else []
        for at, own in itertools.chain(windows, (((width, band), own) for width, band, own in band_keys(hashes, self.widths))):
            (keys, owner), (held, shift) = self.bands[at], self.filters[at]
            likely = np.flatnonzero(held[(own >> shift).astype(np.int64)])
            lo, hi = np.searchsorted(keys, own[likely], "left"), np.searchsorted(keys, own[likely], "right")
            for i in np.flatnonzero(hi > lo):
                out.update((at[0], int(t), int(likely[i])) for t in owner[lo[i] : hi[i]])
        return out

    def find(self, hashes: np.ndarray, starts: np.ndarray) -> list[dict[int, list[tuple[int, int]]]]:
        """For each document (its shingles from ``starts``): template -> (first shingle, last shingle) of its occurrences, which are disjoint."""
        out: list[dict[int, list[tuple[int, int]]]] = [{} for _ in starts[:-1]]
        # Where a document's shingles are a template's; None: not enough in the whole document, so no place in it has enough.
        held: dict[tuple[int, int], np.ndarray | None] = {}
        for width, t, at in sorted(self.retrieve(hashes), key=lambda x: x[2]):
            d = int(np.searchsorted(starts, at, "right")) - 1
            begin, need = int(starts[d]), self.containment * len(self.sets[t])
            if (t, d) not in held:
                near = begin + np.flatnonzero(np.isin(hashes[begin : starts[d + 1]], self.sets[t]))
                held[t, d] = near if len(np.unique(hashes[near])) >= need else None
            past = begin + out[d][t][-1][1] + 1 if t in out[d] else begin
            if (near := held[t, d]) is None or at < past:
                continue
            m = len(self.parts[t])
            lo, hi = max(past, at - m), min(int(starts[d + 1]), at + m + width)
            near = near[np.searchsorted(near, lo) : np.searchsorted(near, hi)]
            if len(np.unique(hashes[near])) >= need and (place := self._first(hashes[near], near, m, need)):
                out[d].setdefault(t, []).append((place[0] - begin, place[1] - begin))
        return out

    @staticmethod
    def _first(own: np.ndarray, near: np.ndarray, m: int, need: float) -> tuple[int, int] | None:
        """The first stretch of ``m`` shingles that holds enough of the template (``own``: its shingles, at ``near``), if there is any."""
        count: dict[int, int] = {}
        i = 0
        for j, x in enumerate(own.tolist()):
            count[x] = count.get(x, 0) + 1
            while near[j] - near[i] >= m:
                y = int(own[i])
                count[y] -= 1
                if not count[y]:
                    del count[y]
                i += 1
            if len(count) >= need:
                # To the stretch's end, from where it is still enough.
                end = int(np.searchsorted(near, near[i] + m)) - 1
                return int(near[i]), int(near[end])
        return None


def _scan(templates):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = templates.value, WordHashes()
        for _, ids, held in blocks(batches, 2 << 20):
            if len(words) > CACHE_ENTRIES:
                words.clear()
            parts = []
            for text in held:
                found = words_of(text)
                parts.append(shingles(np.fromiter(map(words.__getitem__, found), U, len(found))))
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            rows = []
            for at, text in zip(own.find(np.concatenate(parts), starts), held):
                # Places are words: from a shingle's first word to past another's last.
                found = sorted([(own.names[t], a, b + SHINGLE) for t, spans in at.items() for a, b in spans] + spdx_tags(text))
                names = list(dict.fromkeys(n for n, _, _ in found))
                rows.append((len(names), ",".join(names), ",".join(f"{n}:{a}:{b}" for n, a, b in found)))
            n, licenses, places = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(licenses), pa.array(places)], names=["doc_id", "n_licenses", "licenses", "places"])

    return run


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Per row of ``docs``: the templates found, by name, and every place where each stands (words, end exclusive)."""
    own = docs.sparkSession.sparkContext.broadcast(Templates(all_templates() if templates is None else templates, containment))
    return texts(docs).mapInArrow(_scan(own), RESULT_SCHEMA)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))
