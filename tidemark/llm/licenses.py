"""License scans: conditional compression, then exact wording differences."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, texts_of, text_or_empty

#: The notices by which a text states its license, in their public wording.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    ),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "MIT License",
    ),
    "ISC": (
        "Released under the ISC License.",
        "ISC License",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Every notice holds one of these words; a block without any cannot be one.
CUES = r"(?i)licen[sc]e|permission\W+(?:is\W+hereby|to\W+use)|redistribution\W+and\W+use|free\W+software|public\W+domain|released\W+under"
#: Words that tell licenses apart, as those with digits do too.
NAMES = {
    "affero", "apache", "attribution", "bsd", "by", "cc0", "endorse", "gnu", "isc", "lesser", "mit", "mozilla", "nc", "nd", "noderivatives", "noncommercial", "sa",
    "sharealike", "unencumbered", "unlicense",
}
#: Words that turn what follows into its opposite.
NEGATIONS = {"aren't", "cannot", "isn't", "neither", "never", "no", "nor", "not", "wasn't", "without"}

FOUND = "doc_id long, start long, end long, license string, form int, gain double, differing int, differences array<string>"


@dataclass(frozen=True)
class Settings:
    """A template is a candidate for a block if it saves ``gain`` of what it saves on its own
    wording. A notice may lack or change one word in ``words_per_difference``, and one if it has
    ``least_words``, but none of those that tell licenses apart. A negation up to ``lead``
    words before it in its sentence refuses it. SPDX lines are taken as they are or not."""

    gain: float = 0.35
    words_per_difference: int = 6
    least_words: int = 5
    lead: int = 6


@dataclass(frozen=True)
class Form:
    """One wording of a license's notice."""

    license: str
    number: int
    words: list[str]
    most: int  # words that may differ
    telling: set[str]
    with_it: zstandard.ZstdCompressor
    saved: int  # bytes that it saves on its own wording


class Matcher:
    """Templates as raw zstandard dictionaries, by the size of the blocks they are tried on."""

    def __init__(self, settings: Settings, templates=TEMPLATES):
        self.settings = settings
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.by_reach: dict[int, list[Form]] = {}
        for name, wordings in templates.items():
            spdx = words(f"SPDX-License-Identifier: {name}")
            forms = [self._form(name, k, words(w), None) for k, w in enumerate(wordings)]
            for form in [*forms, self._form(name, len(forms), spdx, 0)]:
                # Blocks reach a power of two to either side of the cue, so that few sizes are cut.
                self.by_reach.setdefault(1 << (len(form.words) + form.most - 1).bit_length(), []).append(form)

    def _form(self, name: str, k: int, ws: list[str], most: int | None) -> Form:
        data = " ".join(ws).encode()
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=3)
        with_it = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_dict_id=False)
        if most is None:
            most = max(len(ws) // self.settings.words_per_difference, int(len(ws) >= self.settings.least_words))
        telling = _names(ws) | {w for w in ws if any(c.isdigit() for c in w)}
        return Form(name, k, ws, most, telling, with_it, len(self.alone.compress(data)) - len(with_it.compress(data)))

    def ranked(self, own: list[str], at: int) -> list[tuple[int, float, Form, int, int]]:
        """The candidates of the blocks around the word ``at``, by the bytes they save: these,
        their share of what the template saves on itself, the template and the block."""
        out = []
        for reach, forms in self.by_reach.items():
            first, last = max(at - reach, 0), at + reach
            data = " ".join(own[first:last]).encode()
            plain = len(self.alone.compress(data))
            for form in forms:
                saved = plain - len(form.with_it.compress(data))
                if saved >= self.settings.gain * form.saved:
                    out.append((saved, saved / form.saved, form, first, last))
        # Of equal savings the shorter wording first: it has less that the block may lack.
        return sorted(out, key=lambda c: (-c[0], len(c[2].words), c[2].license, c[2].number))

    def notices(self, text: str, cue) -> Iterator[tuple]:
        """Bytes saved, start, end, license, form, gain, number of differences and differences
        of the best template that its wording confirms, for each cue outside earlier ones."""
        spots = [s for s in map(_bounds, WORDS.finditer(text)) if s[0] < s[1]]
        own, starts, upto = [text[a:b].lower() for a, b in spots], [a for a, _ in spots], 0
        for hit in cue.finditer(text):
            if hit.start() < upto or not spots:
                continue
            at = max(bisect_right(starts, hit.start()) - 1, 0)
            for saved, gain, form, first, last in self.ranked(own, at):
                found = self.confirmed(form, own[first:last], at - first)
                if found is None:
                    continue
                begin, end, steps = first + found[0], first + found[1], found[2]
                if self.denied(text, spots, own, begin):
                    break
                upto = spots[end - 1][1]
                yield saved, spots[begin][0], upto, form.license, form.number, gain, len(steps), [w for s in steps for w in s]
                break

    def confirmed(self, form: Form, own: list[str], at: int) -> tuple[int, int, list] | None:
        """Where the wording stands over the word ``at``, and its differences, if they are few
        and touch no word that tells licenses apart."""
        if not form.telling <= set(own):
            return None
        for found in aligned(form.words, own, at, form.most):
            block = own[found[0] : found[1]]
            if form.telling <= set(block) and _names(block) <= _names(form.words):
                return found
        return None

    def denied(self, text: str, spots, own: list[str], begin: int) -> bool:
        for i in range(begin - 1, max(begin - 1 - self.settings.lead, -1), -1):
            if SENTENCE_END.search(text, spots[i][1], spots[i + 1][0]):
                return False
            if own[i] in NEGATIONS:
                return True
        return False


def aligned(wording: list[str], own: list[str], at: int, most: int) -> Iterator[tuple[int, int, list[tuple[str, ...]]]]:
    """Where the whole wording stands in a block, over its word ``at``, with up to ``most``
    changes: start, end and each change as the words it lacks (-) and adds (+).

    Edit distance over words with free ends. Fewest changes come first, then the first end,
    each with its latest start; an end at an added word is none, so that nothing beside the
    notice is taken in.
    """
    # A cell holds changes * unit - start: the least is the one wanted.
    unit, n = len(own) + 1, len(wording)
    columns, ends = [[i * unit for i in range(n + 1)]], []
    for j, word in enumerate(own, 1):
        last, column = columns[-1], [-j]
        for i in range(n):
            column.append(min(last[i] + (word != wording[i]) * unit, last[i + 1] + unit, column[i] + unit))
        columns.append(column)
        changes = -(-column[n] // unit)
        if changes <= most and changes * unit - column[n] <= at < j and column[n] != last[n] + unit:
            ends.append((changes, j))
    for _, end in sorted(ends):
        i, j, steps = n, end, []
        while i:
            here, last = columns[j][i], columns[j - 1] if j else None
            if last and here == last[i - 1] + (own[j - 1] != wording[i - 1]) * unit:
                i, j = i - 1, j - 1
                if own[j] != wording[i]:
                    steps.append((f"-{wording[i]}", f"+{own[j]}"))
            elif last and here == last[i] + unit:
                j -= 1
                steps.append((f"+{own[j]}",))
            else:
                i -= 1
                steps.append((f"-{wording[i]}",))
        yield j, end, steps[::-1]


#: Words end at white space, hyphens and slashes, and are compared without the marks around them.
WORDS = re.compile(r"[^\s/-]+")
MARKS = "\"'(),.;:|*#$%&!<>`[]{}"
SENTENCE_END = re.compile(r"[.!?]\s")


def _bounds(m: re.Match) -> tuple[int, int]:
    word = m.group()
    bare = word.lstrip(MARKS)
    begin = m.end() - len(bare)
    return begin, begin + len(bare.rstrip(MARKS))


def words(text: str) -> list[str]:
    return [text[a:b].lower() for a, b in map(_bounds, WORDS.finditer(text)) if a < b]


def _names(ws: list[str]) -> set[str]:
    """The words that name a license; "by" is one only after "cc"."""
    return {w for before, w in zip(["", *ws], ws) if w in NAMES and (w != "by" or before == "cc")}


@cache
def _matcher(settings: Settings) -> Matcher:
    return Matcher(settings)


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per notice: its span in code points, license, gain and wording differences.

    The blocks around every cue are compressed with every template, over line breaks; the
    template that saves most and that the exact wording confirms wins. Of notices that overlap
    the one that saves most stays, then the first. Null and empty texts have no notices, rows
    that repeat an identifier are scanned each, a null identifier stays null. Time and memory
    grow with the number of cues, not with what lies between them.
    """
    cue = re.compile(CUES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(settings)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], texts_of(batch["text"])):
                taken: list[tuple] = []
                for hit in sorted(matcher.notices(text, cue), key=lambda h: (-h[0], h[1])):
                    if all(hit[2] <= t[0] or hit[1] >= t[1] for t in taken):
                        taken.append(hit[1:])
                rows += [(None if pd.isna(doc_id) else int(doc_id), *t) for t in sorted(taken)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.where(F.col("text").rlike(CUES)).mapInPandas(run, FOUND)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
