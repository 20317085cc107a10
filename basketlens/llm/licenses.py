"""License notices in documents, found by conditional compression.

Around each cue word as many words as the longest template has, across line ends, make candidate blocks. A block is
compressed plainly and with each template it has enough words of as zstandard raw dictionary; the templates that save
most are then compared with the block word by word, and the one with the fewest wording differences is confirmed if
they are few and touch no number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from difflib import Match, SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import prepare, texts

# Wordings of public licenses, by SPDX identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation; either version 2 of "
                         "the License, or (at your option) any later version."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                         "the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.0."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.0."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.0."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the "
                          "GNU Lesser General Public License as published by the Free Software Foundation; either version "
                          "2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                          "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
                          "of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
]
# Identifiers that tags name, and the license that an opening names if this license's clause follows it.
TAGGED = ("MIT Apache-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only "
          "LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause "
          "BSD-3-Clause ISC MPL-2.0 EPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 "
          "CC-BY-NC-SA-4.0 Zlib BSL-1.0").split()
OPENINGS = {"Redistribution and use in source and binary forms": ("BSD-3-Clause", "Neither the name of")}
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in TAGGED]

#: A word; one that a line end cuts behind a hyphen goes on behind the marks that begin the next line.
WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+|-[^\S\n]*\n[^\w\n]*[^\W_]+)*")
CUT = re.compile(r"-\s[\W_]*")

#: Bytes that a template must save to be compared word by word, and the share of a template's words that may differ.
LEAST_SAVED, MAY_DIFFER = 4, 0.1
#: A high level: on short blocks a hasty search for matches would be noise in the ranking.
LEVEL = 19


@dataclass(frozen=True)
class Notice:
    start: int  # first character of the block in the text
    license: str
    template: int
    plain_bytes: int
    saved_bytes: int
    n_words: int
    n_different: int
    wording: str  # what differs: -template word, +word of the text


def _lower(word: str) -> str:
    return (CUT.sub("-", word) if "\n" in word else word).lower()


def words(text: str) -> list[str]:
    return [_lower(w) for w in WORD.findall(text)]


def may_differ(wanted: list[str]) -> int:
    return int(MAY_DIFFER * len(wanted))


def cue_words(templates: list[tuple[str, str]]) -> set[str]:
    """Words of the templates, of each template one more than may differ, so every notice has at least one of them."""
    wanted = [words(wording) for _, wording in templates]
    shared = Counter(w for want in wanted for w in set(want))
    cues: set[str] = set()
    for want in wanted:
        ranked = sorted(set(want), key=lambda w: (w not in cues, len(w) < 6, -shared[w], -len(w), w))
        cues.update(ranked[:may_differ(want) + 1])
    return cues


def cue_pattern(templates: list[tuple[str, str]]) -> str:
    """For Spark's regular expressions: a cue word, also one that a line end cuts at a hyphen."""
    parts = {max(re.split(r"-", w), key=len) for w in cue_words(templates)}
    return "(?iu)" + "|".join(re.escape(w) for w in sorted(parts))


def blocks(have: list[str], cues: set[str], longest: int) -> Iterator[tuple[int, int]]:
    """Ranges of words: ``longest`` words before and behind each cue, joined where they meet. A long one is cut into
    ranges that overlap by ``longest`` words, so none grows with the text and every notice lies whole in one."""
    first = last = None
    for i, word in enumerate(have):
        if word in cues:
            if last is not None and i - longest > last:
                yield from _cut(first, last, longest)
                first = None
            first = max(0, i - longest) if first is None else first
            last = min(len(have), i + longest + 1)
    if first is not None:
        yield from _cut(first, last, longest)


def _cut(first: int, last: int, longest: int) -> Iterator[tuple[int, int]]:
    while last - first > 4 * longest:
        yield first, first + 4 * longest
        first += 3 * longest
    yield first, last


class Scanner:
    def __init__(self, templates: list[tuple[str, str]]):
        self.templates = [(name, words(wording)) for name, wording in templates]
        self.bags = [Counter(want) for _, want in self.templates]
        self.cues = cue_words(templates)
        start = lambda begins: [i for i, (_, wording) in enumerate(templates) if wording.startswith(begins)]
        self.openings = {i: (name, set(start(clause))) for opening, (name, clause) in OPENINGS.items() for i in start(opening)}
        self.longest = max((len(want) + may_differ(want) for _, want in self.templates), default=0)
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.given = []
        for _, wording in self.templates:
            given = zstandard.ZstdCompressionDict(" ".join(wording).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=given))

    def possible(self, have: list[str]) -> list[int]:
        """Templates of whose words no more are missing than may differ."""
        bag = Counter(have)
        return [i for i, want in enumerate(self.bags)
                if sum(max(0, n - bag[w]) for w, n in want.items()) <= may_differ(self.templates[i][1])]

    def ranked(self, block: bytes, templates: list[int]) -> list[tuple[int, int]]:
        """(bytes saved, template), most saved first; ties in the order of the templates."""
        plain = len(self.plain.compress(block))
        return sorted(((plain - len(self.given[i].compress(block)), i) for i in templates), key=lambda x: (-x[0], x[1]))

    def nearest(self, template: int, have: list[str]) -> tuple[int, list[str], int] | None:
        """As ``differences``, at the first place from the longest common run on where few enough words differ."""
        want = self.templates[template][1]
        match, most = SequenceMatcher(None, want, have, autojunk=False), may_differ(want)
        # With so few differences some run of equal words is at least this long.
        least, ranges = max(1, -(-(len(want) - most) // (most + 1))), [(0, len(have))]
        while ranges:
            low, high = ranges.pop()
            anchor = match.find_longest_match(0, len(want), low, high)
            if anchor.size >= least:
                found = self.differences(template, have, anchor)
                if len(found[1]) <= most and not any(c.isdigit() for d in found[1] for c in d):
                    return found
                ranges += [(anchor.b + anchor.size, high), (low, anchor.b)]
        return None

    def differences(self, template: int, have: list[str], anchor: Match) -> tuple[int, list[str], int]:
        """Place of the template's nearest wording around a common run, what differs there, and the place behind it."""
        want = self.templates[template][1]
        first = max(0, anchor.b - anchor.a)
        last = min(len(have), anchor.b - anchor.a + len(want))
        slack = max(1, int(MAY_DIFFER * len(want)))
        best = None
        for a in range(max(0, first - slack), first + slack + 1):
            for b in {last, *((last + d) for d in range(-slack, slack + 1))} if slack <= 2 else {last - slack, last, last + slack}:
                if a < b <= len(have):
                    found = [f"{sign}{word}" for op, i, j, k, m in
                             SequenceMatcher(None, want, have[a:b], autojunk=False).get_opcodes() if op != "equal"
                             for sign, part in (("-", want[i:j]), ("+", have[a:b][k:m])) for word in part]
                    if best is None or len(found) < len(best[1]):
                        best = (a, found, b)
        return best or (0, [f"-{w}" for w in want], 0)

    def scan(self, text: str) -> list[Notice]:
        """All notices of a text, in its order: after one is confirmed, the rest of its block is searched again. Where
        blocks overlap, the nearest wording counts."""
        spans = [m.span() for m in WORD.finditer(text)]
        all_words = [_lower(text[a:b]) for a, b in spans]
        found: list[tuple] = []
        for part in blocks(all_words, self.cues, self.longest):
            parts = [part]
            while parts:
                low, high = parts.pop()
                have = all_words[low:high]
                possible = self.possible(have)
                if not possible:
                    continue
                raw = " ".join(have).encode("utf-8", "replace")
                plain, best = len(self.plain.compress(raw)), None
                for saved, template in self.ranked(raw, possible):
                    if saved < LEAST_SAVED:
                        break
                    near = self.nearest(template, have)
                    if near:
                        want = self.templates[template][1]
                        key = (len(near[1]) / len(want), -len(want), template)
                        if best is None or key < best[0]:
                            best = (key, *near, saved, template)
                if best:
                    key, a, different, b, saved, template = best
                    notice = Notice(spans[low + a][0], self.templates[template][0], template, plain, saved,
                                    len(self.templates[template][1]), len(different), " ".join(different))
                    found.append((key, low + a, low + b, notice))
                    parts += [(low, low + a), (low + b, high)]
        kept: list[tuple] = []
        taken = bytearray(len(spans))
        for key, a, b, notice in sorted(found, key=lambda f: f[:3]):
            if not any(taken[a:b]):
                taken[a:b] = b"\1" * (b - a)
                kept.append(notice)
        return self.told_apart(sorted(kept, key=lambda n: (n.start, n.template)))

    def told_apart(self, notices: list[Notice]) -> list[Notice]:
        """Openings that several licenses share take the name of that whose own clause follows before the next opening."""
        out = list(notices)
        for i, notice in enumerate(notices):
            if notice.template in self.openings:
                name, clauses = self.openings[notice.template]
                for later in notices[i + 1:]:
                    if later.template in self.openings:
                        break
                    if later.template in clauses:
                        out[i] = replace(notice, license=name)
                        break
        return out


SCHEMA = ("doc_id bigint, start bigint, license string, template int, plain_bytes int, saved_bytes int, n_words int, "
          "n_different int, wording string")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row for each notice: doc_id, start (character), license, template (its number), plain_bytes and
    saved_bytes of the block, n_words of the template, n_different and the differing words.

    Null and empty texts, and an empty table, give no rows. A notice that a text repeats gives a row for each place;
    repeated rows give repeated results; a null doc_id passes through. Whole texts are searched; of templates with
    equally few differences the longer one counts, then the first. An opening that licenses share (BSD) has the name of
    the one whose own clause follows. Other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int32()] * 5, pa.string()]
        for batch in batches:
            rows = [(doc_id, *vars(notice).values()) for doc_id, text in
                    zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for notice in scanner.scan(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).where(F.col("text").rlike(cue_pattern(templates))).mapInArrow(run, SCHEMA)
