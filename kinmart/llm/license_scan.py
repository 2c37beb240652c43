"""License scans by patience alignment of texts with license templates.

Words that occur once in a stretch of text and once in the template are anchors. The longest
increasing run of anchors is kept, and the gaps between them are aligned in the same way. The
share of a template's words that find their place is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.files import rows_of

#: Templates of up to so many words are notices: they may hold half as many other words among
#: theirs, longer ones (wrapped, numbered, behind comment signs) twice as many.
NOTICE = 16
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Template:
    """``must`` are words without which an alignment does not speak for this license."""

    license: str
    name: str
    text: str
    must: tuple[str, ...] = ()


#: Notices, headers, grants and openings of whole licenses, as these word them (fixed values).
TEMPLATES = (
    Template("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0", ("apache",)),
    Template(
        "Apache-2.0",
        "header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
        ("apache",),
    ),
    Template("MIT", "notice", "Released under the MIT License", ("mit",)),
    Template("MIT", "notice-licensed", "Licensed under the MIT License", ("mit",)),
    Template(
        "MIT",
        "grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        ("sublicense",),
    ),
    Template(
        "ISC",
        "grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        ("fee",),
    ),
    Template(
        "BSD-2-Clause",
        "conditions",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
        ("redistributions",),
    ),
    Template(
        "GPL-3.0",
        "notice",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu", "general", "3"),
    ),
    Template(
        "GPL-3.0",
        "header",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        ("gnu", "general", "3"),
    ),
    Template(
        "MPL-2.0",
        "header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
        ("mozilla",),
    ),
    Template("CC-BY-4.0", "notice", "Licensed under CC BY 4.0", ("cc", "by", "4")),
    Template("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0", ("cc", "sa")),
    Template("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0", ("cc", "nc")),
    Template(
        "CC-BY-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative", "commons", "attribution"),
    ),
    Template(
        "BSD-3-Clause",
        "conditions",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
        ("redistributions", "neither", "endorse"),
    ),
    Template(
        "BSD-4-Clause",
        "conditions",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. All advertising materials mentioning features "
        "or use of this software must display the following acknowledgement: This product "
        "includes software developed by the organization. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        ("redistributions", "advertising", "neither", "endorse"),
    ),
    Template(
        "GPL-2.0",
        "notice",
        "This work is licensed under the GNU General Public License, version 2",
        ("gnu", "general", "2"),
    ),
    Template(
        "GPL-2.0",
        "header",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
        ("gnu", "general", "2"),
    ),
    Template(
        "GPL-2.0",
        "header-only",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software "
        "Foundation.",
        ("gnu", "general", "2"),
    ),
    Template(
        "GPL-2.0",
        "body",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software "
        "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
        ("general", "2", "1989"),
    ),
    Template(
        "GPL-3.0",
        "body",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software "
        "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
        ("general", "3", "2007"),
    ),
    Template(
        "LGPL-2.0",
        "header",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
        ("library", "general", "2"),
    ),
    Template(
        "LGPL-2.0",
        "body",
        "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991 Free Software "
        "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
        ("library", "general", "1991"),
    ),
    Template(
        "LGPL-2.1",
        "notice",
        "This work is licensed under the GNU Lesser General Public License, version 2.1",
        ("gnu", "lesser", "2", "1"),
    ),
    Template(
        "LGPL-2.1",
        "header",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
        ("gnu", "lesser", "2", "1"),
    ),
    Template(
        "LGPL-2.1",
        "body",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 "
        "Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim "
        "copies of this license document, but changing it is not allowed.",
        ("lesser", "2", "1999"),
    ),
    Template(
        "LGPL-3.0",
        "notice",
        "This work is licensed under the GNU Lesser General Public License, version 3",
        ("gnu", "lesser", "3"),
    ),
    Template(
        "LGPL-3.0",
        "header",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        ("gnu", "lesser", "3"),
    ),
    Template(
        "LGPL-3.0",
        "body",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free "
        "Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
        "of this license document, but changing it is not allowed.",
        ("lesser", "3", "2007"),
    ),
    Template(
        "AGPL-3.0",
        "notice",
        "This work is licensed under the GNU Affero General Public License, version 3",
        ("gnu", "affero", "3"),
    ),
    Template(
        "AGPL-3.0",
        "header",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        ("gnu", "affero", "3"),
    ),
    Template(
        "AGPL-3.0",
        "body",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free "
        "Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
        "of this license document, but changing it is not allowed.",
        ("affero", "3", "2007"),
    ),
    Template(
        "Apache-2.0",
        "body",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
        "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        ("apache", "january", "2004"),
    ),
    Template(
        "MPL-2.0",
        "body",
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each '
        "individual or legal entity that creates, contributes to the creation of, or owns Covered "
        "Software.",
        ("mozilla", "contributor", "2"),
    ),
    Template(
        "Unlicense",
        "grant",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
        "and by any means.",
        ("unencumbered",),
    ),
    Template(
        "0BSD",
        "grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted.",
        ("fee",),
    ),
    Template(
        "Zlib",
        "grant",
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software.",
        ("misrepresented",),
    ),
    Template(
        "BSL-1.0",
        "grant",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
        ("execute", "transmit"),
    ),
    Template(
        "EPL-2.0",
        "header",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        ("eclipse", "2"),
    ),
    Template(
        "CC0-1.0",
        "body",
        "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE "
        "LEGAL SERVICES.",
        ("cc0", "universal"),
    ),
    Template(
        "CC-BY-ND-4.0",
        "notice",
        "Licensed under CC BY-ND 4.0",
        ("cc", "nd"),
    ),
    Template(
        "CC-BY-NC-SA-4.0",
        "notice",
        "Licensed under CC BY-NC-SA 4.0",
        ("cc", "nc", "sa"),
    ),
    Template(
        "CC-BY-NC-ND-4.0",
        "notice",
        "Licensed under CC BY-NC-ND 4.0",
        ("cc", "nc", "nd"),
    ),
    Template(
        "CC-BY-SA-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
        ("creative", "commons", "sharealike"),
    ),
    Template(
        "CC-BY-NC-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License",
        ("creative", "commons", "noncommercial"),
    ),
    Template(
        "CC-BY-ND-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License",
        ("creative", "commons", "noderivatives"),
    ),
    Template(
        "CC-BY-NC-SA-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License",
        ("creative", "commons", "noncommercial", "sharealike"),
    ),
    Template(
        "CC-BY-NC-ND-4.0",
        "sentence",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives "
        "4.0 International License",
        ("creative", "commons", "noncommercial", "noderivatives"),
    ),
)


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def longest_rise(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly increasing run, by piles with back links."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        back[k] = at[pile - 1] if pile else -1
        tops[pile:] = [value] if pile == len(tops) else [value, *tops[pile + 1 :]]
        at[pile:] = [k] if pile == len(at) else [k, *at[pile + 1 :]]
    out = []
    k = at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def align(text: Sequence[bytes], template: Sequence[bytes]) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) that rise in both."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        once = {template[k]: k for k in range(c, d) if in_template[template[k]] == 1}
        anchors = [(k, once[text[k]]) for k in range(a, b) if text[k] in once and in_text[text[k]] == 1]
        rise = [anchors[k] for k in longest_rise([x[1] for x in anchors])]
        if not rise:
            continue
        pairs.extend(rise)
        edges = [(a - 1, c - 1), *rise, (b, d)]
        gaps.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]))
    return sorted(pairs)


def reaches(size: int) -> list[int]:
    """Spans in words to look for a template of ``size`` words in, the last one the largest."""
    return [size * k // 2 + 1 for k in ((2, 3) if size <= NOTICE else (2, 3, 4, 5, 6))]


class Scanner:
    """All templates over one shared vocabulary."""

    def __init__(self, templates: Sequence[Template], least: float):
        self.templates, self.least = templates, least
        self.words = [words_of(t.text) for t in templates]
        self.vocabulary: dict[bytes, int] = {}
        for word in (w for words in self.words for w in words):
            self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.member = np.zeros((len(templates), len(self.vocabulary) + 1), bool)
        for k, words in enumerate(self.words):
            self.member[k, [self.vocabulary[w] for w in words]] = True
        self.must = [[self.vocabulary[m.encode()] for m in t.must] for t in templates]

    def scan(self, text: str) -> list[tuple]:
        """(license, template, coverage, first_word, last_word): every place of each template.

        Of places of one template that overlap, the one that aligns most words counts, then the
        first of equals.

        An occurrence may span ``reaches`` words of the text at most, other words included. For
        each reach a template is tried on stretches that overlap by it, so every occurrence lies
        whole in one that is little longer, wherever it starts. A stretch without a ``must`` word
        or with fewer words of the template than coverage asks for is passed over.
        """
        words, out = words_of(text), []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        if not ids.any():
            return out
        present = np.zeros(len(self.vocabulary) + 1, bool)
        present[ids] = True
        for k, template in enumerate(self.templates):
            size = len(self.words[k])
            if not all(present[m] for m in self.must[k]):
                continue
            step = max(1, size // 2)
            starts = np.arange(0, max(1, len(words) - size), step)
            sums = np.r_[0, np.cumsum(self.member[k][ids])]
            musts = [np.r_[0, np.cumsum(ids == m)] for m in set(self.must[k])]
            limit, places, tried = reaches(size)[-1], set(), set()
            for reach in reaches(size):
                ends = np.minimum(starts + reach + step, len(words))
                hopeful = sums[ends] - sums[starts] >= self.least * size
                for must in musts:
                    hopeful &= must[ends] > must[starts]
                tried.update(zip(starts[hopeful].tolist(), ends[hopeful].tolist()))
            for start, end in sorted(tried):
                pairs = align(words[start:end], self.words[k])
                aligned = {self.vocabulary[self.words[k][q]] for _, q in pairs}
                coverage = len(pairs) / size
                if coverage < self.least or not aligned.issuperset(self.must[k]):
                    continue
                if pairs[-1][0] - pairs[0][0] >= limit:
                    continue
                places.add((-coverage, start + pairs[0][0], start + pairs[-1][0], len(pairs)))
            taken: list[tuple[int, int]] = []
            for cost, first, last, aligned in sorted(places):
                k = bisect_left(taken, (first,))
                apart = (k == len(taken) or taken[k][0] > last) and (not k or taken[k - 1][1] < first)
                if apart:
                    taken.insert(k, (first, last))
                    out.append((template.license, template.name, -cost, first, last, aligned))
        out.sort(key=lambda x: (x[3], x[4], x[0], x[1]))
        places_of: dict[tuple, list[tuple]] = {}
        for x in out:
            places_of.setdefault(x[:2], []).append((x[3], x[4], x[5]))
        return [x[:5] for x in out if not self.covered(x, places_of.values())]

    @staticmethod
    def covered(x: tuple, others: Iterable[list[tuple]]) -> bool:
        """Whether a place that holds that of ``x`` aligns more words; a template's don't overlap."""
        for own in others:
            k = bisect_left(own, (x[3] + 1,)) - 1
            if k >= 0 and own[k][1] >= x[4] and own[k][2] > x[5]:
                return True
        return False


def scan(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    least: float = 0.85,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, license, template, coverage, first_word, last_word) of every place of a template.

    A template is found where at least the share ``least`` of its words aligns, its ``must``
    words among them, within one and a half times (notices) or three times (longer ones) as
    many words as it has; places of one template don't overlap, the best and then first ones count. Inside a place where another
    template aligns more words it is not reported (CC BY inside CC BY-NC). Texts are scanned whole. Null and
    empty texts hold no license, null ids are passed on, repeated rows are scanned each.
    """
    names = ["doc_id", "license", "template", "coverage", "first_word", "last_word"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            out = []
            for row in rows_of(batch):
                out.extend((row["doc_id"], *found) for found in scanner.scan(row["text"] or ""))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds)], names=names
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(
        find,
        "doc_id long, license string, template string, coverage double, first_word long, "
        "last_word long",
    )
