"""License scans by conditional compression.

A block is a stretch of a text that some notice may stand in: one that keeps the share ``WORDING``
of its words misses at most the others, so enough of its content words must be close together,
in any order, whatever the line ends and the words between. Each block is compressed alone and with
every notice as a zstandard raw-content dictionary, and the notices are ranked by the bytes they
save. Down the ranking, the first whose wording stands there proposes a stretch. The stretch alone,
without the words around it, is compressed with all notices once more, and of those whose wording
stands there the one that saves most is reported. What is left of the block is a block again.

The wording is confirmed word by word, over line ends, and the words that differ are listed. It is
refuted by too few words in order, by other numbers (a version, a count of clauses), and for a
notice of fewer than ``EXACT`` words by any missing word.

Defined results: the place reported is the stretch from a notice's first word to its last; each
word counts for one notice; null and empty texts and texts without such places give no rows;
repeated rows give equal rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pulsemill.llm.decontaminate import PUNCTUATION, align, plain_words
from pulsemill.llm.frames import map_texts
from pulsemill.llm.quality import FUNCTION_WORDS
from pulsemill.llm.text import Words, split_words

# A notice must save this share of a stretch's plain size, and this share of its words must stand there.
GAIN = 0.15
WORDING = 0.8
# It must save a block this share of what the notice itself takes when compressed alone.
SAVES = 0.25
# Notices of fewer words must stand there with all of them.
EXACT = 8
# An alignment that keeps a notice's words adds less than twice their number, or its score would not be positive.
STRETCH = 3
# Longer regions are aligned in pieces of this many words, which overlap by a stretch.
PIECE = 4096

# The usual short notices, in the wording their stewards recommend, and one-line forms.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT (line)": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "Apache-1.1 (line)": "Licensed under the Apache License, Version 1.1.",
    "MIT (conditions)": "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.",
    "MIT (disclaimer)": "The software is provided as is, without warranty of any kind, express or implied, including but not limited to "
    "the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright "
    "holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out "
    "of or in connection with the software or the use or other dealings in the software.",
    "BSL-1.0 (line)": "Licensed under the Boost Software License, Version 1.0.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
    "http://www.boost.org/LICENSE_1_0.txt)",
    "Zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
    "available at https://www.eclipse.org/legal/epl-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "BSD (line)": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause (line)": "Licensed under the BSD 2-Clause License.",
    "BSD (conditions)": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause (endorsement)": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0 (line)": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0 (line)": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 (line)": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0 (line)": "Dedicated to the public domain under CC0 1.0.",
    "CC-BY-4.0 (line)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (line)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 (line)": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 (line)": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 (line)": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
# Identifiers of the short form of one line.
SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0",
        "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
        "MIT OR Apache-2.0", "Apache-2.0 OR MIT"]
TEMPLATES |= {f"{name} (SPDX)": f"SPDX-License-Identifier: {name}" for name in SPDX}


@dataclass
class Notice:
    """A template ready for use: words as text and as hashes, its content words and how many of them a copy needs, the bytes
    it takes alone, and a compressor with the template as its dictionary."""

    name: str
    words: list[str]
    hashes: np.ndarray
    content: np.ndarray
    need: int
    alone: int
    compressor: zstandard.ZstdCompressor


@dataclass
class Notices:
    """All templates, the hashes of their content words, and which of these each template has."""

    notices: list[Notice]
    content: np.ndarray
    member: np.ndarray
    plain: zstandard.ZstdCompressor


def _wording(text: str) -> list[str]:
    """Words without the case and punctuation that ``plain_words`` leaves out."""
    stripped = (re.sub(r"[.,;:!?\"'()\[\]{}<>*_#|]", "", w) for w in re.split(r"[\x20\x09-\x0D]+", text))
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in stripped if w]


def load_notices(templates: dict[str, str]) -> Notices:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        9, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    plain = zstandard.ZstdCompressor(compression_params=parameters)
    common, _ = plain_words(split_words(pa.array(sorted(FUNCTION_WORDS))))

    def load(name: str, text: str) -> Notice:
        hashes, _ = plain_words(split_words(pa.array([text])))
        missing = int(len(hashes) * (1 - WORDING) + 1e-9)
        content = hashes[~np.isin(hashes, common)]
        if len(content) <= missing:
            content = hashes
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=raw)
        alone = len(plain.compress(text.encode()))
        return Notice(name, _wording(text), hashes.view(np.int64), np.unique(content), len(content) - missing, alone, compressor)

    notices = [load(name, text) for name, text in templates.items() if _wording(text)]
    content = np.unique(np.concatenate([np.empty(0, np.uint64), *(x.content for x in notices)]))
    member = np.array([np.isin(content, x.content) for x in notices]).reshape(len(notices), len(content))
    return Notices(notices, content, member, plain)


def savings(stretch: bytes, notices: Notices) -> tuple[int, list[int]]:
    """The compressed size of a stretch alone, and the bytes that each notice saves as its dictionary."""
    alone = len(notices.plain.compress(stretch))
    return alone, [alone - len(x.compressor.compress(stretch)) for x in notices.notices]


def differences(notice: list[str], block: list[str]) -> list[str]:
    """Words that differ, as -missing and +added, in order: all but the longest sequence both have in common."""
    code = {w: i for i, w in enumerate(dict.fromkeys(notice + block))}
    there = np.array([code[w] for w in block], np.int64)
    common = np.zeros((len(notice) + 1, len(block) + 1), np.int64)
    for i, word in enumerate(notice, 1):
        longer = np.maximum(common[i - 1, 1:], common[i - 1, :-1] + (there == code[word]))
        common[i, 1:] = np.maximum.accumulate(longer)
    out, i, j = [], len(notice), len(block)
    while i or j:
        if i and j and notice[i - 1] == block[j - 1]:
            i, j = i - 1, j - 1
        elif j and common[i, j - 1] == common[i, j]:
            out.append(f"+{block[j - 1]}")
            j -= 1
        else:
            out.append(f"-{notice[i - 1]}")
            i -= 1
    return out[::-1]


def _numbers(changes: list[str], sign: str) -> list[str]:
    """The numbers in missing or added words; an address, which may be broken or moved, tells no version."""
    return [n for w in changes if w[0] == sign and "/" not in w for n in re.findall(r"[0-9]+", w)]


@dataclass
class Text:
    """The words of some texts that count, with the text each is in and where in the bytes it stands."""

    data: np.ndarray
    hashes: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def between(self, a: int, z: int) -> bytes:
        return self.data[self.starts[a] : self.ends[z - 1]].tobytes()


def _text_of(words: Words) -> Text:
    if not len(words.data):
        return Text(words.data, np.empty(0, np.uint64), *([np.empty(0, np.int64)] * 3))
    total = np.concatenate([[0], np.cumsum(~PUNCTUATION[words.data])])
    some = total[words.ends] > total[words.starts]
    hashes, owner = plain_words(words)
    return Text(words.data, hashes, owner, words.starts[some], words.ends[some])


def content_places(text: Text, notices: Notices) -> list[np.ndarray]:
    """Where each notice's content words stand."""
    if not len(notices.content) or not len(text.hashes):
        return [np.empty(0, np.int64) for _ in notices.notices]
    at = np.minimum(np.searchsorted(notices.content, text.hashes), len(notices.content) - 1)
    places = np.flatnonzero(notices.content[at] == text.hashes)
    which = at[places]
    return [places[member[which]] for member in notices.member]


def blocks(text: Text, notices: Notices, places: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(first word, end, limit) of stretches of one text that some notice may stand in; it is to start before the limit."""
    spans = []
    for notice, own in zip(notices.notices, places, strict=True):
        if len(own) < notice.need:
            continue
        first, last = own[: len(own) - notice.need + 1], own[notice.need - 1 :]
        reach = STRETCH * len(notice.words)
        close = (last - first < reach) & (text.owner[first] == text.owner[last])
        first, last = first[close], last[close]
        lo = np.maximum(first - reach, np.searchsorted(text.owner, text.owner[first]))
        hi = np.minimum(last + 1 + reach, np.searchsorted(text.owner, text.owner[first], side="right"))
        spans += zip(lo.tolist(), hi.tolist(), strict=True)
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if merged and lo < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    reach = STRETCH * max((len(x.words) for x in notices.notices), default=0)
    for lo, hi in merged:
        for a in range(lo, hi, PIECE):
            yield a, min(a + PIECE + reach, hi), min(a + PIECE, hi)


@dataclass
class Copy:
    """A notice whose wording stands in a text: its words, the bytes and the share it saves, and how it differs."""

    start: int
    end: int
    name: str
    saved: int
    gain: float
    share: float
    changes: list[str]

    @property
    def rank(self) -> tuple:
        return -self.saved, len(self.changes), self.name


def confirm(text: Text, notices: Notices, which: int, own: np.ndarray, lo: int, hi: int) -> Copy | None:
    """A copy of a notice in a block, if its wording stands there and saves enough of its stretch."""
    notice = notices.notices[which]
    rest = [(lo, hi)]
    while rest:
        a, z = rest.pop()
        if np.searchsorted(own, z) - np.searchsorted(own, a) < notice.need:
            continue
        best, start, end = align(notice.hashes, text.hashes[a:z].view(np.int64))
        if best <= 0:
            continue
        start, end = a + start, a + end
        # A copy may stand before or after an alignment that scores better and is none.
        rest += [(end, z), (a, start)]
        stretch = text.between(start, end)
        changes = differences(notice.words, _wording(stretch.decode()))
        missing = sum(w[0] == "-" for w in changes)
        share = 1 - missing / len(notice.words)
        if share < WORDING or (missing and len(notice.words) < EXACT) or _numbers(changes, "-") != _numbers(changes, "+"):
            continue
        alone = len(notices.plain.compress(stretch))
        saved = alone - len(notice.compressor.compress(stretch))
        if saved >= GAIN * alone:
            return Copy(start, end, notice.name, saved, saved / alone, share, changes)
    return None


def winner(text: Text, notices: Notices, places: list[np.ndarray], lo: int, hi: int) -> Copy | None:
    """The notice of a block that saves most, first of the block and then of the stretch where its wording stands."""
    _, saved = savings(text.between(lo, hi), notices)
    for i in sorted(range(len(saved)), key=lambda i: (-saved[i], i)):
        if saved[i] < SAVES * notices.notices[i].alone:
            continue
        found = confirm(text, notices, i, places[i], lo, hi)
        if found is None:
            continue
        _, again = savings(text.between(found.start, found.end), notices)
        best = found
        for j, bytes_saved in enumerate(again):
            if j != i and bytes_saved >= found.saved:
                other = confirm(text, notices, j, places[j], lo, hi)
                if other and other.start < found.end and found.start < other.end and other.rank < best.rank:
                    best = other
        return best
    return None


def find_copies(text: Text, notices: Notices) -> list[Copy]:
    """The notices in texts, by place; each word counts for one notice."""
    places = content_places(text, notices)
    out: list[Copy] = []
    taken = 0
    for lo, hi, limit in blocks(text, notices, places):
        # A piece begins after what the piece before it found.
        rest = [(max(lo, taken), hi)]
        while rest:
            a, z = rest.pop()
            if a >= min(z, limit):
                continue
            found = winner(text, notices, places, a, z)
            if found is None:
                continue
            rest.append((a, found.start))
            # What starts beyond the limit stands whole in the next piece.
            if found.start < limit:
                out.append(found)
                taken = max(taken, found.end)
                rest.append((found.end, z))
    return sorted(out, key=lambda x: x.start)


ROWS = "block_start bigint, block_end bigint, license string, gain double, wording double, differences string"


def find_licenses(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, block_start, block_end, license, gain, wording, differences), places in code points of the text."""

    def scan(batch: pa.RecordBatch, notices: Notices) -> pa.RecordBatch:
        words = split_words(batch["text"])
        text = _text_of(words)
        rows, out = [], []
        heads = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
        for x in find_copies(text, notices):
            row = int(text.owner[x.start])
            begin = heads[words.offsets[row]]
            rows.append(row)
            block = (int(heads[text.starts[x.start]] - begin), int(heads[text.ends[x.end - 1]] - begin))
            out.append((*block, x.name, x.gain, x.share, " ".join(x.changes)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        names = ["doc_id", "block_start", "block_end", "license", "gain", "wording", "differences"]
        return pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(rows, pa.int64())), *arrays], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    wanted = dict(TEMPLATES if templates is None else templates)
    return map_texts(documents.select("doc_id", "text"), scan, f"doc_id {kind}, {ROWS}", prepare=lambda: load_notices(wanted))
