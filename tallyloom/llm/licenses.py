"""License scan by conditional compression.

Candidate blocks are runs of lines around lines with a cue word. A block is compressed
alone and once with each template as a raw zstandard dictionary. The bytes saved are
taken as a share of the template's own compressed size: text around the
license does not change that. Every template that saves enough, or stands in the block word for word, is then aligned
word by word, wherever in the block it may fit; a license is
confirmed if the block has the template's words up to a few differences, and
none of the differences is in a word that tells licenses apart. SPDX lines are read as they are written.
Of confirmed licenses that claim the same words, the one that explains most of them with the fewest differences stays.

Templates are notices, headers, whole short licenses, and the titles and first sentences of long ones: a full text begins with them.

Equal blocks are judged once. Defined cases: null and empty texts have no licenses; rows that
repeat or lack a doc_id each get a row; a template may be confirmed several times in one text and counts
once; ties go to the name first in the alphabet; extra columns are ignored.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.frames import small, written

CUES = r"(?i)licen[cs]e|copyright|disclaim|endors|spdx|permission|warrant|redistribut|public domain|creative ?commons|\bCC[ -](BY|0)|merchantab"
GAP = 3  # lines without a cue that may stand inside a block
MIN_SAVED = 0.3
MISSING = 0.1  # share of the template's words that may differ
BROADCAST_BLOCKS = 64_000_000  # bytes of judged blocks; more are joined by a shuffle

# Notices and license texts with their SPDX names.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Licensed under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."],
    "CC0-1.0": ["Licensed under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
}
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.")
_BSD_END = ("This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not "
            "limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.")
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.",
    "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.")
_VERBATIM = ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.")


def _gnu(kind: str, version: str, what: str = "program", semicolon: str = ";") -> str:
    return (f"This {what} is free software{semicolon} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
            f"the Free Software Foundation{',' if semicolon == ':' else ';'} either version {version} of the License, or (at your option) any later version.")


def _cc(kind: str) -> list[str]:
    return [f"This work is licensed under a Creative Commons {kind} 4.0 International License.",
            f"This work is licensed under the Creative Commons {kind} 4.0 International License.",
            f"Licensed under Creative Commons {kind} 4.0 International.",
            f"By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative "
            f"Commons {kind} 4.0 International Public License (\"Public License\")."]


# The usual headers, and whole texts or their beginnings, in further wordings.
_MORE = {
    "MIT": ["The MIT License (MIT)", "Licensed under the MIT license (the \"License\"); you may not use this file except in compliance with the License."],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "
        "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License."],
    "GPL-3.0": [
        _gnu("General Public License", "3"),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, version 3.",
        f"GNU General Public License Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM} Preamble "
        "The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as "
        "published by the Free Software Foundation.",
        f"GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_VERBATIM}",
        "GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, "
        f"Boston, MA 02110-1301 USA {_VERBATIM}"],
    "LGPL-2.1": [
        _gnu("Lesser General Public License", "2.1", "library"), _gnu("Lesser General Public License", "2.1"),
        f"GNU Lesser General Public License Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. {_VERBATIM}",
        "GNU Lesser General Public License Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51 Franklin Street, "
        f"Fifth Floor, Boston, MA 02110-1301 USA {_VERBATIM}"],
    "AGPL-3.0": [
        _gnu("Affero General Public License", "3", semicolon=":"), _gnu("Affero General Public License", "3"),
        f"GNU Affero General Public License Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM} Preamble "
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure "
        "cooperation with the community in the case of network server software."],
    "BSD-2-Clause": [f"{_BSD[0]} {one}{_BSD[1]} {two}{_BSD[2]} {_BSD_END}" for one, two in (("1. ", "2. "), ("", ""))],
    "BSD-3-Clause": [f"{_BSD[0]} {one}{_BSD[1]} {two}{_BSD[2]} {three}{names}" for names in _BSD_NAMES for one, two, three in (("1. ", "2. ", "3. "), ("", "", ""))],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "Licensed under the Mozilla Public License 2.0.",
                "Mozilla Public License Version 2.0"],
    "CC0-1.0": [
        "has waived all copyright and related or neighboring rights to this work.",
        "Creative Commons Legal Code CC0 1.0 Universal",
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the "
        "creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."],
    "CC-BY-4.0": _cc("Attribution"), "CC-BY-SA-4.0": _cc("Attribution-ShareAlike"), "CC-BY-NC-4.0": _cc("Attribution-NonCommercial"),
    "CC-BY-NC-SA-4.0": _cc("Attribution-NonCommercial-ShareAlike"), "CC-BY-ND-4.0": _cc("Attribution-NoDerivatives")}
for _name, _texts in _MORE.items():
    TEMPLATES[_name] += [t for t in _texts if t not in TEMPLATES[_name]]
_SPDX = re.compile(r"(?i)SPDX-License-Identifier\s*:[ \t]*([^\r\n]*)")
_SPDX_PART = re.compile(r"[A-Za-z0-9.+-]+|[()]")
_SPDX_NAMES = {n.lower(): n for n in TEMPLATES}

# Words that tell licenses apart, besides numbers.
TELLING = frozenset(
    "mit apache gnu general lesser affero mozilla mpl bsd isc clause cc cc0 by sa nc nd attribution sharealike noncommercial noderivatives universal".split())
_WORD = re.compile(r"[A-Za-z]+[0-9]*|[0-9]+(?:\.[0-9]+)*")


@dataclass(frozen=True)
class Template:
    name: str
    text: bytes
    words: tuple[str, ...]
    plain_size: int
    compressor: zstandard.ZstdCompressor


@dataclass(frozen=True)
class Match:
    name: str
    saved: float
    differences: tuple[str, ...]
    start: int
    end: int


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=19, write_checksum=False, write_content_size=False)


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    """One per Python worker."""
    out = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            data = " ".join(text.lower().split()).encode()
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out.append(Template(name, data, tuple(words_of(text)), len(_plain().compress(data)), zstandard.ZstdCompressor(
                level=19, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)))
    return out


def _fit(template: Template, runs: list[difflib.Match], words: list[str]) -> tuple[tuple[str, ...], int, int] | None:
    """(differences, first word, last word + 1) of the template where these runs of equal words stand, or None if they differ too much."""
    start, end = runs[0].b, runs[-1].b + runs[-1].size
    differences, at, place = [], 0, start
    for run in runs:
        differences += ["-" + w for w in template.words[at:run.a]] + ["+" + w for w in words[place:run.b]]
        at, place = run.a + run.size, run.b + run.size
    differences += ["-" + w for w in template.words[at:]]
    wrong = [d for d in differences if d[1:] in TELLING or d[1].isdigit()]
    if wrong or len(differences) > MISSING * len(template.words):
        return None
    return tuple(differences), start, end


def _aligned(template: Template, words: list[str]) -> tuple[tuple[str, ...], int, int] | None:
    """(differences, first word, last word + 1) of the template in the block, or None if they differ too much everywhere."""
    spare = max(2, int(MISSING * len(template.words)))
    allowed = int(MISSING * len(template.words))
    shortest = -(-(len(template.words) - allowed) // (allowed + 1))  # some run of a template that fits is that long
    words = list(words)
    while True:
        runs = [m for m in difflib.SequenceMatcher(None, template.words, words, autojunk=False).get_matching_blocks() if m.size]
        # the alignment may have caught stray words far from the rest: keep the runs around the longest
        main = max(range(len(runs)), key=lambda k: runs[k].size) if runs else 0
        if not runs or runs[main].size < shortest:
            return None
        low = high = main
        while low and runs[low].b - (runs[low - 1].b + runs[low - 1].size) <= spare:
            low -= 1
        while high + 1 < len(runs) and runs[high + 1].b - (runs[high].b + runs[high].size) <= spare:
            high += 1
        fit = _fit(template, runs[low:high + 1], words)
        if fit:
            return fit
        words[runs[main].b:runs[main].b + runs[main].size] = [""] * runs[main].size  # the same words may stand in another place


def _spdx(block: str) -> Iterator[Match]:
    """The named licenses of SPDX lines."""
    for line in _SPDX.finditer(block):
        place, after = len(words_of(block[:line.start(1)])), ""
        for part in _SPDX_PART.findall(line[1]):
            size = len(words_of(part))
            name = _SPDX_NAMES.get(re.sub(r"(-only|-or-later|\+)$", "", part.lower()))
            if name and after != "with":
                yield Match(name, 1.0, (), place, place + size)
            place, after = place + size, part.lower()


def licenses_of(block: str) -> list[Match]:
    """The confirmed licenses of a block, in the order of their place."""
    data = " ".join(block.lower().split()).encode()
    alone = len(_plain().compress(data))
    words = words_of(block)
    spaced = f" {' '.join(words)} "
    found = list(_spdx(block))
    for template in templates():
        saved = (alone - len(template.compressor.compress(data))) / template.plain_size
        before = spaced.find(f" {' '.join(template.words)} ")
        if before >= 0:
            start = spaced.count(" ", 0, before)
            fit = (), start, start + len(template.words)
        else:
            fit = _aligned(template, words) if saved >= MIN_SAVED else None
        if fit:
            found.append(Match(template.name, round(saved, 4), *fit))
    found.sort(key=lambda m: (-(m.end - m.start - 2 * len(m.differences)), m.name))
    kept: list[Match] = []
    for m in found:
        if all(m.end <= o.start or o.end <= m.start for o in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: (m.start, m.name))


def blocks_of(text: str, cue: re.Pattern[str]) -> list[str]:
    """Runs of lines from one with a cue to the last that follows with at most GAP others between."""
    lines = text.split("\n")
    marked = [k for k, line in enumerate(lines) if cue.search(line)]
    out: list[list[int]] = []
    for k in marked:
        if out and k - out[-1][1] <= GAP + 1:
            out[-1][1] = k
        else:
            out.append([k, k])
    return ["\n".join(lines[a:b + 1]) for a, b in out]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cue = re.compile(CUES)
    for batch in batches:
        keys, blocks = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for block in blocks_of(text.as_py(), cue):
                keys.append(key)
                blocks.append(block)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blocks, pa.string())], ["text_key", "block"])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [licenses_of(b.as_py()) for b in batch.column(0)]
        kind = pa.list_(pa.struct([("name", pa.string()), ("saved", pa.float64()), ("differences", pa.list_(pa.string()))]))
        rows = [[{"name": m.name, "saved": m.saved, "differences": list(m.differences)} for m in ms] for ms in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["block", "matches"])


def license_blocks(docs: DataFrame) -> DataFrame:
    """(text_key, block, matches) of every candidate block; matches: name, saved, differences."""
    text = F.col("text").cast("string")
    texts = docs.where(text.rlike(CUES)).select(F.unhex(F.md5(text.cast("binary"))).alias("text_key"), text.alias("text"))
    blocks = written(texts.mapInArrow(_blocks, "text_key binary, block string").distinct(), "license-blocks")
    judged = blocks.select("block").distinct().mapInArrow(
        _judge, "block string, matches array<struct<name: string, saved: double, differences: array<string>>>")
    return blocks.join(small(written(judged, "judged"), BROADCAST_BLOCKS, F.octet_length("block") + 100 * F.size("matches")), "block")


def licenses(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, licenses (names in order, comma-joined; empty if none), n_blocks."""
    per = license_blocks(docs).groupBy("text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.col("matches.name"))))).alias("names"), F.count(F.lit(1)).alias("n_blocks"))
    own = docs.select("doc_id", F.unhex(F.md5(F.col("text").cast("string").cast("binary"))).alias("text_key"))
    return own.join(per, "text_key", "left").select(
        "doc_id", F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))
