from __future__ import annotations

import re

import pytest

from tallyloom.llm import licenses
from tests.llm.helpers import documents, prose

PROSE = " ".join(prose(4, 30))


@pytest.mark.parametrize("name", licenses.TEMPLATES)
def test_every_template_is_found_as_itself(name):
    for text in licenses.TEMPLATES[name]:
        for block in (text, text.upper(), f"{PROSE}\n{text}\n{PROSE}", text.replace(" ", "\n")):
            assert [m.name for m in licenses.licenses_of(block)] == [name], block


def test_differences_in_telling_words_refuse():
    assert licenses.licenses_of("Licensed under the Apache License, Version 1.1.") == []
    assert licenses.licenses_of("This work is licensed under the GNU General Public License, version 4.") == []
    assert licenses.licenses_of("Released under the Foo License.") == []
    assert licenses.licenses_of("A license is needed to drive this car.") == []


def test_small_differences_are_named():
    text = licenses.TEMPLATES["MIT"][2].replace("free of charge", "without charge").replace("sublicense", "relicense")
    found = licenses.licenses_of(text)
    assert [m.name for m in found] == ["MIT"]
    assert set(found[0].differences) == {"-free", "-of", "+without", "-sublicense", "+relicense"}


def test_two_licenses_in_one_block():
    a, b = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["Apache-2.0"][0]
    assert [m.name for m in licenses.licenses_of(f"{b} {PROSE}\n{a}")] == ["Apache-2.0", "MIT"]


def test_blocks():
    cue = re.compile(licenses.CUES)
    assert licenses.blocks_of("x\nlicense a\ny\nz\nwarranty\n1\n2\n3\n4\ncopyright\nw", cue) == ["license a\ny\nz\nwarranty", "copyright"]
    assert licenses.blocks_of("", cue) == []


def test_rows(spark, monkeypatch):
    mit, gpl = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["GPL-3.0"][0]
    texts = [(1, f"{PROSE}\n{mit}", "s"), (2, None, "s"), (3, "", "s"), (None, mit, "s"), (4, f"{gpl}\n" + "a\n" * 9 + f"{mit}\n{mit}", "s"),
             (1, f"{PROSE}\n{mit}", "s"), (5, "no such thing", "s"), (6, "x\n" * 100_000 + mit, "s"), (7, "copyright mine", "s")]
    want = [(1, "MIT", 1), (2, "", 0), (3, "", 0), (None, "MIT", 1), (4, "GPL-3.0,MIT", 2), (1, "MIT", 1), (5, "", 0), (6, "MIT", 1), (7, "", 1)]
    for limit in (licenses.BROADCAST_BLOCKS, 0):
        monkeypatch.setattr(licenses, "BROADCAST_BLOCKS", limit)
        got = [tuple(r) for r in licenses.licenses(documents(spark, texts, extra=True).withColumnRenamed("words", "n_blocks")).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert licenses.licenses(documents(spark, [])).collect() == []


def test_a_list_of_all_licenses_loses_none():
    notices = [texts[0] for texts in licenses.TEMPLATES.values()]
    assert len(notices) > 8
    for order in (notices, notices[::-1]):
        assert sorted(m.name for m in licenses.licenses_of("\n".join(order))) == sorted(licenses.TEMPLATES)
    listed = "\n".join(f"part {k}: {n}\nby someone\n" for k, n in enumerate(notices))
    assert sorted(m.name for m in licenses.licenses_of(listed)) == sorted(licenses.TEMPLATES)


@pytest.mark.parametrize("name", licenses.TEMPLATES)
def test_spdx_lines(name):
    assert [m.name for m in licenses.licenses_of(f"// SPDX-License-Identifier: {name}")] == [name]


def test_spdx_expressions():
    def found(line):
        return [m.name for m in licenses.licenses_of(f"SPDX-License-Identifier: {line}")]
    assert found("(MIT OR Apache-2.0) AND BSD-3-Clause") == ["MIT", "Apache-2.0", "BSD-3-Clause"]
    assert found("GPL-2.0-or-later WITH Classpath-exception-2.0") == ["GPL-2.0"] and found("GPL-3.0+") == ["GPL-3.0"]
    assert found("MIT-0") == [] and found("BSD-3-Clause-Clear") == [] and found("CC-BY-NC-ND-4.0") == []


BSD = """Copyright (c) 2001, Someone. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{}Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
{}Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE {} AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE HOLDER BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES."""
NAMES = """{}Neither the name of the {} nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""


@pytest.mark.parametrize("marks", [("1. ", "2. ", "3. "), ("* ", "* ", "* "), ("- ", "- ", "- ")])
@pytest.mark.parametrize("who", ["REGENTS", "COPYRIGHT HOLDERS"])
def test_bsd_texts(marks, who):
    def found(text):
        return [m.name for b in licenses.blocks_of(text, re.compile(licenses.CUES)) for m in licenses.licenses_of(b)]
    assert found(BSD.format(*marks[:2], "", who)) == ["BSD-2-Clause"]
    assert found(BSD.format(*marks[:2], NAMES.format(marks[2], "University"), who)) == ["BSD-3-Clause"]


def test_an_edited_notice_after_a_similar_one():
    gpl2 = licenses.TEMPLATES["GPL-2.0"][1]
    gpl3 = licenses.TEMPLATES["GPL-3.0"][1].replace("redistribute it", "share it").replace("published by the", "issued by the")
    assert [m.name for m in licenses.licenses_of(f"{gpl2}\n{PROSE}\n{gpl3}")] == ["GPL-2.0", "GPL-3.0"]
