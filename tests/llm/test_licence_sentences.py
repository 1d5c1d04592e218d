"""Licence sentences inside longer ones, sentences of one rule far apart, and the common licences."""

from __future__ import annotations

import pytest

from bidbox.llm import licences

S = licences.SENTENCES
RULES = licences.Rules(licences.SENTENCES, licences.RULES)
CASES = [
    ("This project is licensed under the MIT License.", ["MIT"]),
    ("Licensed under the MIT License - see LICENSE", ["MIT"]),
    (S["mit-grant"], ["MIT"]),
    (f"{S['mit-grant']}. " + "Filler. " * 20 + S["mit-notice-kept"], ["MIT"]),
    (S["mit-notice-kept"], []),
    (S["bsd-redistribution"], ["LicenseRef-BSD"]),
    ("The code is released under the BSD 3-Clause License, the data under something else.", ["BSD-3-Clause"]),
    ("This Source Code Form is subject to the terms of the Mozilla\nPublic License, v. 2.0. If a copy", ["MPL-2.0"]),
    ("Foo is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", ["LGPL-2.1-or-later"]),
    ("This work is licensed under the GNU General Public License, version 3 or later.", ["GPL-3.0-or-later"]),
    ("It is licensed under GPLv3+ and nothing else", ["GPL-3.0-or-later"]),
    ("It is licensed under the GNU AGPL v3.", ["AGPL-3.0-only"]),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ["ISC"]),
    ("are made available under the terms of the Eclipse Public License v2.0 which", ["EPL-2.0"]),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    ("# SPDX-License-Identifier: LGPL-3.0-or-later", ["LGPL-3.0-or-later"]),
    ("This text is about the MIT License and the GPL.", []),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_licences_of_a_text(text, want):
    got = RULES.licences(f"İ intro words {text} more")
    assert [m["licence"] for m in got] == want


def test_the_nearest_sentence_serves():
    two = f"{S['bsd-redistribution']}\n{S['bsd-source']}\n{S['bsd-binary']}\n"
    text = two + "words " * 500 + two + S["bsd-endorse"]
    got = RULES.licences(text)
    assert [m["licence"] for m in got] == ["BSD-2-Clause", "BSD-3-Clause"]
    assert text[got[1]["start"]:got[1]["end"]] == two + S["bsd-endorse"]
