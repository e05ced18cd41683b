"""License rules: the keyword gates change no result, and every way of naming a license has a text that shows it."""

from re import _constants as kinds, _parser

import pytest

from loomgrain.llm import licenses


def instance(parsed, most: bool) -> str:
    """A text that a rule's pattern matches: its first branches, optional parts left out or put in."""
    out = ""
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            out += chr(value)
        elif kind is kinds.ANY:
            out += "x"
        elif kind is kinds.IN:
            first, what = value[0]
            out += chr(what) if first is kinds.LITERAL else chr(what[0]) if first is kinds.RANGE else "0"
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            low, high, body = value
            out += instance(body, most) * (min(high, max(low, 1)) if most else low)
        elif kind is kinds.SUBPATTERN:
            out += instance(value[3], most)
        elif kind is kinds.BRANCH:
            out += instance(value[1][-1 if most else 0], most)
        elif kind not in (kinds.ASSERT, kinds.AT):
            raise ValueError(kind)
    return out


def ungated(scanner, spaced):
    return {(rule.priority, rule.label) for rule in scanner.rules if rule.pattern.search(spaced)}


def test_gates_change_no_result():
    scanner = licenses.Scanner()
    texts = [instance(_parser.parse(rule.pattern.pattern), most) for rule in scanner.rules for most in (False, True)]
    texts += [f"{word} under {name}" for word in ("released", "distributed", "published", "available", "provided") for name in ("gpl 3", "bsd 3 clause", "apache 2 0", "cc0")]
    for text, rule in zip(texts, [rule for rule in scanner.rules for _ in range(2)]):
        assert rule.pattern.search(f" {text} "), (rule, text)
    for text in texts:
        spaced = f" {text} "
        assert {(p, label) for _, _, p, label in scanner.detections(spaced)} == ungated(scanner, spaced), text


@pytest.mark.parametrize("text, label", [
    ("released under GPL 3", "gpl-3"), ("distributed under BSD 3-Clause.", "bsd-3-clause"), ("available under Apache 2.0", "apache-2"),
    ("provided under CC0", "cc0-1"), ("published under the MPL 2.0", "mpl-2"),
])
def test_names_without_the_word_license(text, label):
    assert licenses.Scanner().scan(text)[5] == label


@pytest.mark.parametrize("text, labels", [
    ("licensed under GPLv2", "gpl-2"), ("licensed under GPLv3", "gpl-3"), ("licensed under the LGPLv3.", "lgpl-3"), ("licensed under LGPLv2.1", "lgpl-2.1"),
    ("licensed under AGPLv3", "agpl-3"), ("License: MPLv2", "mpl-2"), ("released under the GPLv3+", "gpl-3"), ("Apache License v2.0", "apache-2"),
    ("licensed under the GPL", "gpl"), ("under the GNU General Public License.", "gpl"), ("the BSD license", "bsd"), ("the Apache License", "apache"),
    ("GNU Lesser General Public License", "lgpl"), ("GNU Affero General Public License", "agpl"), ("released under the MPL", "mpl"), ("License: LGPL", "lgpl"),
    ("licensed under a Creative Commons license", "cc"), ("licensed under a BSD-style license", "bsd"), ("under the terms and conditions of the Eclipse Public License", "epl"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"), ("licensed under an MIT license", "mit"),
    ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "cc-by-nc-sa"), ("CC0 1.0 Universal License", "cc0-1"),
    ("GNU General Public License, version 3", "gpl-3"), ("GNU Lesser General Public License v2.1", "lgpl-2.1"), ("the Mozilla Public License, v. 2.0", "mpl-2"),
    ("licensed under the GNU General Public License version 3", "gpl-3"), ("licensed under the three-clause BSD license", "bsd-3-clause"),
])
def test_names_as_they_are_written(text, labels):
    assert licenses.Scanner().scan(f"This work is {text} and more")[5] == labels


PLANTED = [
    ("https://creativecommons.org/licenses/by-nd/4.0/", "cc-by-nd"), ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("https://creativecommons.org/licenses/by-nc-nd/3.0/", "cc-by-nc-nd"), ("https://creativecommons.org/publicdomain/mark/1.0/", "public-domain"),
    *((f"{name} as published by the Free Software Foundation, either version {number} of the License", label) for name, number, label in (
        ("GNU General Public License", "2", "gpl-2"), ("GNU General Public License", "3", "gpl-3"), ("GNU Lesser General Public License", "2.1", "lgpl-2.1"),
        ("GNU Lesser General Public License", "3", "lgpl-3"), ("GNU Affero General Public License", "3", "agpl-3"))),
    ("https://www.gnu.org/licenses/old-licenses/gpl-2.0.html", "gpl-2"), ("https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3"), ("https://opensource.org/licenses/MIT", "mit"),
    ("https://opensource.org/licenses/BSD-3-Clause", "bsd-3-clause"), ("https://www.mozilla.org/en-US/MPL/2.0/", "mpl-2"),
    ("This product includes software developed by the Apache Software Foundation", "apache-1.1"), ("This product includes software developed by the OpenSSL Project", "openssl"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement", "bsd-4-clause"),
    ("any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "boost-1"), ("You just DO WHAT THE FUCK YOU WANT TO.", "wtfpl"),
    ("THE BEER-WARE LICENSE", "beerware"), ("Copying and distribution of this file, with or without modification, are permitted in any medium", "fsf-all-permissive"),
    ("Server Side Public License", "sspl-1"), ("Business Source License", "busl-1.1"), ("under the Artistic License", "artistic"),
]


@pytest.mark.parametrize("text, label", PLANTED)
def test_written_rules(text, label):
    assert licenses.Scanner().scan(f"See {text} for more")[5] == label


@pytest.mark.parametrize("text", ["with artistic license", "released under general public pressure", "the apache tribe", "a bsd system", "available under boost", "GPLv9x"])
def test_names_that_are_no_license(text):
    assert licenses.Scanner().scan(f"It is {text} and more")[5] == ""
