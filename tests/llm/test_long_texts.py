"""Texts of several MB that make careless patterns quadratic, and equal results on short ones."""

import random
import re
import time

import pytest

from loomgrain.llm import licenses, secret_scan

MB = 1_000_000


@pytest.mark.parametrize(
    "text",
    ["eyJ" * (5 * MB // 3), "A" * 5 * MB, "a" * 5 * MB + ".", "eyJ." * MB, "7" * 5 * MB, "\\" * 3 * MB, ("A" * 60 + "\n") * 50_000, "a.b." * MB],
    ids=["marks", "capitals", "letters", "dots", "digits", "escapes", "lines", "parts"],
)
def test_secrets_in_time_that_grows_with_the_text(text):
    began = time.process_time()
    secret_scan.scan_text(text)
    assert time.process_time() - began < 30


def test_licenses_in_time_that_grows_with_the_text():
    scanner = licenses.Scanner()
    began = time.process_time()
    found = scanner.scan("under the mit license " * (2 * MB // 22))
    assert time.process_time() - began < 60
    assert found[1] == 2 * MB // 22 and found[2:4] == (0, 4 * (2 * MB // 22 - 1))


PLAIN_TOKEN = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")


def plain_tokens(text):
    """Each candidate as it was defined: a mark, a run and two more parts, read from every place."""
    m = PLAIN_TOKEN.search(text)
    while m:
        structure = secret_scan.token_structure(*m.groups())
        if structure:
            yield *m.span(), structure
        m = PLAIN_TOKEN.search(text, m.end() if structure else m.end(1))


def test_same_tokens_as_reading_from_every_place():
    import base64
    import json

    def part(value):
        return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")

    header, claims = part({"alg": "HS256"}), part({"sub": "1"})
    draw, seen = random.Random(8), 0
    for _ in range(4000):
        text = "".join(draw.choice([header, claims, f"{header}.{claims}.", ".", ".", "eyJ", "a", " ", "-", "xyz", "\n"]) for _ in range(draw.randint(1, 14)))
        found = list(secret_scan.tokens(text))
        assert found == list(plain_tokens(text))
        seen += len(found)
    assert seen > 50


def test_same_wrapped_runs_and_breaks_as_from_every_place():
    wrapped = re.compile(secret_scan.WRAPPED.pattern.replace("(?<![A-Za-z0-9+/_-])", "", 1))
    escaped = re.compile(r"\\+[nr]")
    draw = random.Random(9)
    for _ in range(3000):
        text = "".join(draw.choice(["A" * 47, "b" * 48, "c/+" * 17, "\n", "\n ", " \\\n", "=", "\\n", "\\", "r", "."]) for _ in range(draw.randint(1, 9)))
        assert [m.span() for m in secret_scan.WRAPPED.finditer(text)] == [m.span() for m in wrapped.finditer(text)]
        assert [m.span() for m in secret_scan.ESCAPED_BREAK.finditer(text)] == [m.span() for m in escaped.finditer(text)]
