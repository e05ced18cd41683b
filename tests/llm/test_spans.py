"""Secret scan, personal data, license scan: planted cases, contracts by brute force, odd tables."""

import base64
import hashlib
import json
import re

import pytest
from cases import clashing, empty, odd, odd_rows, prose

from loomgrain.llm import licenses, private_data, secret_scan
from loomgrain.llm.queries import QUERIES


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans):
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def ordered(spans, kinds):
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def secrets_by_hand(text):
    """The contract's patterns as they are written there."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ordered(found, ("assign", "access", "hex"))


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def private_by_hand(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return ordered(found, ("email", "ip", "card", "phone"))


TEXTS = [
    "", "PassWord: 'abc/DEF+123=x' and api_key=short", "tokens token=\"" + "a1" * 20 + "\" deadbeefdeadbeefdeadbeef",
    "AKIA12345678901234 AKIAshort", "secret : = x api key=aaaaaaaaaaaaaaaa apikey : bbbbbbbbbbbbbbbb",
    "a@b@c.d x@y.z..w q@@z.a.b a@b.c%d@e.f.g .@-.- é@x.y u@v", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.003.0004 1..2.3.4 9.9.9.9.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5 4111111111111111 0000 0000 0000", "+1 (131) 555-7634. +49 30 123 +123456789 +1 22 2021 12 44 5 1 2 3",
    "٣٣٣.1.2.3 １.2.3.4 +１23456789", "x" * 5000 + "@" + "y" * 10 + ".z" + "1" * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_those_of_the_patterns(text):
    assert secret_scan.in_order(secret_scan.base_spans(text)) == secrets_by_hand(text)
    assert private_data.in_order(private_data.base_spans(text)) == private_by_hand(text)


def test_queries_against_brute_force(spark, folder):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op1_secrets"](spark, folder).collect():
        base = secrets_by_hand(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base) and set(map("%s:%d:%d".__mod__, base)) <= set(r["spans"].split(",") if r["spans"] else [])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
    for r in QUERIES["op3_private_data"](spark, folder).collect():
        base = private_by_hand(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base) and set(map("%s:%d:%d".__mod__, base)) <= set(r["spans"].split(",") if r["spans"] else [])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in private_data.KINDS]
    for r in QUERIES["op6_licenses"](spark, folder).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]]))
        phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
        places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x81, size]) if size < 256 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def test_structures_are_confirmed_and_look_alikes_are_not():
    numbers = b"".join(der(2, bytes([1 + i] * 40)) for i in range(8))
    key = base64.b64encode(der(0x30, der(2, b"\0") + numbers)).decode()
    broken = base64.b64encode(der(0x30, der(2, b"\0") + numbers)[:-5]).decode()
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256', 'typ': 'x'})}.{part({'sub': 'someone'})}.c2lnbmF0dXJl"
    unsigned = f"{part({'typ': 'x'})}.{part({'sub': 'someone'})}.c2lnbmF0dXJl"
    kinds = lambda text: {s[0] for s in secret_scan.structured_spans(text)}
    assert kinds(f"see {key} here") == {"private_key"} and kinds(f"see {broken} here") == set()
    assert kinds(f"bearer {token}.") == {"signed_token"} or kinds(f"bearer {token} ") == {"signed_token"}
    assert kinds(f"bearer {unsigned} ") == set()
    assert kinds(prose(1, 300)) == set()


@pytest.fixture(scope="module")
def model():
    return private_data.train(private_data.written_examples())


@pytest.mark.parametrize("text, span", [
    ("write to jo.lee (at) post dot com now", "email:9:33"), ("call (131) 555-7634 today", "phone:5:19"),
    ("paid with 12 4111 1111 1111 1111 ok", "card:13:32"), ("from host 10.20.30[.]40 again", "ip:10:23"),
])
def test_candidates_beyond_the_patterns(model, text, span):
    assert span in private_data.scan_text(text, model)[5].split(",")


@pytest.mark.parametrize("text", [prose(3, 400), "order 4651971212855899 of 2021-03-04", "we met at home. the end", "page 12 of 300, 1 2 3 4 5 6", "a" * 9000, "1 " * 9000])
def test_clean_texts_stay_clean(model, text):
    assert private_data.scan_text(text, model)[5] == ""


def test_overlapping_rules_are_settled():
    # inside one of higher priority, overlapping a higher one, apart
    assert licenses.settled([(0, 9, 90, "a"), (2, 5, 50, "b"), (8, 12, 60, "c"), (20, 22, 10, "d")]) == [(0, 9, 90, "a"), (20, 22, 10, "d")]
    assert licenses.settled([(0, 9, 50, "a"), (2, 5, 50, "b")]) == [(0, 9, 50, "a")]
    scanner = licenses.Scanner()
    assert scanner.scan("SPDX-License-Identifier: MPL-2.0")[5] == "mpl-2"
    assert scanner.scan("licensed under the GNU General Public License version 3")[5].startswith("gpl")
    assert scanner.scan(prose(4, 300))[1:7] == (0, None, None, "", "", 0.0)


def test_odd_rows(spark, model):
    docs = clashing(odd(spark))
    for found in (secret_scan.scan(docs), licenses.scan(docs), private_data.scan(docs, model)):
        assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(r[0]) for r in odd_rows())
    none = empty(spark)
    assert secret_scan.scan(none).count() == licenses.scan(none).count() == private_data.scan(none, private_data.fit(none)).count() == 0
    masked = secret_scan.scan(docs.where("doc_id = 8")).join(docs.where("doc_id = 8").select("doc_id", "text"), "doc_id")
    from pyspark.sql import functions as F

    shown = masked.select(secret_scan.masked(F.col("text"), F.col("found"))).first()[0]
    assert shown.startswith("ünï cödé 𝔘") and shown.endswith(" [assign]'")
