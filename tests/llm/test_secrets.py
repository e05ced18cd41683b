"""Secrets in the forms in which they are pasted: planted tokens and keys, each next to what is none."""

import base64
import json

import pytest

from loomgrain.llm import secret_scan


def part(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")


TOKEN = f"{part({'alg': 'HS256', 'typ': 'x'})}.{part({'sub': 'someone'})}.c2lnbmF0dXJl"


def spans(text):
    return [span[:3] for span in secret_scan.structured_spans(text)]


@pytest.mark.parametrize("after", ["", " ", ".", "...", ". Next", ".Next", ".next.more.words", ".\n", "/x"])
@pytest.mark.parametrize("before", ["bearer ", "eyJx.", "eyJx.eyJy."])
def test_tokens_before_dots(before, after):
    assert spans(before + TOKEN + after) == [("signed_token", len(before), len(before + TOKEN))]


def test_tokens_in_base_spans_are_confirmed_before_dots():
    assert secret_scan.value_structure("assign", f"token={TOKEN}.") == "token:HS256"
    assert secret_scan.value_structure("assign", f"token={TOKEN[:30]}.") is None
    assert spans(f"{part({'typ': 'x'})}.{part({'sub': 'someone'})}.c2lnbmF0dXJl.") == []


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x81, size]) if size < 256 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def lines(text, width, between="\n"):
    return between.join(text[i : i + width] for i in range(0, len(text), width))


def armour(label, body, between="\n", headers=""):
    return f"-----BEGIN {label}-----{between}{headers}{lines(body, 64, between)}{between}-----END {label}-----"


PKCS1 = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([1 + i] * 40)) for i in range(8)))
PBES2 = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, b""))
SHA256 = der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b""))
LOCKED = der(0x30, PBES2 + der(4, bytes(range(200))))
KEY, LOCKED_KEY = base64.b64encode(PKCS1).decode(), base64.b64encode(LOCKED).decode()
CIPHERTEXT = base64.b64encode(bytes(range(160))).decode()
HEADERS = "Proc-Type: 4,ENCRYPTED{0}DEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF{0}{0}"
PEM_TEXT = base64.b64encode(armour("RSA PRIVATE KEY", KEY).encode()).decode()
MIXED = "".join(c.upper() if i % 3 else c for i, c in enumerate(PKCS1.hex()))


@pytest.mark.parametrize("key", [
    armour("RSA PRIVATE KEY", KEY), armour("RSA PRIVATE KEY", KEY, r"\n"), armour("RSA PRIVATE KEY", KEY, r"\\n"), armour("RSA PRIVATE KEY", KEY, r"\r\n"),
    armour("RSA PRIVATE KEY", KEY.replace("/", r"\/"), r"\n"), armour("RSA PRIVATE KEY", KEY, "\n", "Comment: of, a: key\n\n"),
    *(armour("RSA PRIVATE KEY", CIPHERTEXT, between, HEADERS.format(between)) for between in ("\n", "\r\n", r"\n", " ")),
    armour("ENCRYPTED PRIVATE KEY", LOCKED_KEY), LOCKED_KEY,
    *(lines(KEY, width, between) for width in (64, 76) for between in ("\n", "\r\n", "\n    ", r"\n", " \\\n")), lines(KEY.rstrip("="), 64),
    *(lines(PKCS1.hex(), width) for width in (64, 76)), lines(LOCKED_KEY, 64), MIXED, PEM_TEXT, lines(PEM_TEXT, 76), lines(KEY, len(KEY) // 4),
])
@pytest.mark.parametrize("before, after", [("", ""), ("key: ", " here"), ("see\n", "\nand more"), ('{"k": "', r'\n", "x": 1}')])
def test_keys_as_they_are_pasted(before, key, after):
    assert spans(before + key + after) == [("private_key", len(before), len(before + key))]


@pytest.mark.parametrize("text", [
    lines(KEY[:-8], 64), lines(KEY.rstrip("=") + "AAAA", 64), MIXED[:-2], base64.b64encode(der(0x30, SHA256 + der(4, bytes(32)))).decode(),
    armour("RSA PRIVATE KEY", CIPHERTEXT), armour("RSA PRIVATE KEY", CIPHERTEXT[:-8], "\n", HEADERS.format("\n")),
    f"-----BEGIN RSA PRIVATE KEY-----\n{KEY[:60]}\n-----BEGIN PRIVATE KEY-----", base64.b64encode(b"-----BEGIN PRIVATE KEY-----\nnothing of that kind\n" * 3).decode(),
])
def test_look_alikes_of_keys(text):
    assert spans(f"see {text} here") == []


def test_base_spans_do_not_see_what_escapes_stand_for():
    text = r"token=abcdef\nabcdefabcdef and deadbeef\ndeadbeefdeadbeef"
    assert secret_scan.base_spans(text) == [("hex", text.rindex("deadbeefdead"), len(text))]
