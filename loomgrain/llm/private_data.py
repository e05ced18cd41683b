"""Personal data by candidate gradient boosting.

Fixed patterns give the base spans. On top, generators with high recall propose
overlapping candidates: obfuscated addresses, dotted quads in brackets, every
run of digit groups that could be a card or a phone number. Boosted trees judge
each candidate by its format and the characters and words around it. Their
scores are calibrated on rows the trees have not seen, a threshold per kind is
set where the precision there is ``PRECISION``, and of overlapping candidates
above it the likeliest is reported. Base spans are never dropped.

What the trees learn from: base matches found in a bounded sample of documents
(``FIT_TEXTS``, by hash of the id, at most ``FIT_EXAMPLES`` candidates), digit
runs there that break a hard rule (checksum, range, number of digits), and
written examples of every kind in strict and loose forms with look-alikes. A
candidate that keeps every rule without being a base match has no label and is
left out of the training.

Defined results: a NULL text counts as empty and has no spans; texts of any
length are scanned whole, in time that grows with the text; rows that repeat an
id are scanned each; without documents the written examples alone decide;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.arrow import map_texts
from loomgrain.llm.boosting import Boosted, fit_boosted
from loomgrain.llm.common import joined_spans, sha256_hex
from loomgrain.llm.linear import fit_logistic

# The kinds in the order in which they are listed, the base patterns and their limits.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number begins where no digit stands before it: from inside a run of digits the pattern would fail as it did at its start
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (12, 19), (9, 15), 255

FIT_TEXTS, FIT_EXAMPLES, WRITTEN = 4000, 4000, 260
PRECISION, LEAST_PROBABILITY = 0.95, 0.5
AROUND = 40  # characters looked at before a candidate

# characters that stand for an ASCII one; every one is a single code point, so places stay
ALIKE = {0xFF20: "@", 0xFF0E: ".", 0x3002: ".", 0xA0: " ", 0x2007: " ", 0x2009: " ", 0x202F: " ", 0xFF0B: "+", 0xFF08: "(", 0xFF09: ")"}
ALIKE |= {0x2010 + i: "-" for i in range(6)} | {0x2212: "-"} | {0xFF10 + i: str(i) for i in range(10)}

SPOKEN_AT = r"\s?(?:\(at\)|\[at\]|\{at\}|<at>)\s?|\sat\s|\s?@\s?"
SPOKEN_DOT = r"\s?(?:\(dot\)|\[dot\]|\{dot\}|<dot>)\s?|\sdot\s|\[\.\]|\(\.\)|\."
SPOKEN_EMAIL = re.compile(
    rf"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}(?:{SPOKEN_AT})[A-Za-z0-9-]{{1,63}}(?:(?:{SPOKEN_DOT})[A-Za-z0-9-]{{2,63}}){{1,4}}", re.IGNORECASE
)
SPOKEN_QUAD = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\s?\.\s?)[0-9]{1,3}){3}(?![0-9])")
DIGITS = re.compile(r"[0-9]++")
BETWEEN = re.compile(r"[ ().\-/]{0,3}")
CUES = {
    "email": ("mail", "contact", "write to", "reply"),
    "ip": ("ip", "host", "server", "address", "ping", "addr"),
    "card": ("card", "visa", "master", "credit", "amex", "karte", "carte", "tarjeta", "cc "),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "whatsapp", "mobil", "ruf", "numéro"),
    "other": ("version", "order", "isbn", "invoice", "ref", "serial", "id", "no.", "section", "page", "build", "token", "secret", "$", "€", "v."),
}

# the last words before a candidate, of which one in these says more than the same letters further away
NEAR = re.compile(r"[^\W\d_]+")
NEAR_WORDS = 3
NEAR_CUES = {
    "phone": frozenset("phone telephone tel call calls fax mobile cell whatsapp mobil handy telefon ruf rufen anrufen numéro teléfono téléphone móvil".split()),
    "other": frozenset("order orders isbn invoice ref reference serial id no number version token account ticket item timestamp code build article".split()),
}

RESULT = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, "
    "found array<struct<kind:string,start:int,end:int,probability:double>>"
)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return re.sub("[^0-9]+", "", text)


def in_range(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= LARGEST_PART


def base_emails(text: str) -> Iterator[Span]:
    """From each @ to both sides, in time that grows with the text: a local part holds no @."""
    allowed, free, at = frozenset("._%+-"), 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and ((c := text[start - 1]) in allowed or (c.isascii() and c.isalnum())):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield ("email", start, domain.end())
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Base matches that keep their rule, by kind and place."""
    found = list(base_emails(text))
    if not text.isascii() or any(d in text for d in "0123456789"):
        found += [("ip", *m.span()) for m in QUAD.finditer(text) if all(map(in_range, m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= CARD_DIGITS[0]:
                digits = only_digits(m.group())
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(only_digits(m.group())) <= PHONE_DIGITS[1]:
                found.append(("phone", *m.span()))
    return found


def in_order(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def digit_windows(text: str) -> Iterator[Span]:
    """Runs of neighbouring digit groups that could be a card or a phone number; at most a few per group."""
    groups = [m.span() for m in DIGITS.finditer(text)]
    for first, (start, _) in enumerate(groups):
        total, last = 0, first
        while last < len(groups):
            a, b = groups[last]
            if last > first:
                gap = text[groups[last - 1][1] : a]
                if not gap or not BETWEEN.fullmatch(gap):
                    break
            total += b - a
            if total > CARD_DIGITS[1]:
                break
            if total >= CARD_DIGITS[0] and (last == first or all(y - x <= 6 for x, y in groups[first : last + 1])):
                yield ("card", start, b)
            if PHONE_DIGITS[0] <= total <= PHONE_DIGITS[1]:
                before = text[max(0, start - 2) : start]
                lead = 2 if before.endswith("+(") else 1 if before[-1:] in ("+", "(") else 0
                yield ("phone", start - lead, b)
            last += 1


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data, in a text whose look-alike characters were replaced."""
    found = []
    lower = text.lower()
    if "@" in text or any(mark in lower for mark in ("(at)", "[at]", "{at}", "<at>")) or (" at " in lower and "dot" in lower):
        found += [("email", *m.span()) for m in SPOKEN_EMAIL.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [("ip", *m.span()) for m in SPOKEN_QUAD.finditer(text)]
        found += digit_windows(text)
    return found


def shape(c: str) -> int:
    return 0 if not c or c.isspace() else 3 if c.isdigit() else 2 if c.isalpha() else 1


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, start, end = span
    body = text[start:end]
    groups = [len(g) for g in re.findall("[0-9]+", body)] or [0]
    digits = only_digits(body)
    labels = re.split(r"[.\s\[\](){}]+", body.split("@")[-1].lower()) if kind == "email" else [""]
    parts = re.findall("[0-9]+", body) if kind == "ip" else []
    before = text[max(0, start - AROUND) : start].lower()
    near = NEAR.findall(before)[-NEAR_WORDS:]
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    return [
        KINDS.index(kind),
        *(float(kind == k) for k in KINDS),
        len(body),
        len(digits),
        len(groups),
        max(groups),
        min(groups),
        groups[0],
        groups[-1],
        float(len(set(groups)) == 1),
        len(set(re.sub("[A-Za-z0-9]", "", body))),
        float(body[:1] == "+" or left == "+"),
        float("(" in body),
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(digits[:1] in ("3", "4", "5", "6", "2")),
        len(set(digits)) / max(1, len(digits)),
        float(bool(parts) and all(map(in_range, parts))),
        max((int(p[-4:]) for p in parts), default=0),
        len([x for x in labels if x]),
        len(labels[-1]),
        float(labels[-1].isalpha()),
        float(bool(re.search(r"@[A-Za-z0-9]", body))),
        float(bool(re.search(r"\((?:at|dot)\)|\[(?:at|dot|\.)\]|\{at\}| dot ", body.lower()))),
        float(" at " in body.lower()),
        shape(left),
        shape(right),
        shape(text[max(0, start - 2) : max(0, start - 1)]) if left else 0,
        *(float(any(cue in before for cue in cues)) for cues in CUES.values()),
        *(float(not cues.isdisjoint(near)) for cues in NEAR_CUES.values()),
    ]


def keeps_rules(text: str, span: Span) -> bool:
    kind, start, end = span
    digits = only_digits(text[start:end])
    if kind == "card":
        return luhn(digits)
    if kind == "ip":
        return all(map(in_range, re.findall("[0-9]+", text[start:end])))
    return True


def example_rows(text: str) -> list[tuple[list[float], int]]:
    """Features and label of a text's candidates that have one."""
    plain = text.translate(ALIKE) if not text.isascii() else text
    base = set(base_spans(text))
    made = []
    for span in candidates(plain):
        if span in base:
            made.append((describe(plain, span), 1))
        elif not keeps_rules(plain, span):
            made.append((describe(plain, span), 0))
    return made


def with_check_digit(body: str) -> str:
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def written_examples(count: int = WRITTEN, seed: int = 11) -> list[tuple[list[float], int]]:
    """Features and labels of made texts: per kind strict and loose forms, and look-alikes that are none."""
    draw = random.Random(seed)
    pick, number = draw.choice, lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    names = [a + b + c for a in ("an", "jo", "ma", "k", "li") for b in ("na", "hn", "rie", "urt", "s") for c in ("", ".lee", "_w", "77")]
    fill = "the report of last week shows that we are done with this part and go on to the next one as planned".split()

    def words(n):
        return " ".join(pick(fill) for _ in range(n))

    def email():
        at = pick(["@", "@", " (at) ", "(at)", " [at] ", " at ", " @ "])
        dot = "." if at.strip() == "@" else pick([" dot ", "[dot]", "(dot)", ".", " [dot] "])
        return pick(names) + at + pick(["mail", "post9", "web-office", "uni"]) + dot + pick(["com", "org", "de", "fr", "es"])

    def ip():
        return pick([".", ".", "[.]", "(.)", " . "]).join(str(draw.randint(1, 254)) for _ in range(4))

    def card():
        size = pick([15, 16, 16, 16, 13, 19])
        digits = with_check_digit(pick("3456") + number(size - 2))
        cut = pick(["", " ", "-", ".", " "])
        if size == 15 and cut:
            return cut.join((digits[:4], digits[4:10], digits[10:]))
        return cut.join(digits[i : i + 4] for i in range(0, size, 4)) if cut else digits

    def phone():
        lead = pick([f"+{draw.randint(1, 98)} ", f"00{draw.randint(30, 49)} ", "", f"+{draw.randint(1, 98)}-"])
        return lead + pick([f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"{number(3)}.{number(3)}.{number(4)}", f"{number(3)} {number(3)} {number(4)}"])

    def broken_card():
        size = pick([12, 13, 14, 16, 16, 18, 19])
        digits = number(size)
        return (digits[:-1] + str((int(digits[-1]) + 1) % 10)) if luhn(digits) else digits

    def plain_phone():
        """A national number without separators; only what stands before it tells it from an order number."""
        return pick(["0", "0", str(draw.randint(1, 9))]) + number(draw.randint(8, 11))

    def plain_number():
        return pick([number(draw.randint(9, 15)), plain_phone()])

    phone_cues = ("call", "Tel.", "tel", "Tel:", "phone", "Phone:", "Mobil", "mobile", "Fax", "fax:", "cell", "WhatsApp", "Ruf", "Telefon", "call me on", "phone number", "call us at", "numéro")
    other_cues = ("order", "order no.", "Order:", "id", "ID:", "invoice", "ref", "Ref.", "serial", "serial number", "account", "ticket", "item", "isbn", "version", "token", "timestamp", "build", "page", "code")

    cues = {"email": "mail me at", "ip": "from host", "card": "card number", "phone": "call me on"}
    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    look_alikes = [
        ("card", broken_card), ("card", lambda: f"order {broken_card()}"), ("card", lambda: f"id {number(13)}"),
        ("ip", lambda: f"version {draw.randint(1, 9)}.{draw.randint(0, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 9)}"),
        ("ip", lambda: f"{draw.randint(256, 999)}.{draw.randint(256, 999)}.{number(2)}.{number(3)}"),
        ("phone", lambda: f"19{number(2)}-{number(2)}-{number(2)} {number(2)}.{number(2)}"), ("phone", lambda: f"isbn 978-{number(1)}-{number(4)}-{number(4)}-{number(1)}"),
        ("phone", lambda: f"{number(2)} {number(2)} {number(2)} {number(2)} {number(2)}"), ("phone", lambda: f"$ {number(3)} {number(3)} {number(3)}"),
        ("phone", lambda: f"{number(9)}/{number(3)}"), ("phone", lambda: f"order {number(5)}-{number(5)}"), ("phone", lambda: f"{number(6)} {number(6)}"),
        ("phone", lambda: " ".join(number(draw.randint(1, 2)) for _ in range(draw.randint(9, 16)))), ("phone", lambda: " ".join(number(1) for _ in range(draw.randint(9, 16)))),
        ("email", lambda: f"{pick(names)} at {pick(fill)}. {pick(fill)}"), ("email", lambda: f"met at {pick(fill)} dot {pick(fill)}"), ("email", lambda: f"{pick(fill)} at {pick(fill)}.{pick(fill)}"),
    ]
    made = []

    def add(before: str, body: str, after: str, kind: str, label: int):
        text = f"{before}{body}{after}"
        for span in candidates(text):
            whole = span[0] == kind and span[1] <= len(before) + 1 and span[2] >= len(before) + len(body)
            if label and whole and span[1] >= len(before) - 1 and span[2] == len(before) + len(body):
                made.append((describe(text, span), 1))
            elif not label and span[1] < len(before) + len(body) and span[2] > len(before):
                made.append((describe(text, span), 0))
            elif label and span[0] != kind and not keeps_rules(text, span):
                made.append((describe(text, span), 0))

    for _ in range(count):
        for kind in KINDS:
            cue = f"{cues[kind]} " if draw.random() < 0.4 else f"{number(draw.randint(1, 3))} " if kind == "card" and draw.random() < 0.3 else ""
            add(f"{words(4)} {cue}", makers[kind](), f"{pick([' ', '. ', ', '])}{words(3)}", kind, 1)
        add(f"{words(4)} {pick(phone_cues)} ", plain_phone(), f"{pick([' ', '. ', ', '])}{words(3)}", "phone", 1)
        for cue in (f"{pick(other_cues)} ", f"{pick(other_cues)} ", ""):
            add(f"{words(4)} {cue}", plain_number(), f"{pick([' ', '. ', ', '])}{words(3)}", "phone", 0)
        for kind, make in draw.sample(look_alikes, 6):
            add(f"{words(4)} ", make(), f"{pick([' ', '. ', ', '])}{words(3)}", kind, 0)
    return made


@dataclass(frozen=True)
class Model:
    trees: Boosted
    slope: float
    intercept: float
    thresholds: tuple[float, ...]  # by kind

    def probability(self, row) -> float:
        z = self.slope * self.trees.margin(row) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The least probability above which the precision reaches PRECISION; LEAST_PROBABILITY at least."""
    order = np.argsort(-p, kind="stable")
    good = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    enough = np.flatnonzero(good >= PRECISION)
    return max(LEAST_PROBABILITY, float(p[order][enough[-1]])) if len(enough) else 0.99


def train(rows: list[tuple[list[float], int]]) -> Model:
    x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    held = np.arange(len(y)) % 3 == 0
    trees = fit_boosted(x[~held], y[~held])
    margins = np.array([trees.margin(row) for row in x[held]])
    slope, intercept = fit_logistic(margins, y[held])
    unset = Model(trees, float(slope), float(intercept), ())
    p = np.array([unset.probability(row) for row in x[held]])
    limits = tuple(threshold(p[mine], y[held][mine]) for mine in (x[held][:, 0] == k for k in range(len(KINDS))))
    return Model(trees, float(slope), float(intercept), limits)


def fit(docs: DataFrame, texts: int = FIT_TEXTS, examples: int = FIT_EXAMPLES) -> Model:
    """Trees from a bounded sample: at most ``texts`` ids, ``examples`` candidates of their documents."""
    ids = docs.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(texts)
    some = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select(F.col("id").cast("string"), "text")
    schema = "id string, rows array<struct<x:array<double>,y:int>>"
    found = map_texts(some, schema, lambda: lambda key, text: (key, [{"x": x, "y": y} for x, y in example_rows(text or "")]))
    found = found.select("id", F.posexplode("rows").alias("n", "row")).orderBy(F.xxhash64("id", "n"), "id", "n").limit(examples)
    natural = [(list(r["row"]["x"]), r["row"]["y"]) for r in found.collect()]
    return train(natural + written_examples())


class Covered:
    """Disjoint intervals in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int) -> bool:
        near = bisect_left(self.starts, end) - 1
        return near >= 0 and self.ends[near] > start

    def join(self, start: int, end: int) -> None:
        """Add an interval; one that overlaps the last one only lengthens it."""
        at = bisect_right(self.starts, start)
        if at and self.ends[at - 1] > start:
            self.ends[at - 1] = max(self.ends[at - 1], end)
        else:
            self.starts.insert(at, start)
            self.ends.insert(at, end)


def added_spans(text: str, base: list[Span], model: Model) -> list[tuple[str, int, int, float]]:
    """Candidates above their threshold, the likeliest first, none that overlaps another or a base span."""
    taken = Covered()
    for _, start, end in sorted(base, key=lambda s: s[1]):
        taken.join(start, end)
    judged = []
    for span in dict.fromkeys(candidates(text)):
        # most candidates lie in a base span; no tree need look at them
        if taken.meets(span[1], span[2]) or not keeps_rules(text, span):
            continue
        p = model.probability(describe(text, span))
        if p >= model.thresholds[KINDS.index(span[0])]:
            judged.append((*span, p))
    kept: list[tuple[str, int, int, float]] = []
    for found in sorted(judged, key=lambda s: (-s[3], s[1] - s[2], s[1], KINDS.index(s[0]))):
        if not taken.meets(found[1], found[2]):
            taken.join(found[1], found[2])
            kept.append(found)
    return kept


def scan_text(text: str | None, model: Model) -> tuple:
    """The columns of RESULT for one text."""
    text = text or ""
    base = in_order(base_spans(text))
    plain = text if text.isascii() else text.translate(ALIKE)
    added = added_spans(plain, base, model)
    found = in_order([*((*span, 1.0) for span in base), *added])
    return (
        *(sum(1 for span in base if span[0] == kind) for kind in KINDS),
        sha256_hex(joined_spans(base)),
        joined_spans(span[:3] for span in found),
        len(added),
        [{"kind": k, "start": s, "end": e, "probability": p} for k, s, e, p in found],
    )


def scan(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, the counts and digests of RESULT, and ``found``: every span with its probability (1 for base spans)."""
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column), F.col(text_column))
    return map_texts(rows, f"`{id_column}` {id_type}, {RESULT}", lambda: lambda key, text: (key, *scan_text(text, model)))
