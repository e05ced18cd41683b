"""Fill-in-the-middle transformation, units found and selected with words of eight bytes.

A unit is a run of ASCII letters or any other single code point. The UTF-8 of
many texts is viewed as uint64 words, and the bytes that end a unit are marked
in their high bits with arithmetic alone: a byte ends a unit unless the next
one continues its code point, or both are letters. ``bitwise_count`` gives the
marks of each word and a running sum the units up to it. The n-th unit of a
text is then found by a search in the running sum for the word, and by clearing
the lowest marks of that word for the byte in it. The same sums over the bytes
that start a code point turn byte places into code points.

Where the cuts fall follows from the id alone, so a repeated task gives the
same rows, and no row needs another one: no shuffle. Texts are worked on a few
MB at a time, or one at a time where a text is longer.

Defined results: a NULL text counts as empty; empty texts and texts that hold
one of the marks stay plain whatever was drawn; a NULL id draws as the empty
string; rows that repeat an id are cut alike where their units are as many; no
rows give no rows. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SHARE = 90  # percent of the texts that are rearranged
SUFFIX_FIRST = 20  # percent of those that begin with the suffix
SEED = "1"
BYTES_AT_ONCE = 4 << 20

PARTS = "n long, form string, prefix_chars long, middle_chars long, output string"

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
ONE, EIGHT, TOP = np.uint64(1), np.uint64(8), np.uint64(56)


def next_byte(marks):
    """At each byte the mark of the byte after it; nothing follows the last one."""
    after = marks >> EIGHT
    after[:-1] |= marks[1:] << TOP
    return after


def marked(words):
    """High bits of the bytes that end a unit, and of those that start a code point."""
    follows = words & ~(words << ONE) & HIGH  # 10xxxxxx
    folded = (words | (ONES * np.uint64(0x20))) & LOW
    letter = (folded + ONES * np.uint64(0x80 - ord("a"))) & ~(folded + ONES * np.uint64(0x7F - ord("z"))) & ~words & HIGH
    return HIGH & ~next_byte(follows) & ~(letter & next_byte(letter)), HIGH & ~follows


class Marks:
    """Marked bytes with a running sum of them per word."""

    def __init__(self, words):
        self.words = words
        self.counts = np.bitwise_count(words).astype(np.int64)
        self.upto = np.cumsum(self.counts)

    def before(self, places):
        """Marks in front of each byte place."""
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        inside = self.words[word] & ((ONE << (byte * EIGHT)) - ONE)
        return self.upto[word] - self.counts[word] + np.bitwise_count(inside)

    def behind(self, numbers):
        """The place behind the mark of each number, counted from 1."""
        word = np.searchsorted(self.upto, numbers, side="left")
        left = numbers - (self.upto[word] - self.counts[word])
        rest = self.words[word]
        for cleared in range(1, 8):
            rest = np.where(left > cleared, rest & (rest - ONE), rest)
        lowest = rest & (~rest + ONE)
        return (word << 3) + (np.bitwise_count(lowest - ONE) >> 3).astype(np.int64) + 1


def drawn(key, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that follow from the id."""
    text = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(text[i : i + 8], 16) for i in (0, 8, 16, 24))


def cut_at(data: bytes, starts, first, second):
    """n, and byte places of both cuts per text, and a function from places to code points.

    ``starts`` has the place of each text in ``data`` and one past the end;
    ``first`` and ``second`` are the drawn numbers.
    """
    size = len(data)
    words = np.frombuffer(data + bytes(8 + -size % 8), "<u8")
    units, points = marked(words)
    # a text's last byte ends a unit, whatever the next text begins with
    flags = units.view(np.uint8)
    last = starts[1:][starts[1:] > starts[:-1]] - 1
    flags[last] = 0x80
    ends = Marks(units)
    base = ends.before(starts)
    n = base[1:] - base[:-1]
    low, high = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    cuts = [np.where(k > 0, ends.behind(np.maximum(base[:-1] + k, 1)), starts[:-1]) for k in (low, high)]
    return n, cuts[0], cuts[1], Marks(points).before


def rearranged(keys, data: bytes, starts, share: int = SHARE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED):
    """Columns of PARTS, the output as bytes, for the texts of ``data``."""
    draws = np.array([drawn(key, seed) for key in keys], np.int64).reshape(-1, 4)
    if not len(data):
        none = [None] * len(keys)
        return [0] * len(keys), ["plain"] * len(keys), none, none, [b""] * len(keys)
    n, first, second, points = cut_at(data, starts, draws[:, 0], draws[:, 1])
    opened = points(starts[:-1])
    chars = (points(first) - opened).tolist(), (points(second) - points(first)).tolist()
    forms, prefix_chars, middle_chars, outputs = [], [], [], []
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    rows = zip(starts[:-1].tolist(), first.tolist(), second.tolist(), starts[1:].tolist(), draws[:, 2].tolist(), draws[:, 3].tolist())
    for at, (start, one, two, end, form, order) in enumerate(rows):
        text = data[start:end]
        if not text or form % 100 >= share or any(mark in text for mark in marks):
            forms.append("plain")
            outputs.append(text)
            prefix_chars.append(None)
            middle_chars.append(None)
            continue
        prefix, middle, suffix = data[start:one], data[one:two], data[two:end]
        prefix_chars.append(chars[0][at])
        middle_chars.append(chars[1][at])
        if order % 100 < suffix_first:
            forms.append("spm")
            outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
    return n.tolist(), forms, prefix_chars, middle_chars, outputs


def fill_in_middle(docs: DataFrame, share: int = SHARE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """doc_id and PARTS of every row of ``docs``; ``output`` is the rearranged text."""
    wanted = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(PARTS).fields])

    def work(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        for batch in batches:
            column = batch.column(1).fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            whole = column.buffers()[2]
            first = 0
            while first < len(column):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BYTES_AT_ONCE, side="right")) - 1)
                keys = batch.column(0).slice(first, last - first)
                data = whole.slice(int(offsets[first]), int(offsets[last] - offsets[first])).to_pybytes() if whole else b""
                made = rearranged(keys.to_pylist(), data, offsets[first : last + 1] - offsets[first], share, suffix_first, seed)
                columns = [pa.array(values, field.type) for values, field in zip(made[:-1], list(arrow)[1:-1])]
                output = pa.array(made[-1], pa.binary()).view(pa.string()).cast(arrow[-1].type)
                yield pa.RecordBatch.from_arrays([keys.cast(arrow[0].type), *columns, output], schema=arrow)
                first = last

    return docs.select("doc_id", "text").mapInArrow(work, wanted)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text an output was made of: no mark occurs in a rearranged text, so the marks tell its parts."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(F.col(output))
    )
