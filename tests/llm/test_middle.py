"""Fill in the middle: against a plain version on code points, cuts at every place, odd rows."""

import hashlib
import re

import numpy as np
from cases import as_tuples, clashing, empty, odd, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgrain.llm import middle

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def by_hand(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return key, n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return key, n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


PIECES = st.lists(st.sampled_from(["a", "Zz", "\0", "@[`{", "é", "漢", "𝔘", " ", "<P>", "<", "S>", "abcdefghij", "\x7f", "ÿ", "1\n"]), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES.map("".join), min_size=1, max_size=8))
def test_words_of_eight_bytes_against_a_plain_version(texts):
    data = "".join(texts).encode()
    starts = np.cumsum([0, *[len(t.encode()) for t in texts]])
    columns = middle.rearranged(list(range(len(texts))), data, starts)
    found = [(i, *row[:-1], row[-1].decode()) for i, row in enumerate(zip(*columns))]
    assert found == [by_hand(i, t) for i, t in enumerate(texts)]


def test_each_place_can_be_cut():
    text = "aé漢𝔘bc def, ghijklmnopqrstuvwxyz"
    units = UNIT.findall(text)
    n = len(units)
    for one in range(n + 1):
        data, starts = (text + text).encode(), np.array([0, len(text.encode()), 2 * len(text.encode())])
        sizes, low, high, points = middle.cut_at(data, starts, np.array([one, one]), np.array([n, 0]))
        assert sizes.tolist() == [n, n]
        ends = [len("".join(units[:one]).encode()), starts[1] + len("".join(units[:one]).encode())]
        assert [low[0], high[1]] == ends and (high[0], low[1]) == (starts[1], starts[1])
        assert points(low)[0] == len("".join(units[:one]))


def test_rows_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(middle, "BYTES_AT_ONCE", 3000)
    rows = [(i, prose(i, i % 50) + "é, <" * (i % 3)) for i in range(300)] + [(None, "ab cd"), (-5, "x" * 9000), (900, None)]
    found = middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    expected = sorted((by_hand(*r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert as_tuples(found, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == expected
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}
    texts = as_tuples(found.select("doc_id", middle.restored().alias("text")))
    assert texts == sorted(((i, t or "") for i, t in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_odd_rows(spark):
    found = middle.fill_in_middle(clashing(odd(spark)))
    expected = sorted((by_hand(r[0], r[1]) for r in odd_rows()), key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert as_tuples(found, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == expected
    assert middle.fill_in_middle(empty(spark)).count() == 0
    marked = spark.createDataFrame([(1, "a <M> b"), (2, "<P>")], "doc_id long, text string")
    assert as_tuples(middle.fill_in_middle(marked), "form", "output") == [("plain", "<P>"), ("plain", "a <M> b")]


def test_other_shares(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    forms = {r["form"] for r in middle.fill_in_middle(docs, share=100, suffix_first=100).select("form").distinct().collect()}
    assert forms == {"spm"}
    assert middle.fill_in_middle(docs, seed="2").select("output").distinct().count() > 1
