"""Language identification: codes, plain recomputation, held-out accuracy, odd rows."""

import collections
import math
import random
import unicodedata

import numpy as np
import pytest
from cases import clashing, crc, empty, odd, odd_rows

from loomgrain.llm import language_id as ecoc
from loomgrain.llm.queries import QUERIES

SOUNDS = {
    "aa": "ka ta ma na sa".split(), "bb": "ste rund wech pfi or".split(), "cc": "ção lho nha ão".split(),
    "dd": "при ве сто на".split(), "ee": "ell iss ott umm".split(), "ff": "zyw szcz prz owa".split(), "gg": "ंक मे ले की".split(),
}


def text_of(lang, seed, words):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SOUNDS[lang]) for _ in range(draw.randint(1, 4))) for _ in range(words)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    langs = sorted(SOUNDS)
    rows = [(i, text_of(langs[i % 7], i, 3 + i % 40), langs[i % 7] if i % 11 else None) for i in range(1200)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


@pytest.mark.parametrize("count", [2, 3, 4, 6, 7, 20, 100])
def test_codewords_are_far_apart(count):
    code = ecoc.codewords(count)
    assert code.shape[0] == count and set(np.unique(code)) == {-1, 1}
    columns = {tuple(c) for c in code.T}
    assert len(columns) == code.shape[1] and not any(tuple(-x for x in c) in columns for c in columns)
    assert all(len(set(c)) == 2 for c in columns)
    least = ecoc.distances(code).min()
    assert least >= {2: 1, 3: 2, 4: 4, 6: 16, 7: 10, 20: 8, 100: 8}[count]


def test_wrong_bits_are_outvoted():
    code = ecoc.codewords(6)
    model = ecoc.Model(tuple("abcdef"), code, None, np.ones(code.shape))
    draw = random.Random(3)
    for c in range(6):
        for _ in range(20):
            margins = 3.0 * code[c].astype(float)
            for bit in draw.sample(range(code.shape[1]), (ecoc.distances(code).min() - 1) // 2):
                margins[bit] *= -1
            assert ecoc.decode(model, margins[None, :])[0][0] == c
    # a bit that is never right for a language counts less against it
    trust = np.ones(code.shape)
    assert ecoc.trust_in(code, np.tile(code[0] * 1.0, (9, 1)), np.zeros(9, int))[0] == pytest.approx(trust[0])


def plain_features(text):
    inside = [unicodedata.category(c)[0] in "LM" for c in text.lower()]
    words = "".join(c if i else " " for c, i in zip(text.lower(), inside)).split()
    shown = " " + " ".join(words) + " "
    counts = collections.Counter()
    for i in range(len(shown)):
        state = ecoc.SEED
        for c in shown[i : i + ecoc.LONGEST]:
            state = ((state ^ ord(c)) * int(ecoc.MIX)) % 2**64
            state ^= state >> 29
            counts[((state * int(ecoc.MIX)) % 2**64) >> (64 - ecoc.BUCKET_BITS)] += 1
    norm = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
    return {b: math.log1p(n) / norm for b, n in counts.items()}


def plain_answer(model, text):
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    x = plain_features(text)
    margins = [sum(v * float(model.weights[b, k]) for b, v in x.items()) + float(model.weights[-1, k]) for k in range(model.code.shape[1])]
    loss = [sum(model.trust[c, k] * math.log1p(math.exp(-m * model.code[c, k])) for k, m in enumerate(margins)) for c in range(len(model.languages))]
    likely = [math.exp(min(loss) - v) for v in loss]
    best = min(range(len(loss)), key=loss.__getitem__)
    return model.languages[best], likely[best] / sum(likely)


def test_answers_against_plain_python(labelled):
    docs, rows = labelled
    model = ecoc.fit(docs, rows=60)
    found = {r["doc_id"]: r for r in ecoc.identify(docs, model).collect()}
    for i, text, _ in rows[:150]:
        lang, score = plain_answer(model, text)
        assert found[i]["lang_pred"] == lang and abs(found[i]["score"] - score) < 1e-3
        assert found[i]["ambiguous"] == (found[i]["score"] - found[i]["second_score"] < ecoc.APART)
    out = [(i, lang) for i, _, lang in rows if lang and crc(i, 5) == 0]
    assert len(out) > 150 and sum(found[i]["lang_pred"] == lang for i, lang in out) > 0.97 * len(out)


def test_held_out_and_missing_languages_teach_nothing(labelled, spark):
    docs, rows = labelled
    spoilt = [(i, t, "aa" if crc(i, 5) == 0 else lang) for i, t, lang in rows]
    models = [ecoc.fit(x, rows=30) for x in (docs, spark.createDataFrame(spoilt, docs.schema).repartition(7))]
    assert models[0].languages == models[1].languages and np.array_equal(models[0].weights, models[1].weights)
    few = ecoc.fit(docs, rows=30, languages=3)
    assert len(few.languages) == 3


def test_query_on_held_out_documents(spark, folder):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op13_language"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(truth)
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in found)
    out = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.95 * len(out)


def test_odd_rows(spark):
    docs = clashing(odd(spark))
    model = ecoc.fit(docs)
    found = ecoc.identify(docs, model).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows())
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert all(r["lang_pred"] in {*model.languages, "und"} and 0 <= r["score"] <= 1 for r in found)
    none = ecoc.fit(empty(spark))
    assert none.languages == () and ecoc.identify(empty(spark), none).count() == 0
    assert {r["lang_pred"] for r in ecoc.identify(docs, none).collect()} == {"und"}
    alone = ecoc.fit(spark.createDataFrame([(1, "a b", "xx"), (2, "1 2", "yy")], "doc_id long, text string, lang string"))
    answers = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in ecoc.identify(odd(spark), alone).collect()}
    assert alone.languages == ("xx",) and answers[7] == ("xx", 1.0) and answers[5] == ("und", 0.0)
