"""Quality and toxicity: held-out accuracy, separation from labels, odd tables; boosting and the label model."""

import numpy as np
import pytest
from cases import clashing, crc, empty, odd, odd_rows, prose

from loomgrain.llm import quality, toxicity
from loomgrain.llm.boosting import fit_boosted

BAD = ["zxq vvk", "kkp qqz", "wvx zzt", "qpx kvz"]


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for i in range(900):
        text = prose(i, 50 + i % 60)
        good, toxic = int(i % 4 != 0), int(i % 7 == 0)
        if not good:
            text = " ".join(BAD[(i + j) % 4].upper() + "!!" for j in range(40))
        if toxic:
            text = text.replace(" and ", f" {['grumbold', 'snarkle', 'vilewort'][i % 3]} ", 3) + f" blathering{i} you grumbold snarkle"
        rows.append((i, text))
        labels.append((i, good, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name, module, mod, held", [("quality", quality, 5, 0), ("toxic", toxicity, 4, 2)])
def test_held_out_accuracy(labelled, name, module, mod, held):
    docs, labels = labelled
    scores = {r["doc_id"]: r["score"] for r in module.score(docs, module.fit(docs, labels)).collect()}
    truth = {r["doc_id"]: r[name] for r in labels.collect()}
    out = [i for i in truth if crc(i, mod) == held]
    assert len(out) > 100 and all(0 <= s <= 1 for s in scores.values())
    right = sum((scores[i] >= module.ACCEPT) == (truth[i] == 1) for i in out) / len(out)
    assert right > 0.95


@pytest.mark.parametrize("name, module, mod, held", [("quality", quality, 5, 0), ("toxic", toxicity, 4, 2)])
def test_held_out_labels_change_nothing(labelled, spark, name, module, mod, held):
    docs, labels = labelled
    spoilt = [(r["doc_id"], 1 - r["quality"], 1 - r["toxic"]) if crc(r["doc_id"], mod) == held else tuple(r) for r in labels.collect()]
    spoilt = spark.createDataFrame(spoilt, "doc_id long, quality int, toxic int")
    some = docs.where("doc_id < 40")
    both = [sorted(map(tuple, module.score(some, module.fit(docs, x)).collect())) for x in (labels, spoilt)]
    assert both[0] == both[1]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_missing_labels(spark, labelled, module):
    docs, labels = labelled
    model = module.fit(docs, labels)
    found = module.score(clashing(odd(spark)), model).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows())
    assert len({r["score"] for r in found if r["doc_id"] in (3, 4)}) == 1
    assert module.score(empty(spark), model).count() == 0
    strange = spark.createDataFrame([(1, None, 7), (None, 1, 1), (2, 1, None), (1, 1, 1)], "doc_id long, quality int, toxic int")
    for none in (labels.limit(0), strange):
        scores = {r["score"] for r in module.score(odd(spark), module.fit(odd(spark), none)).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_keep_good_returns_the_rows_as_they_came(labelled):
    docs, labels = labelled
    kept = quality.keep_good(clashing(docs), quality.fit(docs, labels))
    assert kept.columns == clashing(docs).columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    assert len(ids ^ good) < 30


def test_label_model_finds_accuracies_and_dependencies():
    draw = np.random.default_rng(3)
    y = (draw.random(4000) < 0.3).astype(int)
    said = lambda right: np.where(draw.random(4000) < right, y, 1 - y) + 0
    votes = np.column_stack([np.where(said(p) == 1, 1, 2) for p in (0.9, 0.8, 0.7, 0.6)])
    votes = np.column_stack([votes, votes[:, 3]])  # the last voter repeats the one before
    noisy = np.where(draw.random(4000) < 0.75, y, 1 - y)
    model = toxicity.fit_labels(votes, noisy, np.ones(4000))
    assert model.parent[4] == 3 or model.parent[3] == 4
    found = toxicity.log_odds(votes, model) > 0
    majority = (votes == 1).sum(axis=1) >= 3
    assert (found == y).mean() > (majority == y).mean() and (found == y).mean() > 0.88
    # a copy of a voter adds nothing
    alone = toxicity.fit_labels(votes[:, :4], noisy, np.ones(4000))
    assert abs(toxicity.log_odds(votes, model) - toxicity.log_odds(votes[:, :4], alone)).mean() < 0.5


def test_boosted_trees():
    draw = np.random.default_rng(5)
    x = draw.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(int)
    model = fit_boosted(x[:1000], y[:1000])
    right = np.mean([(model.margin(row) > 0) == want for row, want in zip(x[1000:], y[1000:])])
    assert right > 0.95
    assert fit_boosted(np.zeros((0, 3)), np.zeros(0)).trees == () and fit_boosted(np.ones((5, 2)), np.ones(5)).margin([1, 1]) > 0
