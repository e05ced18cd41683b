"""Quality scores recomputed text by text from the fitted model, in plain Python."""

import math

import zstandard
from cases import odd_rows, prose

from loomgrain.llm import quality

SCALE = (100.0, 100.0, 10.0, 20.0, 3.0)


def sizes(dictionary, pieces):
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=3)
    packer = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False)
    return [len(packer.compress(piece)) for piece in pieces]


def plain_score(model, text):
    if not text:
        return model.prior
    data = text.encode()
    pieces = [data[at : at + 2048] for at in range(0, len(data), 2048)]
    good, bad = sizes(model.good, pieces), sizes(model.bad, pieces)
    # bytes of the text from the least good on, until half of it is covered
    worst, half = 0.0, len(data) / 2
    for gain, size in sorted(((b - g) / len(p), len(p)) for g, b, p in zip(good, bad, pieces)):
        covered = min(size, half)
        worst += gain * covered
        half -= covered
    ratio = sum(good) / len(data)
    x = (
        (sum(bad) - sum(good)) / (len(data) + 64),
        2 * worst / (len(data) + 64),
        ratio,
        max(0.0, 0.3 - ratio),
        min(1.0, 64 / len(data)),
    )
    z = sum(a * b * w for a, b, w in zip(x, SCALE, model.weights)) + model.weights[-1]
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def test_quality_scores_are_those_of_the_model(spark):
    rows, labels = [], []
    for i in range(600):
        good = int(i % 3 != 0)
        text = prose(i, 20 + i * 5 % 700) if good else " ".join(["XQ!! zvk", "kkp $$", "wvx zzt"][(i + j) % 3] for j in range(30 + i % 50))
        rows.append((i, text))
        labels.append((i, good))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert len(model.weights) == 6
    more = [*rows, *[(1000 + n, r[1]) for n, r in enumerate(odd_rows())]]
    found = {r["doc_id"]: r["score"] for r in quality.score(spark.createDataFrame(more, docs.schema).repartition(3), model).collect()}
    assert len(found) == len(more)
    for i, text in more:
        assert math.isclose(found[i], plain_score(model, text), abs_tol=1e-9)
