"""Quality classifier by compression.

Two zstandard dictionaries are built from blocks of good and of bad labelled
text. A text is cut into blocks, all of it, and each block compressed against
both: what the good dictionary saves over the bad one, per byte, is the
normalised difference. Logistic regression turns it into a probability.

Bounds: the dictionaries see ``DICTIONARY_BLOCKS`` blocks per class and the
calibration ``CALIBRATION_ROWS`` documents per class, both chosen by hash from
the labelled rows that may be learnt from. Scoring reads every text whole.

Defined results: a NULL or empty text gets the share of good documents among
the labelled ones as its score; without labels of both classes every text gets
that constant. Rows that repeat an id are scored each. Only the id and the text
are read from the documents; a label whose quality is neither 0 nor 1 is not
used, and where a document has several labels each counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.llm.arrow import map_texts, with_computed
from loomgrain.llm.common import crc_remainder, private_name
from loomgrain.llm.linear import fit_logistic, logistic

BLOCK = 2048
DICTIONARY_BYTES = 112 * 1024
DICTIONARY_BLOCKS = 2000
DICTIONARY_ROWS = 2000
CALIBRATION_ROWS = 2000
LEVEL = 3
SHRINK = 64  # bytes; keeps the noise of very short texts small
REPETITIVE = 0.3  # prose does not compress below this share in blocks of this size
HOLD_OUT = 5
ACCEPT = 0.3
# brings the features to a like range for the ridge
SCALE = np.array([100.0, 100.0, 10.0, 20.0, 3.0])


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8")
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def measure(good: bytes, bad: bytes):
    """A function that gives the features of a text.

    The normalised size difference, the same on the text's worst half, the
    compressed share, how far that lies below what prose reaches (repetition
    compresses well with either dictionary), and how short the text is.
    """
    import zstandard

    def compressor(data):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    by_good, by_bad = compressor(good), compressor(bad)

    def features(text: str) -> list[float]:
        saved = []
        packed = 0
        for block in blocks(text):
            small = len(by_good.compress(block))
            packed += small
            saved.append((len(by_bad.compress(block)) - small, len(block)))
        total = sum(n for _, n in saved)
        worst, left = 0.0, total / 2
        for s, n in sorted(saved, key=lambda x: x[0] / x[1]):
            part = min(n, left)
            worst += s * part / n
            left -= part
            if left <= 0:
                break
        ratio = packed / total
        return [
            sum(s for s, _ in saved) / (total + SHRINK),
            2 * worst / (total + SHRINK),
            ratio,
            max(0.0, REPETITIVE - ratio),
            min(1.0, SHRINK / total),
        ]

    return features


def labelled(docs: DataFrame, labels: DataFrame, rows: int, part: int) -> DataFrame:
    """quality, text of at most ``rows`` labelled documents per class that may be learnt from.

    ``part`` 0 or 1 gives two disjoint sets. Ids are chosen first, on narrow
    rows, so only the chosen texts are read.
    """
    usable = labels.where(
        F.col("quality").isin(0, 1) & (crc_remainder(HOLD_OUT) != 0) & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part)
    ).select(F.col("doc_id").alias("id"), "quality")
    place = F.xxhash64("id", F.lit(7))
    per_class = [usable.where(F.col("quality") == q).orderBy(place, "id").limit(rows) for q in (0, 1)]
    chosen = per_class[0].unionAll(per_class[1])
    # at most 2 * rows ids
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "quality", "text")


def sample_blocks(texts: DataFrame) -> dict[int, list[bytes]]:
    """At most DICTIONARY_BLOCKS blocks per class, by hash; collected, bounded by their number and BLOCK."""

    def cut(batches):
        import pandas as pd

        for batch in batches:
            made = [
                (q, f"{key}.{n}", block)
                for key, q, text in zip(batch["id"], batch["quality"], batch["text"])
                for n, block in enumerate(blocks(text))
            ]
            yield pd.DataFrame(made, columns=["quality", "place", "block"])

    rows = texts.mapInPandas(cut, "quality int, place string, block binary")
    found = {}
    for q in (0, 1):
        # rows of one class only; the limit is applied in each task before anything moves
        some = rows.where(F.col("quality") == q).orderBy(F.xxhash64("place"), "place").limit(DICTIONARY_BLOCKS)
        found[q] = [bytes(r["block"]) for r in some.select("block").collect()]
    return found


def dictionary(samples: list[bytes]) -> bytes:
    """Trained where the trainer finds enough to work on, else the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def features_of(rows: DataFrame, keys: list[str], good: bytes, bad: bytes) -> DataFrame:
    """``keys`` and x, the features, per row of (keys, text); empty texts have none and are left out."""
    types = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def start():
        features = measure(good, bad)
        return lambda *row: (*row[:-1], features(row[-1]))

    return map_texts(rows.where("text != ''").select(*keys, "text"), f"{types}, x array<double>", start)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    samples = sample_blocks(labelled(docs, labels, DICTIONARY_ROWS, 0))
    good, bad = dictionary(samples[1]), dictionary(samples[0])
    if not (good and bad):
        counts = {r["quality"]: r["count"] for r in labels.where(crc_remainder(HOLD_OUT) != 0).groupBy("quality").count().collect() if r["quality"] in (0, 1)}
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return Model(b"", b"", (), share)
    measured = features_of(labelled(docs, labels, CALIBRATION_ROWS, 1), ["quality"], good, bad).collect()
    x = np.array([r["x"] for r in measured]).reshape(len(measured), -1)
    y = np.array([r["quality"] for r in measured], float)
    # the classes were sampled apart: weigh them back to their shares among the labels
    counts = {r["quality"]: r["count"] for r in labels.where(crc_remainder(HOLD_OUT) != 0).groupBy("quality").count().collect()}
    weight = np.where(y == 1, counts.get(1, 0) / max(1, (y == 1).sum()), counts.get(0, 0) / max(1, (y == 0).sum()))
    weight = weight / weight.mean() if len(weight) and weight.mean() > 0 else weight
    prior = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    return Model(good, bad, tuple(fit_logistic(x * SCALE, y, weight)), prior)


def scorer(model: Model):
    """The function from text to score, with its compressors made."""
    if not model.weights:
        return lambda text: model.prior
    features, beta = measure(model.good, model.bad), np.array(model.weights)
    return lambda text: float(logistic(np.array(features(text)) * SCALE, beta)) if text else model.prior


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and score of every row of ``docs``. The model travels with the function: two dictionaries."""
    types = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def start():
        each = scorer(model)
        return lambda *row: (*row[:-1], each(row[-1]))

    return map_texts(docs.select(*keys, "text"), f"{types}, score double", start)


def keep_good(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` scored at least ``accept``, in one pass and without a shuffle; columns as they came."""
    verdict = private_name("score")
    scored = with_computed(docs, verdict, T.DoubleType(), "text", lambda: scorer(model))
    return scored.where(F.col(verdict) >= accept).drop(verdict)
