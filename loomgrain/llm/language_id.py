"""Language identification with error-correcting output codes.

Every language has a codeword, and one binary classifier per bit, a logistic
regression on hashed character n-grams, predicts that bit of a text's codeword.
All texts of a language teach all bits, so a new language needs no classifier
of its own and a bit that errs is outvoted. Decoding weighs each bit's loss
against a codeword by how reliable the bit was for that language on texts kept
back from the fit; the codeword of the least loss is the answer. A text whose
two nearest codewords are almost as near as each other is flagged ambiguous.

With up to ``EXHAUSTIVE`` languages the code has every split of them; beyond
that ``BITS`` drawn columns, the draw with the largest least distance.

Bounds: the fit reads at most ``ROWS`` documents of a language and ``ALL_ROWS``
in all, by hash of the id, of the ``LANGUAGES`` commonest languages. Each gives
its whole text and a passage of ``PASSAGE`` code points, so that short texts are
learnt too. Identifying reads every text whole.

Defined results: a NULL text and a text without letters are ``und`` with score
0 and not ambiguous, and so is every text when nothing could be learnt; with
one language learnt every text with letters has it, with score 1. Rows without
a language teach nothing; rows that repeat an id are identified each, and those
that repeat id and language teach once; no rows give no rows. Only id and text
are read to identify.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.arrow import map_texts
from loomgrain.llm.common import crc_remainder, worker_cache
from loomgrain.operators.ranking import top_per_group

HOLD_OUT = 5
UNKNOWN = "und"
LONGEST = 4  # code points of an n-gram
BUCKET_BITS = 12
ROWS = 400
ALL_ROWS = 4000
LANGUAGES = 256
PASSAGE = 48
EXHAUSTIVE = 6
BITS = 48
KEPT_BACK = 4  # every fourth document of the sample weighs the bits instead of fitting them
STEPS = 250
RIDGE = 1e-5
APART = 0.2  # least difference of the two best languages' scores
SEED = 20260101

MIX = np.uint64(0x9E3779B97F4A7C15)
BLANK = 32


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # buckets + 1 x bits, the last row is the intercept
    trust: np.ndarray  # languages x bits, each row adds up to the number of bits


def word_points():
    """Which code points belong to words: letters and the marks that follow them."""
    held = worker_cache("word-points")
    if not held:
        import unicodedata

        held["table"] = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)), bool, 0x110000)
    return held["table"]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(text: str):
    """Unit vector over the buckets of all n-grams of the text's lower-case words; other characters count as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[BLANK], points, [BLANK]]).astype(np.uint32)
    inside = word_points()[points]
    inside_before = np.concatenate([[True], inside[:-1]])
    points = np.where(inside, points, BLANK)[inside | inside_before].astype(np.uint64)
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    state = np.full(len(points), SEED, np.uint64)
    with np.errstate(over="ignore"):
        for n in range(min(LONGEST, len(points))):
            state = (state[: len(points) - n] ^ points[n:]) * MIX
            state ^= state >> np.uint64(29)
            buckets = (state * MIX) >> np.uint64(64 - BUCKET_BITS)
            counts += np.bincount(buckets.view(np.int64), minlength=len(counts))
    x = np.log1p(counts).astype(np.float32)
    return x / np.sqrt(x @ x)


def distances(code):
    """In how many bits each pair of codewords differs."""
    apart = (code.shape[1] - code @ code.T) // 2
    return apart[np.triu_indices(len(code), 1)]


def codewords(count: int, bits: int = BITS, draws: int = 200):
    """languages x bits of -1 and 1; no column is constant and none repeats another or its opposite."""
    if count <= EXHAUSTIVE:
        columns = [[1 if i == 0 or not (split >> (i - 1)) & 1 else -1 for i in range(count)] for split in range(1, 1 << max(0, count - 1))]
        return np.array(columns, np.int64).reshape(len(columns), count).T
    draw = np.random.Generator(np.random.PCG64(SEED))
    best, best_distance = None, -1
    for _ in range(draws):
        # balanced columns: half of the languages on each side
        sides = np.where(np.arange(count) < count // 2, -1, 1)
        code = np.stack([draw.permutation(sides) for _ in range(bits)], axis=1)
        code = np.unique(code * code[0], axis=1)
        nearest = int(distances(code).min())
        if nearest > best_distance:
            best, best_distance = code, nearest
    return best


def fit_bits(x, y, weight, steps: int = STEPS, ridge: float = RIDGE):
    """Weights of all bits at once by accelerated gradient steps; rows of ``x`` have length 1, the intercept adds 1."""
    x = np.column_stack([x, np.ones(len(x), np.float32)]).astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    beta = ahead = np.zeros((x.shape[1], y.shape[1]), np.float32)
    step, momentum = np.float32(2.0), 1.0
    for _ in range(steps):
        pull = weight * y / (1 + np.exp(np.clip(y * (x @ ahead), -30, 30)))
        new = ahead + step * (x.T @ pull - np.float32(ridge) * ahead)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = (new + np.float32((momentum - 1) / following) * (new - beta)).astype(np.float32)
        beta, momentum = new, following
    return beta


def trust_in(code, margins, labels):
    """How often each bit was right for each language, smoothed; rows add up to the number of bits."""
    bits = code.shape[1]
    right = np.ones((len(code), bits))
    for c in range(len(code)):
        own = margins[labels == c]
        right[c] = ((own * code[c] > 0).sum(axis=0) + 1) / (len(own) + 2)
    return right * bits / right.sum(axis=1, keepdims=True)


def decode(model: Model, margins):
    """Places of the nearest and second nearest codeword and their scores, per row of ``margins``."""
    loss = np.zeros((len(margins), len(model.languages)))
    for c in range(len(model.languages)):
        loss[:, c] = np.logaddexp(0, -margins * model.code[c]) @ model.trust[c]
    likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
    likely /= likely.sum(axis=1, keepdims=True)
    order = np.argsort(-likely, axis=1, kind="stable")
    first, second = order[:, 0], order[:, min(1, order.shape[1] - 1)]
    rows = np.arange(len(margins))
    return first, second, likely[rows, first], likely[rows, second]


def sample(docs: DataFrame, rows: int, all_rows: int, languages: int) -> DataFrame:
    """id, lang, text of the documents to learn from. Ids are chosen first, on narrow rows."""
    usable = docs.select(F.col("doc_id").alias("id"), "lang").where(F.col("lang").isNotNull() & (crc_remainder(HOLD_OUT, "id") != 0)).distinct()
    # a row per language at most; the order makes the choice the same each time
    common = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    known = [r["lang"] for r in common.collect()]
    if not known:
        return docs.select(F.col("doc_id").alias("id"), "lang", "text").limit(0)
    each = max(1, min(rows, all_rows // len(known)))
    placed = usable.where(F.col("lang").isin(known)).withColumn("place", F.xxhash64("id", F.lit(13)))
    # at most all_rows ids, or one of each language
    chosen = F.broadcast(top_per_group(placed, ["lang"], [("place", "asc"), ("id", "asc")], each).drop("place"))
    texts = docs.select(F.col("doc_id").alias("id"), "lang", "text").join(chosen, ["id", "lang"])
    return texts.where("text IS NOT NULL")


def measured(texts: DataFrame) -> DataFrame:
    """lang, kept_back, and the features of the whole text and of a passage as buckets and values."""

    def start():
        import zlib

        def sparse(text):
            x = features(text)
            at = np.flatnonzero(x)
            return at.astype(np.int32).tolist(), x[at].tolist()

        def each(key, lang, text):
            if not has_letter(text):
                return (key, lang, None, None, None, None)
            place = zlib.crc32(str(key).encode()) % max(1, len(text) - PASSAGE)
            passage = text[place : place + PASSAGE]
            return (key, lang, *sparse(text), *(sparse(passage) if has_letter(passage) else (None, None)))

        return each

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, lang string, at array<int>, x array<float>, part_at array<int>, part_x array<float>"
    found = map_texts(texts.select("id", "lang", "text"), schema, start).where("at IS NOT NULL")
    # rows that repeat id and language teach once
    return found.groupBy("id", "lang").agg(F.min(F.struct("at", "x", "part_at", "part_x")).alias("f")).select("id", "lang", "f.*")


def fit(docs: DataFrame, rows: int = ROWS, all_rows: int = ALL_ROWS, languages: int = LANGUAGES) -> Model:
    """Learns from text and language of the documents that are not held out."""
    import zlib

    found = sorted(measured(sample(docs, rows, all_rows, languages)).collect(), key=lambda r: (r["lang"], r["id"]))
    known = sorted({r["lang"] for r in found})
    code = codewords(len(known))
    if len(known) < 2:
        return Model(tuple(known), code, np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    vectors, labels, back = [], [], []
    for r in found:
        kept_back = zlib.crc32(f"kept back {r['id']}".encode()) % KEPT_BACK == 0
        for at, values in ((r["at"], r["x"]), (r["part_at"], r["part_x"])):
            if at is not None:
                vectors.append((at, values))
                labels.append(known.index(r["lang"]))
                back.append(kept_back)
    x = np.zeros((len(vectors), 1 << BUCKET_BITS), np.float32)
    for i, (at, values) in enumerate(vectors):
        x[i, at] = values
    labels, back = np.array(labels), np.array(back)
    # a language all of whose documents were kept back is fitted on them
    for c in range(len(known)):
        if back[labels == c].all():
            back[labels == c] = False
    fitted = ~back
    sizes = np.bincount(labels[fitted], minlength=len(known))
    weights = fit_bits(x[fitted], code[labels[fitted]].astype(np.float32), 1.0 / sizes[labels[fitted]])
    margins = x[back] @ weights[:-1] + weights[-1]
    return Model(tuple(known), code, weights, trust_in(code, margins, labels[back]))


FOUND = "lang_pred string, score double, second string, second_score double, ambiguous boolean"


def identifier(model: Model, apart: float = APART):
    """The function from a text to the columns of FOUND."""

    def each(text):
        if not model.languages or not has_letter(text):
            return UNKNOWN, 0.0, None, None, False
        if len(model.languages) == 1:
            return model.languages[0], 1.0, None, None, False
        margins = features(text) @ model.weights[:-1] + model.weights[-1]
        first, second, best, next_best = (v[0] for v in decode(model, margins[None, :].astype(float)))
        return model.languages[first], float(best), model.languages[second], float(next_best), bool(best - next_best < apart)

    return each


def identify(docs: DataFrame, model: Model, apart: float = APART) -> DataFrame:
    """doc_id and FOUND of every row of ``docs``. The model travels with the function; its size follows from the bounds."""

    def start():
        each = identifier(model, apart)
        return lambda key, text: (key, *each(text))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), f"doc_id {kind}, {FOUND}", start)
