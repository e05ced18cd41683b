"""Toxicity by weak supervision.

Many voters look at a text: lexicons written by hand, lexicons of terms mined
from labelled texts, and patterns. A mined term is a word start and how many
different words with it a text has at least. Each voter says toxic, clean or nothing. A
generative label model estimates from the votes how accurate every voter is and
which voters depend on each other: given the class, votes follow a forest whose
edges are the strongest conditional dependencies, refitted by expectation
maximisation. A label counts there as one more voter of a fixed, imperfect
accuracy. A linear classifier is then trained on the posterior labels, and only
it scores texts.

Bounds: lexicons are mined from ``MINED_ROWS`` documents per class, label model
and classifier see ``FITTED_ROWS`` others per class, all chosen by hash from
the labelled rows that may be learnt from. Of the terms mined, the
``MOST_CANDIDATES`` that tell most are looked at, the first ``MOST_TERMS`` that
are not nested are kept, and the first ``TERM_FEATURES`` have a weight of their
own; the others count through the number and density of hits. Scoring reads
every text whole, and words of any length by their starts.

Defined results: a NULL or empty text gets the score of a text without hits;
without labels of both classes every text gets the share of toxic labels as its
score. Rows that repeat an id are scored each. Only the id and the text are
read; a label whose toxic is neither 0 nor 1 is not used, and where a document
has several labels each counts.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.arrow import map_texts
from loomgrain.llm.common import crc_remainder, worker_cache
from loomgrain.llm.linear import fit_logistic, logistic

HOLD_OUT, HELD = 4, 2
ACCEPT = 0.3
MINED_ROWS = 2000
FITTED_ROWS = 3000
STARTS = (3, 4, 5, 6, 7)  # letters of a word start
TIMES = (1, 2, 3)  # different words with that start
LEAST_TEXTS = 3  # toxic texts a mined term is in
LEAST_LIFT = 8  # how many times more common among toxic texts
LONGEST = 40  # letters of a word whose starts are held for the next text
MOST_TERMS = 2000  # mined terms that are kept, strongest first
MOST_CANDIDATES = 20_000
MINED_VOTERS = 12
TERM_FEATURES = 300
LABEL_TRUST = 0.9
ROUNDS = 25
LEAST_DEPENDENCE = 0.01  # nats of conditional mutual information for an edge
KNOWN_WORDS = 300_000

LEXICONS = {
    "insults_en": "idiot idiots moron morons imbecile loser losers scum trash filth vermin stupid dumb pathetic worthless disgusting clown dimwit jerk creep fool liar pig rat coward degenerate".split(),
    "insults_de": "idiot dummkopf trottel depp abschaum dreck blödmann versager arschloch widerlich erbärmlich wertlos ekelhaft dumm schwachkopf hurensohn".split(),
    "insults_fr": "idiot imbécile crétin connard connasse ordure débile minable pathétique dégoûtant stupide abruti salaud raclure".split(),
    "insults_es": "idiota imbécil estúpido estúpida basura escoria patético asqueroso inútil tonto cabrón payaso gilipollas perdedor".split(),
    "threats": "kill murder strangle hang burn beat stab töten umbringen verprügeln tuer frapper matar golpear".split(),
}
SECOND_PERSON = frozenset("you your yours u du dich dir euch ihr tu toi te vous tú ti usted ustedes eres".split())
PATTERNS = ("addressed", "several", "dense", "shouted", "marks", "nothing", "lone")
VOTERS = (*LEXICONS, *(f"mined_{i}" for i in range(MINED_VOTERS)), *PATTERNS)
WORDS = re.compile(r"[^\W_]+")
STYLE = 6


@dataclass(frozen=True)
class LabelModel:
    """P(class), the voter each voter depends on (-1: none) and P(vote | class, vote depended on)."""

    prior: float
    parent: tuple[int, ...]
    tables: np.ndarray  # voter, class, parent's vote, vote


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...]
    weights: tuple[float, ...]
    prior: float
    labels: LabelModel | None = field(default=None, compare=False)


def starts_of(word: str) -> list[str]:
    """The starts of a word that a term may name, and the word itself with an end mark."""
    return [*(word[:n] for n in STARTS if len(word) > n), f"{word}$"]


def terms_of(words) -> list[str]:
    """Terms of a text's different words, as start@times."""
    starts = Counter(start for word in words for start in starts_of(word))
    return [f"{start}@{n}" for start, count in starts.items() for n in TIMES if n <= count]


def term_counts(texts: DataFrame) -> DataFrame:
    """term, n0, n1: clean and toxic texts that have it, counted per task first."""

    def count(batches):
        import pandas as pd

        for batch in batches:
            seen = (Counter(), Counter())
            for toxic, text in zip(batch["toxic"], batch["text"]):
                words = set(WORDS.findall((text or "").lower()))
                seen[toxic].update(terms_of(words))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"term": terms, "n0": [seen[0][t] for t in terms], "n1": [seen[1][t] for t in terms]})

    counted = texts.select("toxic", "text").mapInPandas(count, "term string, n0 long, n1 long")
    return counted.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def labelled(docs: DataFrame, labels: DataFrame, rows: int, part: int) -> DataFrame:
    """toxic, text of at most ``rows`` labelled documents per class that may be learnt from; parts 0 and 1 are disjoint."""
    usable = learnable(labels).where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part).select(F.col("doc_id").alias("id"), "toxic")
    place = F.xxhash64("id", F.lit(9))
    per_class = [usable.where(F.col("toxic") == y).orderBy(place, "id").limit(rows) for y in (0, 1)]
    # at most 2 * rows ids
    chosen = F.broadcast(per_class[0].unionAll(per_class[1]))
    return docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id")).select("toxic", "text")


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_remainder(HOLD_OUT) != HELD))


def mine(docs: DataFrame, labels: DataFrame) -> list[str]:
    """Terms far more common among toxic texts, strongest first; of nested ones the strongest only."""
    texts = labelled(docs, labels, MINED_ROWS, 0)
    sizes = {r["toxic"]: r["n"] for r in learnable(labels).where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = (float(max(1, min(MINED_ROWS, sizes.get(y, 0)))) for y in (0, 1))
    rate0, rate1 = (F.col("n0") + 0.5) / clean, F.col("n1") / toxic
    both = (F.col("n0") + F.col("n1")) / F.lit(clean + toxic)
    gain = F.col("n1") * F.ln(rate1 / both) + F.when(F.col("n0") > 0, F.col("n0") * F.ln(F.col("n0") / clean / both)).otherwise(0.0)
    found = (
        term_counts(texts)
        .where((F.col("n1") >= LEAST_TEXTS) & (rate1 >= LEAST_LIFT * rate0))
        .select("term", gain.alias("gain"))
        .orderBy(F.desc("gain"), "term")
        .limit(MOST_CANDIDATES)
        .collect()
    )
    kept: list[str] = []
    taken, inside = set(), set()
    for row in found:
        start, times = row["term"].rsplit("@", 1)
        word = start.rstrip("$")
        shorter = [(word[:n], times) for n in STARTS if n < len(word) or start.endswith("$")]
        if (start, times) in inside or any(x in taken for x in shorter):
            continue
        kept.append(row["term"])
        taken.add((start, times))
        inside.update(shorter)
        if len(kept) == MOST_TERMS:
            break
    return kept


class Reader:
    """Hits and votes of one text after another."""

    def __init__(self, terms):
        self.terms: dict[str, list[tuple[int, int]]] = {}
        for i, term in enumerate(terms):
            start, times = term.rsplit("@", 1)
            self.terms.setdefault(start, []).append((int(times), i))
        self.known = worker_cache(f"toxicity:{hash(tuple(terms))}")
        self.lexicons = [frozenset(words) for words in LEXICONS.values()]

    def starts(self, word: str) -> tuple[str, ...]:
        """The starts of a word that terms name."""
        found = self.known.get(word)
        if found is None:
            found = tuple(s for s in starts_of(word) if s in self.terms)
            if len(word) <= LONGEST:
                if len(self.known) >= KNOWN_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def read(self, text: str | None) -> tuple[list[int], list[int], list[float]]:
        """Votes (1 toxic, 2 clean, 0 none), mined terms hit, style features."""
        text = text or ""
        words = WORDS.findall(text.lower())
        counts = Counter(words)
        starts, places = Counter(), {}
        for word in counts:
            for start in self.starts(word):
                starts[start] += 1
                places.setdefault(start, []).append(word)
        terms, hits = [], set()
        for start, n in starts.items():
            for times, i in self.terms[start]:
                if n >= times:
                    terms.append(i)
                    hits.update(places[start])
        terms.sort()
        by_hand = [any(w in counts for w in lexicon) for lexicon in self.lexicons]
        upper, lower = sum(map(str.isupper, text)), sum(map(str.islower, text))
        shouted = upper / max(1, upper + lower)
        marks = text.count("!!") + text.count("??")
        total = sum(counts[w] for w in hits)
        per_100 = 100 * total / max(1, len(words))
        any_hit = bool(terms) or any(by_hand)
        groups = {t % MINED_VOTERS for t in terms}
        votes = [int(x) for x in by_hand]
        votes += [int(g in groups) for g in range(MINED_VOTERS)]
        votes += [
            int(any_hit and not SECOND_PERSON.isdisjoint(counts)),
            int(len(terms) >= 3),
            int(per_100 >= 1),
            int(shouted > 0.5),
            int(marks >= 3),
            0 if any_hit else 2,
            2 if len(terms) == 1 and total == 1 and len(words) >= 200 else 0,
        ]
        style = [
            np.log1p(len(terms)), min(3.0, per_100), float(any(by_hand)), shouted, min(1.0, marks / 10), 1.0 if not any_hit else 0.0,
        ]
        return votes, terms, [float(x) for x in style]


def dependence(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Mutual information of each two voters given the class, under soft classes."""
    size = votes.shape[1]
    one_hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)  # row, voter, vote
    total = np.zeros((size, size))
    for weight in (1 - toxic, toxic):
        share = weight.sum() / len(weight)
        if share <= 0:
            continue
        flat = one_hot.reshape(len(votes), -1)
        joint = (flat * weight[:, None]).T @ flat / weight.sum()
        alone = flat.T @ weight / weight.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            part = np.where(joint > 0, joint * np.log(joint / np.outer(alone, alone)), 0.0)
        total += share * part.reshape(size, 3, size, 3).sum(axis=(1, 3))
    np.fill_diagonal(total, 0.0)
    return total


def forest(strength: np.ndarray, least: float = LEAST_DEPENDENCE) -> tuple[int, ...]:
    """Parent of each voter in the forest of the strongest dependencies, -1 for a root."""
    size = len(strength)
    parent = [-1] * size
    reached: set[int] = set()
    for root in range(size):
        if root in reached:
            continue
        reached.add(root)
        tree = [root]
        while True:
            edges = [(strength[a, b], -a, -b) for a in tree for b in range(size) if b not in reached and strength[a, b] >= least]
            if not edges:
                break
            _, a, b = max(edges)
            parent[-b] = -a
            reached.add(-b)
            tree.append(-b)
    return tuple(parent)


def tables_of(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray, parent) -> np.ndarray:
    """P(vote | class, parent's vote), smoothed."""
    size = votes.shape[1]
    tables = np.zeros((size, 2, 3, 3))
    for j in range(size):
        above = votes[:, parent[j]] if parent[j] >= 0 else np.zeros(len(votes), int)
        for y, share in enumerate((1 - toxic, toxic)):
            marginal = np.bincount(votes[:, j], share * weight, 3) + 0.5
            marginal /= marginal.sum()
            for v in range(3):
                rows = above == v
                seen = np.bincount(votes[rows, j], (share * weight)[rows], 3) + 2 * marginal
                tables[j, y, v] = seen / seen.sum()
    return tables


def log_odds(votes: np.ndarray, model: LabelModel) -> np.ndarray:
    """Log odds of toxic given the votes."""
    found = np.full(len(votes), np.log(model.prior / (1 - model.prior)))
    for j, above in enumerate(model.parent):
        given = votes[:, above] if above >= 0 else np.zeros(len(votes), int)
        found += np.log(model.tables[j, 1, given, votes[:, j]] / model.tables[j, 0, given, votes[:, j]])
    return found


def fit_labels(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray, trust: float = LABEL_TRUST) -> LabelModel:
    """Expectation maximisation; the class of a row is hidden, its label one voter that is right with ``trust``."""
    said = np.log(trust / (1 - trust)) * np.where(labels == 1, 1.0, -1.0)
    toxic = np.where(labels == 1, trust, 1 - trust)
    model = None
    for _ in range(ROUNDS):
        prior = float(np.clip(weight @ toxic / weight.sum(), 1e-4, 1 - 1e-4))
        parent = forest(dependence(votes, toxic))
        model = LabelModel(prior, parent, tables_of(votes, toxic, weight, parent))
        new = 1 / (1 + np.exp(-np.clip(log_odds(votes, model) + said, -35, 35)))
        settled = float(np.abs(new - toxic).max()) < 1e-4
        toxic = new
        if settled:
            break
    return model


def features(terms: list[int], style: list[float]) -> np.ndarray:
    row = np.zeros(TERM_FEATURES + STYLE)
    row[[t for t in terms if t < TERM_FEATURES]] = 1.0
    row[TERM_FEATURES:] = style
    return row


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    counts = {r["toxic"]: r["n"] for r in learnable(labels).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if not (counts.get(0) and counts.get(1)):
        return Model((), (), prior)
    terms = mine(docs, labels)

    def start():
        reader = Reader(terms)
        return lambda toxic, text: (toxic, *reader.read(text))

    schema = "toxic int, votes array<int>, terms array<int>, style array<double>"
    rows = map_texts(labelled(docs, labels, FITTED_ROWS, 1), schema, start).collect()
    y = np.array([r["toxic"] for r in rows], int)
    if not len(y) or y.min() == y.max():
        return Model((), (), prior)
    # the classes were sampled apart: weigh them back to their shares among the labels
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    weight = weight / weight.mean()
    votes = np.array([r["votes"] for r in rows], int)
    generative = fit_labels(votes, y, weight)
    posterior = 1 / (1 + np.exp(-np.clip(log_odds(votes, generative), -35, 35)))
    x = np.array([features(r["terms"], r["style"]) for r in rows])
    return Model(tuple(terms), tuple(fit_logistic(x, posterior, weight, ridge=0.05)), prior, generative)


def scorer(model: Model):
    """The function from text to score."""
    if not model.weights:
        return lambda text: model.prior
    reader, beta = Reader(model.terms), np.array(model.weights)

    def each(text):
        _, terms, style = reader.read(text)
        return float(logistic(features(terms, style), beta))

    return each


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and score of every row of ``docs``; the model travels with the function."""
    types = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def start():
        each = scorer(model)
        return lambda *row: (*row[:-1], each(row[-1]))

    return map_texts(docs.select(*keys, "text"), f"{types}, score double", start)
