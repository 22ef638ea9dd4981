"""Toxicity scores by weak supervision.

1. From a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each class, those with
   the least hash of their id) Spark counts in how many toxic and clean texts each stem
   occurs: whole words and their first 4 to 7 letters, once, twice or more. The stems that mark toxic texts
   most surely become lexicon voters, next to lists of common insults, patterns
   (address and insult together, shouting, runs of marks), counts of hits, and the absence
   of any hit as a vote for a clean text. The label of a row is one more voter.
2. A generative label model estimates by expectation maximization how often each voter
   votes what in either class, and how voters go together within a class. A voter weighs
   the less the more others say the same, so nested stems do not count many times.
3. A logistic regression over the stems is trained on the posterior labels.
4. Every text is scored with it in one pass.

The sample bounds the training alone; all texts are scored whole. Nothing but the text
enters a score.

Null and empty texts get the score of a text without any known stem. Labels that are
null are left out, an id labelled twice counts as toxic if any of its rows does. Without
labels of both classes the lists of insults alone decide. Scores are made row by row, so
repeated rows and ids stay; other columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_CLASS = 6000
VOTER_STEMS = 120
MODEL_STEMS = 4000
LEAST_EVIDENCE = 12.0  # twice the log likelihood ratio of a stem
LEAST_CORRELATION = 0.1
REPEATS = 0.8  # correlation above which two voters are taken for one
PREFIXES = (4, 5, 6, 7)

#: Common insults, by list; fixed values.
INSULTS = {
    "persons": "idiot idiots moron morons loser losers clown clowns scum fool jerk bastard bitch asshole imbecile",
    "qualities": "stupid dumb pathetic worthless disgusting useless ugly retarded filthy",
    "other": "trash garbage crap shit fuck fucking damn hate kill",
    "de": "idiot dummkopf arschloch scheisse scheiße dumm wertlos abschaum",
    "fr": "connard connasse salaud merde stupide imbecile imbécile débile ordure",
    "es": "idiota estupido estúpido imbecil imbécil basura mierda cabron cabrón",
}
_SEEDS = {name: frozenset(words.split()) for name, words in INSULTS.items()}
_ALL_SEEDS = frozenset().union(*_SEEDS.values())

_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(
    r"\b(?:you|your|he|she|they|this|that|du|ihr|tu|vous|eres)\b\W+(?:\w+\W+){0,3}?(?:%s)\b" % "|".join(sorted(_ALL_SEEDS))
)
_SHOUT = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")
_MARKS = re.compile(r"[!?]{2,}")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def words_of(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").lower()))


def stems_of(words: Counter[str]) -> set[str]:
    """Words and beginnings of words; those that come twice or four times, also as such."""
    times: Counter[str] = Counter()
    for word, n in words.items():
        times["=" + word] += n
        for length in PREFIXES:
            if len(word) > length:
                times[word[:length]] += n
    found = set(times)
    found.update(stem + "*2" for stem, n in times.items() if n >= 2)
    found.update(stem + "*4" for stem, n in times.items() if n >= 4)
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for label, text in _texts(batches):
        (toxic if label else clean).update(stems_of(words_of(text)))
    stems = list(toxic.keys() | clean.keys())
    for begin in range(0, len(stems), 50_000):
        part = stems[begin : begin + 50_000]
        yield pa.record_batch(
            [pa.array(part), pa.array([toxic[s] for s in part], pa.int64()), pa.array([clean[s] for s in part], pa.int64())],
            names=["stem", "toxic", "clean"],
        )


def _evidence(sizes: tuple[int, int]) -> Column:
    """Twice the log likelihood ratio of a stem against being as frequent in both classes."""
    n1, n0 = sizes
    k1, k0 = F.col("toxic"), F.col("clean")
    share = (k1 + k0) / F.lit(n1 + n0)

    def term(k: Column, n: int, p: Column) -> Column:
        inside = F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
        return inside + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)

    return F.when(k1 / n1 > k0 / n0, 2 * (term(k1, n1, share) + term(k0, n0, share))).otherwise(0.0)


_SHOWN = [*_SEEDS, "address", "shouting", "marks"]


def _found_stems(batches: Iterator[pa.RecordBatch], place: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Of each sampled text the places of its known stems, and a bit for each list it hits and pattern it shows."""
    schema = pa.schema([("toxic", pa.int32()), ("stems", pa.binary()), ("shows", pa.int32())])
    for label, text in _texts(batches):
        text = text or ""
        words = words_of(text)
        lowered = text.lower()
        shows = [bool(seeds & words.keys()) for seeds in _SEEDS.values()]
        shows.append(bool(_ADDRESS.search(lowered)))
        shows.append(len(_SHOUT.findall(text)) * 2 > len(text.split()) > 0)
        shows.append(len(_MARKS.findall(text)) >= 3)
        found = sorted(place[s] for s in stems_of(words) & place.keys())
        bits = sum(1 << i for i, shown in enumerate(shows) if shown)
        yield pa.record_batch([[int(label)], [np.array(found, np.int32).tobytes()], [bits]], schema=schema)


def label_model(votes: np.ndarray, weights: np.ndarray, prior: float, rounds: int = 25) -> np.ndarray:
    """The probability that each row is toxic, from votes of 1, -1 and 0 (none).

    ``weights`` are row weights. For each voter and class the rates of its three votes
    are estimated, and from the residuals of both classes how voters correlate; a voter's
    say is divided by the sum of its absolute correlations above ``LEAST_CORRELATION``.
    Until the classes are told apart, all that separates them would pass for correlation, so
    the first half of the rounds only shares out the say of voters that nearly repeat
    each other.
    """
    rows, voters = votes.shape
    kinds = (1, -1, 0)

    def totals(mass: np.ndarray) -> np.ndarray:
        """The mass of each kind of vote of each voter; one kind is laid out at a time."""
        return np.stack([mass @ (votes == v) for v in kinds], axis=1)

    rates = np.empty((2, voters, 3))
    overall = np.maximum(totals(weights) / weights.sum(), 1e-6)
    for y, lean in ((1, (3.0, 1 / 3, 1.0)), (0, (1 / 3, 3.0, 1.0))):
        start = overall * np.array(lean)
        rates[y] = start / start.sum(axis=1, keepdims=True)

    def spread_of(mass: np.ndarray) -> np.ndarray:
        """Covariance of the votes under a mass of rows."""
        residual = (votes - mass @ votes) * np.sqrt(mass)[:, None]
        return residual.T @ residual

    covariance = spread_of(weights / weights.sum())
    size = np.maximum(np.sqrt(np.diag(covariance)), 1e-9)
    say = 1 / np.maximum((np.abs(covariance / np.outer(size, size)) > REPEATS).sum(axis=1), 1)
    posterior = np.full(rows, prior)
    for turn in range(rounds):
        odds = np.full(rows, math.log(prior / (1 - prior)))
        for k, v in enumerate(kinds):
            odds += (votes == v) @ (say * np.log(rates[1, :, k] / rates[0, :, k]))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        covariance = np.zeros((voters, voters))
        for y, mass in ((1, posterior * weights), (0, (1 - posterior) * weights)):
            total = mass.sum() + 1e-9
            rates[y] = (totals(mass) + 0.5 * overall + 1e-3) / (total + 0.5 + 3e-3)
            covariance += spread_of(mass / total)
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        if turn >= rounds // 2:
            linked = np.abs(covariance / np.outer(spread, spread))
            say = 1 / np.maximum(np.where(linked > LEAST_CORRELATION, linked, 0).sum(axis=1), 1.0)
        prior = float(np.clip(np.average(posterior, weights=weights), 1e-3, 1 - 1e-3))
    return posterior


def fit_linear(rows: list[np.ndarray], size: int, target: np.ndarray, weights: np.ndarray, rounds: int = 400):
    """Logistic regression over present stems: their weights and the constant."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = weights / weights.sum()
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        score = b + np.bincount(owner, w[flat], len(rows))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) * scale
        g, gb = np.bincount(flat, error[owner], size) + 1e-4 * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.1 / (1 - 0.9**t)
        w = w - step * m / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b = b - step * mb / (math.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, b


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    constant: float

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self._sum(words_of(text), self.heads())))))

    def heads(self) -> frozenset[str]:
        return frozenset(s.partition("*")[0].lstrip("=")[:4] for s in self.weights)

    def _sum(self, words: Counter[str], heads: frozenset[str]) -> float:
        near = Counter({w: n for w, n in words.items() if w[:4] in heads})
        return self.constant + sum(map(self.weights.get, stems_of(near) & self.weights.keys())) if near else self.constant


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """``docs`` with ``doc_id, text`` and ``labels`` with ``doc_id, toxic``."""
    fallback = Model({"=" + w: 4.0 for w in sorted(_ALL_SEEDS)}, -3.0)
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {bool(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return fallback
    least = F.xxhash64("doc_id")
    sample = [known.filter(F.col("toxic") == y).orderBy(least, "doc_id").limit(per_class) for y in (1, 0)]
    # At most 2 * per_class rows of an id and a flag.
    chosen = F.broadcast(sample[0].union(sample[1]))
    texts = docs.join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("toxic", "text").persist()
    try:
        n = {bool(r["toxic"]): r["count"] for r in texts.groupBy("toxic").count().collect()}
        if len(n) < 2:
            return fallback
        counted = (
            texts.mapInArrow(_count_stems, "stem string, toxic long, clean long")
            .groupBy("stem")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .withColumn("evidence", _evidence((n[True], n[False])))
            .filter(F.col("evidence") > LEAST_EVIDENCE)
        )
        best = [r["stem"] for r in counted.orderBy(F.desc("evidence"), "stem").limit(MODEL_STEMS).collect()]
        vocabulary = frozenset(best) | {"=" + w for w in _ALL_SEEDS}
        place = {stem: i for i, stem in enumerate(sorted(vocabulary))}
        # Numbers, not words, and one row for each sampled text.
        found = texts.mapInArrow(lambda it: _found_stems(it, place), "toxic int, stems binary, shows int").toArrow()
    finally:
        texts.unpersist()
    rows = [np.frombuffer(x.as_py(), np.int32) for x in found["stems"]]
    labels_of, shown = (found[c].to_numpy() for c in ("toxic", "shows"))
    weights = np.where(labels_of == 1, sizes[True] / n[True], sizes[False] / n[False])
    stems = best[:VOTER_STEMS]
    votes = np.zeros((len(rows), len(stems) + len(_SHOWN) + 4), np.int8)
    column = np.full(len(place), -1)
    column[[place[s] for s in stems]] = np.arange(len(stems))
    strong = (column >= 0) | np.array([s[1:] in _ALL_SEEDS for s in sorted(vocabulary)])
    for i, own in enumerate(rows):
        votes[i, column[own][column[own] >= 0]] = 1
        hits = int(strong[own].sum())
        votes[i, -4] = hits >= 2
        votes[i, -3] = 1 if hits else -1
        votes[i, -2] = 0 if len(own) else -1
    for j in range(len(_SHOWN)):
        votes[:, len(stems) + j] = shown >> j & 1
    votes[:, -1] = np.where(labels_of == 1, 1, -1)
    posterior = label_model(votes, weights, sizes[True] / (sizes[True] + sizes[False]))
    w, b = fit_linear(rows, len(place), posterior, weights)
    return Model({s: float(w[i]) for s, i in place.items() if abs(w[i]) > 1e-6}, float(b))


def _score(batches: Iterator[pa.RecordBatch], model: Model, at: int) -> Iterator[pa.RecordBatch]:
    heads = model.heads()
    for batch in batches:
        sums = [model._sum(words_of(t.as_py()), heads) for t in batch.column(at)]
        scores = pa.array([1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in sums], pa.float64())
        kept = [c for i, c in enumerate(batch.columns) if i != at]
        names = [c for i, c in enumerate(batch.schema.names) if i != at]
        yield pa.record_batch([*kept, scores], names=[*names, "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for each row of ``doc_id, text``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(lambda it: _score(it, model, 1), "doc_id long, score double")


def _keep(batches: Iterator[pa.RecordBatch], model: Model, text: str, limit: float) -> Iterator[pa.RecordBatch]:
    heads = model.heads()
    limit = math.log(limit / (1 - limit))
    for batch in batches:
        kept = [model._sum(words_of(t.as_py()), heads) < limit for t in batch.column(text)]
        yield batch.filter(pa.array(kept, pa.bool_()))


def drop_toxic(docs: DataFrame, model: Model, text_column: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score is below ``limit``."""
    return docs.mapInArrow(lambda it: _keep(it, model, text_column, limit), docs.schema)
