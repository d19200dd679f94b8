"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Documents become counts of hashed character 2-grams and 3-grams over letters (anything else is a
blank). Document frequencies cover every labelled document of the learning folds. The regression is
trained with follow-the-regularised-leader, per-coordinate rates and an elastic net (the L1 part leaves
most weights at exactly zero), on ``FIT_ROWS`` documents of each language, drawn by hash; this bound
is a parameter and the only thing that doesn't grow with the corpus. Another ``CALIBRATION_ROWS`` of
each language, apart from those, set the temperature that turns scores into calibrated probabilities.

A prediction reads the text and nothing else.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if no
labelled document exists; documents without a label or an id aren't learned from; repeated rows are
drawn and predicted alike; no rows give no rows; extra columns are ignored by ``predict`` and kept by
``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import fresh

#: Hashed features; a power of two.
FEATURES = 1 << 15
#: Documents of a language to fit the weights on, and to calibrate on.
FIT_ROWS, CALIBRATION_ROWS = 500, 250
#: More values of ``lang`` than this are taken for something else: a model holds weights for each.
MOST_LANGUAGES = 1000
EPOCHS = 3
#: Follow-the-regularised-leader: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 1e-4
UNDETERMINED = "und"

c = F.col


@cache
def _letters() -> np.ndarray:
    """By code point: the lower-case letter, or a blank for what isn't a letter."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        if (char := chr(point)).isalpha():
            out[point] = ord(char.lower()[0])
    return out


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a whole text and their counts; none if it has no letter."""
    codes = _letters()[np.frombuffer((text or "").encode("utf-32-le"), np.uint32)]
    blank = codes == 32
    if blank.all():
        return np.array([], np.int64), np.array([], np.int64)
    kept = codes[~(blank & np.concatenate(([True], blank[:-1])))]
    kept = np.concatenate((np.array([32], np.uint32), kept, np.array([32], np.uint32))).astype(np.uint64)
    mix = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    two = kept[:-1] * mix[0] + kept[1:] * mix[1]
    hashed = np.concatenate((two, two[:-1] + kept[2:] * mix[2] + np.uint64(1)))
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    counts = np.bincount((hashed >> np.uint64(64 - 15)).astype(np.int64), minlength=FEATURES)
    places = np.flatnonzero(counts)
    return places, counts[places]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (FEATURES, languages)
    temperature: float = 1.0

    def values(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[places]
        return x / np.sqrt((x * x).sum())

    def scores(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.values(places, counts) @ self.weights[places]

    def predict(self, text: str | None) -> tuple[str, float]:
        places, counts = features(text)
        if not len(places) or not self.languages:
            return UNDETERMINED, 0.0
        p = _softmax(self.scores(places, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Model:
    """Weights by follow-the-regularised-leader over (language, places, counts), in a fixed shuffled order."""
    shape = (FEATURES, len(model.languages))
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    prepared = [(language, places, model.values(places, counts)) for language, places, counts in rows if len(places)]
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(prepared)):
            language, places, x = prepared[i]
            zi, ni = z[places], n[places]
            w = weights(zi, ni)
            error = _softmax(x @ w)
            error[language] -= 1
            g = x[:, None] * error
            grown = ni + g * g
            z[places] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[places] = grown
    model.weights = weights(z, n)
    return model


def calibrate(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """The temperature with the lowest log loss on rows the weights haven't seen (golden section)."""
    kept = [(language, model.scores(places, counts)) for language, places, counts in rows if len(places)]
    if not kept:
        return model
    truth, scores = np.array([r[0] for r in kept]), np.array([r[1] for r in kept])

    def loss(log_t: float) -> float:
        return -np.log(_softmax(scores / np.exp(log_t))[np.arange(len(truth)), truth] + 1e-300).mean()

    lo, hi, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    model.temperature = float(np.exp((lo + hi) / 2))
    return model


def _document_frequencies(texts: DataFrame) -> np.ndarray:
    """Per feature, how many of the texts have it; the last entry counts the texts.

    Tasks add up their own texts, so at most one row for a feature and task is shuffled.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total[features(text)[0]] += 1
            total[FEATURES] += len(batch)
        places = np.flatnonzero(total)
        yield pd.DataFrame({"feature": places, "n": total[places]})

    out = np.zeros(FEATURES + 1)
    for row in texts.select("text").mapInPandas(work, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["feature"]] = row["n"]
    return out


def _drawn(labelled: DataFrame, n: int, most_languages: int) -> DataFrame:
    """(lang, turn, places, counts) of ``n`` documents of each language with the lowest hashes."""
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()
    if len(counted) > most_languages:
        raise ValueError(f"more than {most_languages} languages: lang doesn't hold labels")
    per_language = {r["lang"]: r["n"] for r in counted}
    if not per_language:
        return None
    # a threshold on the hash leaves about twice as many rows as needed before they are ranked
    share = F.create_map(*(F.lit(x) for lang, rows in per_language.items() for x in (lang, 2.0 * n / rows)))
    draw = F.xxhash64("doc_id", "text")
    low = (F.shiftrightunsigned(draw, 11).cast("double") / F.lit(float(1 << 53))) <= share[c("lang")]
    few = labelled.filter(low).withColumn("turn", F.row_number().over(W.partitionBy("lang").orderBy(draw, "doc_id"))).filter(c("turn") <= n)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [features(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "lang": batch["lang"],
                    "turn": batch["turn"],
                    "places": [p.astype("<i4").tobytes() for p, _ in rows],
                    "counts": [k.astype("<i4").tobytes() for _, k in rows],
                }
            )

    return few.select("lang", "turn", "text").mapInPandas(work, "lang string, turn int, places binary, counts binary")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS, most_languages: int = MOST_LANGUAGES) -> Model:
    """A model of the non-null ``lang`` of (doc_id, text, lang); ``most_languages`` values of it or a ValueError."""
    labelled = labelled.filter(c("lang").isNotNull()).select("doc_id", "text", c("lang").cast("string").alias("lang"))
    drawn = _drawn(labelled, fit_rows + calibration_rows, most_languages)
    if drawn is None:
        return Model([], np.zeros(FEATURES), np.zeros((FEATURES, 0)))
    rows = [(r["lang"], r["turn"], np.frombuffer(r["places"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in drawn.toLocalIterator()]
    rows.sort(key=lambda r: r[:2])
    df = _document_frequencies(labelled)
    languages = sorted({r[0] for r in rows})
    model = Model(languages, np.log((1 + df[FEATURES]) / (1 + df[:FEATURES])) + 1, np.zeros((FEATURES, len(languages))))
    place = {lang: i for i, lang in enumerate(languages)}
    most = {lang: sum(r[0] == lang for r in rows) for lang in languages}
    # a third of a language's rows calibrate, as in the bounds, if it has fewer than they allow
    share = calibration_rows / (fit_rows + calibration_rows)
    seen = [(place[lang], p, k) for lang, turn, p, k in rows if turn <= np.ceil(most[lang] * (1 - share))]
    held = [(place[lang], p, k) for lang, turn, p, k in rows if turn > np.ceil(most[lang] * (1 - share))]
    model = calibrate(train(model, seen), held)
    model.weights, model.idf = model.weights.astype(np.float32), model.idf.astype(np.float32)
    return model


def predicted(text: Column, model: Model) -> Column:
    """Struct of lang_pred and score."""

    def work(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score"])

    return F.pandas_udf(work, "lang_pred string, score double")(text)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls into the held-out fold; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the documents that aren't held out."""
    model = fit(docs.filter(~held_out(c("doc_id")) & c("doc_id").isNotNull()))
    rows = docs.select("doc_id", held_out(c("doc_id")).alias("held_out"), predicted(c("text"), model).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, least_score: float = 0.35) -> DataFrame:
    """``docs`` without those whose language can't be told: no letter, or a score under ``least_score``."""
    model = fit(docs.filter(~held_out(c("doc_id")) & c("doc_id").isNotNull()))
    p = fresh("p", docs.columns)
    rows = docs.withColumn(p, predicted(c("text"), model))
    return rows.filter((c(p)["lang_pred"] != UNDETERMINED) & (c(p)["score"] >= least_score)).drop(p)
