"""Toxicity: a logistic classifier that is fitted to ignore which group a sentence names.

Features of a text are its lower-cased letter runs and the first 5, 6 and 7 letters of longer ones; each counts once
per document. Spark counts in how many toxic and other documents of the sample each feature occurs and keeps the most
telling ones (G statistic); the rest of the fit is small: the sample's documents as lists of kept features go to the
driver. The loss is the logistic loss of the labels, a quadratic penalty, and COUNTERFACTUAL times the squared change
of the score when the group terms of a labelled sentence are swapped, each for the next term of its list, and left out.
Swaps have no other effect, so a mention of a group moves the score as little as no mention does.

The sample is bounded: the SAMPLE labelled rows of the training folds with the least hash of doc_id and label. Scoring covers
all whole texts: every word of a text is looked up in the broadcast weights (at most FEATURES + the group terms).
Null labels are left out, a document labelled twice counts twice, empty and null texts score as the intercept says.
Without labels, or with one class only, all scores are the share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.words import by_chunk, held_out, id_and_bytes, least_hashes, read_documents

SAMPLE = 20_000
FEATURES = 2_048
LEAST_DOCS = 5
LEAST_G = 25.0
RIDGE = 1e-5
COUNTERFACTUAL = 10.0
STEPS = 5_000
CHUNK_BYTES = 4 << 20
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 6, 7)

# Terms that name groups, by what they are swapped within; the last of each list names anyone.
GROUPS = [
    "women men girls boys ladies gentlemen people".split(),
    "woman man girl boy lady gentleman person".split(),
    "muslim christian jewish hindu buddhist catholic atheist religious".split(),
    "muslims christians jews hindus buddhists catholics atheists believers".split(),
    "black white asian african latino arab european human".split(),
    "gay lesbian straight bisexual transgender queer heterosexual adult".split(),
    "immigrant refugee foreigner migrant native citizen".split(),
    "immigrants refugees foreigners migrants natives citizens".split(),
    "disabled blind deaf autistic elderly young ordinary".split(),
    "frauen männer mädchen jungen leute".split(),
    "muslime christen juden ausländer flüchtlinge bürger".split(),
    "femmes hommes filles garçons gens".split(),
    "musulmans chrétiens juifs étrangers réfugiés citoyens".split(),
    "mujeres hombres chicas chicos gente".split(),
    "musulmanes cristianos judíos extranjeros refugiados ciudadanos".split(),
]


TERMS = frozenset(term for group in GROUPS for term in group)


def words_of(text: bytes | None) -> set[str]:
    """The features; group terms have no beginnings, so that a swap changes nothing else."""
    words = set(WORD.findall((text or b"").decode().lower()))
    for word in words - TERMS:
        if len(word) > PREFIXES[0]:
            words |= {word[:n] + "*" for n in PREFIXES if len(word) > n}
    return words


def swaps(words: set[str]) -> list[set[str]]:
    """The document with each group term replaced by the next of its list, and with no group named."""
    named, other = words & TERMS, set(words - TERMS)
    if not named:
        return []
    turned = {g[(k + 1) % len(g)] for g in GROUPS for k, term in enumerate(g) if term in named}
    return [other | turned, other]


@dataclass
class Classifier:
    weights: dict[str, float]
    intercept: float

    def score(self, words: set[str]) -> float:
        z = self.intercept + sum(self.weights[w] for w in sorted(words & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, words (distinct) and toxic of the sample."""
    usable = labels.where(~held_out(5) & F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    chosen = least_hashes(usable, SAMPLE, "doc_id", "toxic")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([sorted(words_of(r[1])) for r in rows], pa.list_(pa.string())),
                    pa.array([r[2] for r in rows], pa.int32()),
                ],
                ["doc_id", "words", "toxic"],
            )

    # At most SAMPLE rows of two numbers: the documents need no shuffle.
    found = id_and_bytes(docs).join(F.broadcast(chosen), "doc_id")
    return found.mapInArrow(split, "doc_id long, words array<string>, toxic int")


def telling_words(sample: DataFrame, toxic: int, other: int) -> list[str]:
    """The words whose presence says most about the label."""
    counts = sample.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    ).where(F.col("a") + F.col("b") >= LEAST_DOCS)
    n = toxic + other

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    held = F.col("a") + F.col("b")
    g = 2 * (
        term(F.col("a"), held * toxic / n) + term(F.col("b"), held * other / n)
        + term(toxic - F.col("a"), (n - held) * toxic / n) + term(other - F.col("b"), (n - held) * other / n)
    )
    best = counts.select("word", g.alias("g")).where(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "word").limit(FEATURES)
    found = {r["word"]: r["g"] for r in best.collect()}

    def shorter(word: str) -> list[str]:
        return [word[:n] + "*" for n in PREFIXES if n < len(word.rstrip("*"))]

    # A word whose beginning tells as much or more adds nothing.
    return [w for w, g in found.items() if not any(found.get(s, 0) >= g for s in shorter(w))]


def fit(documents: list[tuple[list[str], int]], vocabulary: list[str]) -> Classifier:
    """Minimise the loss by accelerated gradient steps, each weight with a fixed step size."""
    vocabulary = sorted({*vocabulary, *TERMS})
    number = {w: k for k, w in enumerate(vocabulary)}

    def rows(sets: list[set[str]]) -> tuple[np.ndarray, np.ndarray]:
        held = [[number[w] for w in s if w in number] for s in sets]
        return np.repeat(np.arange(len(held)), [len(h) for h in held]), np.array([k for h in held for k in h], np.int64)

    sets = [set(words) for words, _ in documents]
    y = np.array([t for _, t in documents], np.float64)
    doc, word = rows(sets)
    pairs = [(s, o) for s in sets for o in swaps(s)]
    (da, wa), (db, wb) = rows([a for a, _ in pairs]), rows([b for _, b in pairs])
    weight = 1 / max(1, len(y))
    size, m = len(vocabulary), max(1, len(pairs))

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(doc, w[word], len(y)) + b
        residual = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        change = (np.bincount(da, w[wa], len(pairs)) - np.bincount(db, w[wb], len(pairs))) * (2 * COUNTERFACTUAL / m)
        g = np.bincount(word, residual[doc], size) + 2 * RIDGE * w
        g += np.bincount(wa, change[da], size) - np.bincount(wb, change[db], size)
        return g, float(residual.sum())

    # A bound of the curvature for each weight: a row of n ones adds at most n to each of its places.
    ones = np.bincount(doc, minlength=len(y)) + 1
    changed = np.bincount(da, minlength=m) + np.bincount(db, minlength=m)
    bound = 0.25 * weight * np.bincount(word, ones[doc], size) + 2 * RIDGE
    bound += 2 * COUNTERFACTUAL / m * (np.bincount(wa, changed[da], size) + np.bincount(wb, changed[db], size))
    bound_b = 0.25 * weight * ones.sum()
    w, b, last, momentum = np.zeros(size), 0.0, (np.zeros(size), 0.0), 0.0
    for k in range(STEPS):
        momentum = k / (k + 3)
        at = w + momentum * (w - last[0]), b + momentum * (b - last[1])
        g, gb = gradient(*at)
        last = w, b
        w, b = at[0] - g / bound, at[1] - gb / max(bound_b, RIDGE)
    return Classifier({v: float(x) for v, x in zip(vocabulary, w, strict=True) if abs(x) > 1e-9}, float(b))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    sample = labelled(docs, labels).persist()
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not other:
        share = toxic / max(1, toxic + other)
        return Classifier({}, float(np.log(share / (1 - share))) if 0 < share < 1 else (500.0 if share else -500.0))
    vocabulary = telling_words(sample, toxic, other)
    kept = F.array(*(F.lit(w) for w in sorted({*vocabulary, *TERMS})))
    small = sample.select("doc_id", F.array_intersect("words", kept).alias("words"), "toxic").collect()
    sample.unpersist()
    small.sort(key=lambda r: (r["doc_id"], r["toxic"], r["words"]))
    return fit([(r["words"], r["toxic"]) for r in small], vocabulary)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            scores = [sent.value.score(words_of(r[1])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.bool_()),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    schema = "doc_id long, held_out boolean, score double, predicted int"
    return id_and_bytes(docs, held_out(5).alias("held_out")).mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))
