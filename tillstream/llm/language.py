"""Language ID: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, runs of anything else become one space, and the one- to three-letter grams of every whole text
are hashed to 2^16 features. Spark counts features per language over all labelled documents of the training folds;
the log-probability matrix (languages x features, its size checked) is broadcast, and tasks score chunks of
documents by one gather from it per gram length and one sum per document.

Null texts and texts without a letter are ``und`` with score 0; so is everything if no labelled document has a letter.
The score is the posterior probability of the predicted language; of equal ones the first in order of name. Texts
are read in slices of 2^18 characters, in training and scoring alike; grams across a cut do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.words import by_chunk, held_out, id_and_bytes, starts_of

BITS = 16
FEATURES = 1 << BITS
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
SLICE = 1 << 18
CHUNK_BYTES = 1 << 20
MOST_MATRIX_BYTES = 64 << 20
UNKNOWN = "und"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, a space around each text, and where each begins."""
    low = [f" {t.lower()} ".encode("utf-32-le", "replace") for t in texts]
    codes = np.frombuffer(b"".join(low), np.uint32)
    starts = starts_of(np.array([len(t) // 4 for t in low], np.int64))
    codes = np.where(letters()[codes], codes, np.uint32(32))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[starts[:-1]] = True
    return codes[keep], np.concatenate(([0], np.cumsum(keep)))[starts]


def features(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Feature of the gram that begins at each place; FEATURES where it would leave its text."""
    value = np.full(len(codes), size, np.uint64)
    for k in range(size):
        value[:len(codes) - k] = (value[:len(codes) - k] + codes[k:]) * FACTOR
    out = (value >> np.uint64(64 - BITS)).astype(np.int32)
    for k in range(1, size):
        out[np.maximum(starts[1:] - k, starts[:-1])] = FEATURES
    return out


def slices(rows: list[tuple]) -> tuple[list[int], list[str]]:
    """Texts cut into slices, and the row of each slice."""
    owner, parts = [], []
    for k, row in enumerate(rows):
        text = (row[1] or b"").decode()
        for a in range(0, max(1, len(text)), SLICE):
            owner.append(k)
            parts.append(text[a:a + SLICE])
    return owner, parts


def count_features(docs: DataFrame) -> DataFrame:
    """(lang, feature, n) over documents with text and lang."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for rows in by_chunk(batches, CHUNK_BYTES):
            owner, parts = slices(rows)
            codes, starts = code_points(parts)
            langs = sorted({r[2] for r in rows})
            lang = np.array([langs.index(rows[k][2]) for k in owner])
            lang = np.repeat(lang, np.diff(starts))
            total = sum(
                np.bincount(lang * (FEATURES + 1) + features(codes, starts, n), minlength=len(langs) * (FEATURES + 1))
                for n in GRAMS
            ).reshape(len(langs), FEATURES + 1)
            for name, row in zip(langs, total, strict=True):
                counts[name] = counts.get(name, 0) + row[:FEATURES]
        for name, row in counts.items():
            some = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some)), pa.array(some, pa.int32()), pa.array(row[some], pa.int64())],
                ["lang", "feature", "n"],
            )

    found = id_and_bytes(docs, F.col("lang").cast("string")).mapInArrow(count, "lang string, feature int, n long")
    return found.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log-probabilities, with a row of zeros for no feature."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    priors = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(priors)
    if 4 * len(langs) * (FEATURES + 1) > MOST_MATRIX_BYTES:
        raise ValueError(f"{len(langs)} languages exceed the matrix of {MOST_MATRIX_BYTES} bytes; lower BITS")
    counts = np.zeros((FEATURES, len(langs)))
    number = {name: k for k, name in enumerate(langs)}
    found = count_features(usable).toPandas()  # at most languages x features rows
    counts[found["feature"], found["lang"].map(number).astype(int)] = found["n"]
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * FEATURES))
    return langs, np.vstack([logs, np.zeros(len(langs))]).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            owner, parts = slices(rows)
            codes, starts = code_points(parts)
            lettered = np.zeros(len(rows), bool)
            np.logical_or.at(lettered, owner, np.logical_or.reduceat(codes != 32, starts[:-1]))
            sums = np.zeros((len(rows), max(1, len(langs))))
            for n in GRAMS if langs else ():
                values = sent.value[features(codes, starts, n)]
                np.add.at(sums, owner, np.add.reduceat(values, starts[:-1], axis=0, dtype=np.float64))
            best = sums.argmax(axis=1)
            chance = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            known = lettered & bool(langs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.bool_()),
                    pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                    pa.array(np.where(known, chance, 0.0)),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return id_and_bytes(docs, held_out(5).alias("held_out")).mapInArrow(run, schema)


def op3_language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, *train(docs.where(~held_out(5))))
