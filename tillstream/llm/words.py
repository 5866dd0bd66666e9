"""Small helpers shared by the operators: words, hashes, document batches, columns."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.arrays import shared_folder

# Python's bytes.split() cuts at exactly these characters, so words are [^\x20\x09-\x0D]+.
SPACES = b" \t\n\x0b\x0c\r"
CACHED_WORDS = 150_000
CHUNK_WORDS = 1_000_000
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()
FACTORS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash of a word; starts anew when it holds CACHED_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application: they need not have it installed.

    Documents go to them in batches of BATCH_ROWS, as the default of 10,000 long texts would fill their memory.
    """
    if int(spark.conf.get(_BATCH_SETTING, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context, package = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(package):
        return
    archive = f"{shared_folder(spark, 'code')}/package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = f"{folder}/{name}"
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def id_and_bytes(docs: DataFrame, *more: Column) -> DataFrame:
    """The two columns most operators read; bytes spare Python the decoding."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more
    )


def held_out(folds: int) -> Column:
    """True where crc32 of the decimal doc_id is a multiple of ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def least_hashes(df: DataFrame, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows, those with the least hash of ``by``; ties by the columns themselves.

    Rows that cannot be among them are left out by a threshold first, so what is sorted does not grow with ``df``.
    """
    n = df.count()
    share = min(1.0, 1.1 * most / max(1, n))
    small = F.pmod(F.xxhash64(*by), F.lit(1 << 40)) <= int(share * (1 << 40))
    return df.where(small).orderBy(F.pmod(F.xxhash64(*by), F.lit(1 << 40)), *by).limit(most)


def by_chunk(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Rows of the batches as tuples, in lists of about ``size`` bytes of text (column 1)."""
    rows, n = [], 0
    for whole in batches:
        # Only a part of a batch is turned into Python objects at a time.
        step = max(1, int(whole.num_rows * size / max(1, whole.column(1).nbytes)))
        for batch in (whole.slice(a, step) for a in range(0, whole.num_rows, step)):
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                rows.append(row)
                n += len(row[1] or b"")
                if n >= size:
                    yield rows
                    rows, n = [], 0
    if rows:
        yield rows
    # A worker waits for its next task: what Arrow no longer needs goes back to the system.
    pa.default_memory_pool().release_unused()


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; sizes the shards."""
    return docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def mix(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the finaliser of splitmix64)."""
    z = keys.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def mix_bits(numbers: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of numbers of so many bits that spreads them evenly; the result's first bits hold it."""
    half, unused = np.uint64((bits + 1) // 2), np.uint64(64 - bits)
    z = numbers.astype(np.uint64, copy=True)
    for factor in FACTORS:
        z ^= z >> half
        z *= np.uint64(factor)
        z = z << unused >> unused
    return (z ^ z >> half) << unused


def unmix_bits(keys: np.ndarray, bits: int) -> np.ndarray:
    """The inverse of mix_bits."""
    half, unused = np.uint64((bits + 1) // 2), np.uint64(64 - bits)
    z = keys.astype(np.uint64) >> unused
    z ^= z >> half
    for factor in reversed(FACTORS):
        z *= np.uint64(pow(factor, -1, 1 << 64))
        z = z << unused >> unused
        z ^= z >> half
    return z


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each of the joined pieces begins, and the end."""
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def sums_by(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each piece, empty pieces included."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[starts[1:]] - total[starts[:-1]]
