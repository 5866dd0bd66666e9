"""Fill-in-the-middle: one repeated-capture match cuts a text into units, two of whose ends become the cuts.

A unit is blanks and the word after them, or the blanks that are left at the end. A single ``fullmatch`` of
``(unit)*`` keeps every repetition, so ``match.ends(1)`` is the list of all unit ends: its length is n, and a cut after
k units is its k-th number. Nothing walks through the text a second time.

What is drawn for a document comes from the sha256 of ``seed:doc_id`` alone, so a repeated task, another
partitioning or a new run gives the same output. Null and empty texts have no unit and stay plain (empty); texts that hold
a tag already stay plain, so that the tags of an output are the tool's own. A row without doc_id draws for ''.
Repeated rows give repeated, equal outputs. Texts are never cut short: memory is that of one chunk of
documents, or of one longer text and the ends of its units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.words import by_chunk, id_and_bytes

PREFIX, SUFFIX, MIDDLE = TAGS = "<P>", "<S>", "<M>"
SEED = 42
FIM_PER_CENT = 50
SPM_PER_CENT = 80  # of the texts that are transformed
CHUNK_BYTES = 2 << 20

# Possessive: a unit never gives back what it took, so no text makes the match try again.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
HAS_TAG = regex.compile("|".join(TAGS))

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2^32."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transform(text: str, drawn: list[int], fim: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, length of prefix and middle, output."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = drawn
    if not text or h3 % 100 >= fim or HAS_TAG.search(text):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim: int = FIM_PER_CENT, spm: int = SPM_PER_CENT) -> DataFrame:
    """doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            made = [transform((text or b"").decode(), draws(seed, i), fim, spm) for i, text in rows]
            n, form, prefix, middle, output = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in rows], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return id_and_bytes(docs).mapInArrow(run, SCHEMA)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text before the transformation, from the output and its form alone."""
    out, kind = F.col(output), F.col(form)

    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        """What lies after the tag that opens the output, after ``second`` and after the last tag."""
        at, last = F.locate(second, out), F.locate(MIDDLE, out)
        tag = len(first)
        return (
            F.substring(out, F.lit(tag + 1), at - tag - 1),
            F.substring(out, at + tag, last - at - tag),
            F.substring(out, last + tag, F.length(out)),
        )

    psm_prefix, psm_suffix, psm_middle = between(PREFIX, SUFFIX)
    spm_suffix, spm_prefix, spm_middle = between(SUFFIX, PREFIX)
    return (
        F.when(kind == "psm", F.concat(psm_prefix, psm_middle, psm_suffix))
        .when(kind == "spm", F.concat(spm_prefix, spm_middle, spm_suffix))
        .otherwise(out)
    )


def op13_fim(docs: DataFrame) -> DataFrame:
    """The transformation of each document with digests of its output and of the text restored from it."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )
