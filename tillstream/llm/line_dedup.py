"""Line dedup: documents probe sharded minimal perfect hashes instead of joining their lines.

A line's key is the line without spaces at either end and with A-Z lower-cased; keys of at least 10 code points
count. Spark groups the 128-bit hashes of the keys (smallest and largest doc_id, number of holders) and keeps those
of two documents or more. Each shard of them becomes a minimal perfect hash: levels of bit arrays, where a level
places the keys that are alone at their position and the next takes the rest; a key's slot is the number of set
bits before its own. The slot indexes three arrays: fingerprint (64 bits that placed nothing), first document,
count. Tasks map the files from the shared folder, probe a whole chunk of lines shard by shard, and drop a
line if the fingerprint agrees and another document holds it first. No text is shuffled.

A hot line costs one row per task in the shuffle, one slot in a shard. A line repeated inside one document
alone stays. Rows of the same doc_id count as one document; rows without doc_id count as none, and
lose only lines that two other documents hold. Null text has one empty line and stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm import arrays
from tillstream.llm.words import SPACES, by_chunk, id_and_bytes, mix, text_bytes

LEAST_CHARS = 10
CHUNK_BYTES = 3 << 20
SHARD_BYTES = 64 << 20  # of text behind one shard
ROOM = 2  # positions per key on each level
PARTS = {"bits": np.uint64, "ranks": np.int64, "levels": np.int64, "prints": np.uint64, "first": np.int64,
         "counts": np.int64}


def line_key(line: bytes) -> bytes | None:
    key = line.strip(SPACES).lower()
    if len(key) < LEAST_CHARS or len(key) < 4 * LEAST_CHARS and len(key.decode()) < LEAST_CHARS:
        return None
    return key


def digests(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each key, as columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.uint64).reshape(-1, 2)


def position(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """An even place below ``size``, independent from level to level."""
    step = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % (1 << 64))
    value = mix(hashes[:, 0] + step) ^ mix(hashes[:, 1] ^ step)
    return ((value >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The bit arrays of distinct keys, and each key's slot."""
    left, found, words, sizes, before = np.arange(len(hashes)), np.empty(len(hashes), np.int64), [], [], 0
    while len(left):
        size = -(-ROOM * len(left) // 64) * 64
        at = position(hashes[left], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        found[left[alone]] = before + at[alone]
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        sizes.append(size)
        before += size
        left = left[~alone]
    bits = np.concatenate([*words, np.zeros(0, np.uint64)])
    ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
    index = {"bits": bits, "ranks": ranks, "levels": np.array(sizes, np.int64)}
    return index, slots(index, found)


def slots(index: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Set bits before the given one."""
    word = at >> 6
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return index["ranks"][word] + np.bitwise_count(index["bits"][word] & below)


def probe(index: dict[str, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Slot of each key whose fingerprint agrees, -1 for the others."""
    out, left, before = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    for level, size in enumerate(index["levels"].tolist()):
        at = before + position(hashes[left], level, size)
        there = (index["bits"][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        out[left[there]] = slots(index, at[there])
        left, before = left[~there], before + size
    hit = np.flatnonzero(out >= 0)
    out[hit[index["prints"][out[hit]] != hashes[hit, 1]]] = -1
    return out


def build_index(docs: DataFrame, folder: str, shards: int) -> set[int]:
    """Write the shards of all lines that two documents hold; the shards that have any."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            held = [{k for k in map(line_key, (text or b"").split(b"\n")) if k} for _, text in rows]
            ids = [row[0] for row, lines in zip(rows, held, strict=True) for _ in lines]
            both = digests([k for lines in held for k in lines]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64())], ["h1", "h2", "doc_id"]
            )

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        hashes = np.column_stack([table[c].to_numpy().view(np.uint64) for c in ("h1", "h2")])
        index, slot = build(hashes)
        for name, values in (("prints", hashes[:, 1]), ("first", table["first"]), ("counts", table["n"])):
            index[name] = np.empty(len(slot), PARTS[name])
            index[name][slot] = np.asarray(values)
        for name, values in index.items():
            arrays.save(f"{folder}/{shard}.{name}", values)
        return pa.table({"shard": pa.array([shard], pa.int32())})

    # The unsigned high half of h1 decides the shard, as in arrays.shards_of.
    shard = F.shiftrightunsigned(F.shiftrightunsigned("h1", 32) * shards, 32).cast("int")
    found = (
        id_and_bytes(docs).mapInArrow(keys, "h1 long, h2 long, doc_id long")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        .where(F.col("first") < F.col("last"))
        .select("h1", "h2", "first", "n", shard.alias("shard"))
        .groupBy("shard").applyInArrow(write, "shard int")
    )
    return {r["shard"] for r in found.collect()}


class Index:
    def __init__(self, folder: str, shards: int, full: set[int]):
        self.folder, self.shards, self.full = folder, shards, full
        self.open: dict[int, dict[str, np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}

    def first(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First holder and number of holders of each key; 0 holders if it is not in two documents."""
        first, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        shard = arrays.shards_of(hashes[:, 0], self.shards)
        for s in np.unique(shard).tolist():
            if s not in self.full:
                continue
            if s not in self.open:
                self.open[s] = {n: arrays.mapped(f"{self.folder}/{s}.{n}", k) for n, k in PARTS.items()}
            index, here = self.open[s], np.flatnonzero(shard == s)
            slot = probe(index, hashes[here])
            here, slot = here[slot >= 0], slot[slot >= 0]
            first[here], count[here] = index["first"][slot], index["counts"][slot]
        return first, count


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with shortened text, and n_lines, n_dropped (which replace columns of that name)."""
    folder = arrays.shared_folder(docs.sparkSession, "line-index")
    shards = max(1, -(-text_bytes(docs) // SHARD_BYTES))
    index = Index(folder, shards, build_index(docs, folder, shards))

    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    schema = T.StructType([*docs.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    at_text, at_id = names.index("text"), names.index("doc_id")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, int(whole.num_rows * CHUNK_BYTES / max(1, whole.column(at_text).nbytes)))
            for batch in (whole.slice(a, step) for a in range(0, whole.num_rows, step)):
                texts = batch.column(at_text).cast(pa.binary()).to_pylist()
                ids = batch.column(at_id).to_pylist()
                lines = [(text or b"").split(b"\n") for text in texts]
                found = [(d, i, k) for d, ls in enumerate(lines) for i, line in enumerate(ls) if (k := line_key(line))]
                first, count = index.first(digests([k for _, _, k in found]))
                drop: dict[int, set[int]] = {}
                for (d, i, _), f, n in zip(found, first.tolist(), count.tolist(), strict=True):
                    if n and f != ids[d]:
                        drop.setdefault(d, set()).add(i)
                kept = [
                    b"\n".join(line for i, line in enumerate(lines[d]) if i not in drop[d]) if d in drop else text
                    for d, text in enumerate(texts)
                ]
                columns = list(batch.columns)
                columns[at_text] = pa.array([None if t is None else t.decode() for t in kept], pa.string())
                columns += [
                    pa.array([len(ls) for ls in lines], pa.int64()),
                    pa.array([len(drop.get(d, ())) for d in range(len(lines))], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    return docs.mapInArrow(shorten, schema)


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of what is left of each whole text."""
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256")
    )
