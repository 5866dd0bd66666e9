"""Sorted hash arrays in the shared folder.

Tasks count 64-bit keys chunk by chunk and send each shard one block of sorted keys and counts; one task per
shard adds the blocks up and writes a pair of array files, which later tasks map into memory. A shard is a range
of keys, so a key's place in all shards together is a dense number. Files are written under another name and
renamed, so a repeated task leaves the same files. Workers map files, so the shared folder must be mounted on all
executors (a ``file:`` path).

Keys of which only the first bits are used (``bits``) are sent and stored in fewer bytes: blocks hold the differences
of ascending keys, files the last 32 of the used bits next to where each value of the bits above begins.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillstream.session import scratch_folder

BLOCKS = "shard int, keys binary, counts binary"
SHARD_KEYS = 1_500_000
OPEN_SHARDS = 1_000  # per reader: the system allows a process some 65,000 maps
LAST = np.uint64(32)  # bits of a key in a file of narrow keys
LARGE = 255  # counts from here on lie apart
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir as a path that workers can open."""
    folder = scratch_folder(spark, name)
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"mapped arrays need spark.checkpoint.dir on a mounted path, not {folder}")
    os.makedirs(path, exist_ok=True)
    return path


def save(path: str, array: np.ndarray) -> None:
    """Write a file that appears whole or not at all; a repeated task replaces it by the same bytes."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(np.ascontiguousarray(array).tobytes())
    os.replace(own, path)


def mapped(path: str, kind: type) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries in this block go when the query ends: for tables read from what it has written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def save_small(path: str, values: np.ndarray) -> None:
    """Mostly small numbers: a byte each, the large ones apart."""
    large = np.flatnonzero(values >= LARGE)
    low = np.zeros(-(-len(values) // 8) * 8, np.uint8)
    low[: len(values)] = np.minimum(values, LARGE)
    save(path, np.concatenate([np.array([len(values)]), low.view(np.int64), large, values[large].astype(np.int64)]))


class Small:
    """The numbers of save_small, mapped."""

    def __init__(self, path: str):
        raw = np.asarray(mapped(path, np.uint8))
        n = int(raw[:8].view(np.int64)[0])
        self.low = raw[8:8 + n]
        self.places, self.values = raw[8 + -(-n // 8) * 8:].view(np.int64).reshape(2, -1)

    def __getitem__(self, at: np.ndarray | slice) -> np.ndarray:
        out = self.low[at].astype(np.int64)
        large = np.flatnonzero(out == LARGE)
        if len(large):
            places = large if isinstance(at, slice) else at[large]
            out[large] = self.values[np.searchsorted(self.places, places)]
        return out


def narrow(counts: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def shard_count(keys: int) -> int:
    return max(1, -(-keys // SHARD_KEYS))


def shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def blocks(keys: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct keys of a chunk with their counts, a row per shard."""
    distinct, counts = np.unique(keys, return_counts=True)
    yield from weighted_blocks(distinct, counts.astype(np.uint32), shards)


def weighted_blocks(distinct: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    shard = shards_of(distinct, shards)
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(full):
        planes = [
            (packed(distinct[a:b]), packed_counts(counts[a:b]))
            for a, b in zip(cuts[full], cuts[full + 1], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()),
                pa.array([p[0] for p in planes], pa.binary()),
                pa.array([p[1] for p in planes], pa.binary()),
            ],
            ["shard", "keys", "counts"],
        )


def packed(ascending: np.ndarray) -> bytes:
    """Distinct ascending numbers: the first one, and the differences without common last bits, byte by byte.

    Of the bytes that are left the last ones of a difference are random, and the first ones compress well.
    """
    common = int(np.bitwise_or.reduce(ascending))
    shift = (common & -common).bit_length() - 1 if common else 0
    steps = np.diff(ascending, prepend=ascending[:1]) >> np.uint64(shift)
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    planes = steps.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes((shift, width)) + ascending[:1].tobytes() + planes.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=10).reshape(data[1], -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : data[1]] = planes.T
    steps = steps.view(np.uint64).reshape(-1) << np.uint64(data[0])
    steps[0] = np.frombuffer(data, np.uint64, 1, offset=2)[0]
    return np.cumsum(steps, dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Byte by byte: the last bytes of small counts compress well."""
    counts = narrow(counts)
    planes = np.ascontiguousarray(counts).view(np.uint8).reshape(len(counts), -1).T
    return bytes((len(planes),)) + planes.tobytes()


def unpacked_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"u{data[0]}").astype(np.int64)


def added_up(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and total counts of one shard's blocks."""
    keys = np.concatenate([unpacked(x) for x in table["keys"].to_pylist()])
    counts = np.concatenate([unpacked_counts(x) for x in table["counts"].to_pylist()])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def stored_bits(bits: int, shards: int) -> int:
    """``bits``, or 64 if the list of the values above the last 32 bits would be long next to the keys."""
    return bits if (1 << max(0, bits - int(LAST))) // shards <= SHARD_KEYS // 8 else 64


def save_keys(path: str, keys: np.ndarray, bits: int) -> None:
    if bits == 64:
        return save(path, keys)
    keys = keys >> np.uint64(64 - bits)
    top = (keys >> LAST).astype(np.int64)
    first = int(top[0]) if len(top) else 0
    starts = np.searchsorted(top, np.arange(first, int(top[-1]) + 2)) if len(top) else np.zeros(1, np.int64)
    save(f"{path}.tops", np.concatenate([np.array([first]), starts]))
    save(path, keys.astype(np.uint32))


class Shard:
    """Mapped keys and counts of one shard."""

    def __init__(self, path: str, bits: int):
        self.bits, self.counts = bits, Small(f"{path}.counts")
        self.keys = np.asarray(mapped(f"{path}.keys", np.uint64 if bits == 64 else np.uint32))
        if bits < 64:
            tops = np.fromfile(f"{path}.keys.tops", np.int64)
            self.top, self.starts = int(tops[0]), tops[1:]

    def keys_at(self, at: np.ndarray) -> np.ndarray:
        if self.bits == 64:
            return self.keys[at]
        top = np.searchsorted(self.starts, at, "right") - 1 + self.top
        return (top.astype(np.uint64) << LAST | self.keys[at].astype(np.uint64)) << np.uint64(64 - self.bits)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return self.keys_at(np.arange(len(self.keys))), self.counts[:]

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Where each of some ascending keys lies, -1 if it does not."""
        if self.bits == 64:
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            return np.where(self.keys[at] == asked, at, -1)
        asked = asked >> np.uint64(64 - self.bits)
        top = (asked >> LAST).astype(np.int64) - self.top
        here = np.flatnonzero((top >= 0) & (top < len(self.starts) - 1))
        top, low = top[here], asked[here].astype(np.uint32)
        at, end = self.starts[top], self.starts[top + 1]
        cuts = np.flatnonzero(np.diff(top, prepend=-1))
        if len(cuts) * 50 < len(top):
            for a, b in zip(cuts, [*cuts[1:], len(top)], strict=True):
                at[a:b] += np.searchsorted(self.keys[at[a]:end[a]], low[a:b])
        else:  # few keys for each value of the bits above: all are halved together
            last = end.copy()
            for _ in range(int((end - at).max(initial=0)).bit_length()):
                middle = (at + last) >> 1
                less = (at < last) & (self.keys[np.minimum(middle, len(self.keys) - 1)] < low)
                at, last = np.where(less, middle + 1, at), np.where(less, last, middle)
        out = np.full(len(asked), -1, np.int64)
        hit = (at < end) & (self.keys[np.minimum(at, len(self.keys) - 1)] == low)
        out[here[hit]] = at[hit]
        return out


def write_arrays(
    rows: DataFrame, folder: str, least: int, seen: Callable[[np.ndarray, np.ndarray], list[int]], columns: list[str],
    bits: int = 64,
) -> list:
    """One pair of files per shard with the keys counted ``least`` times or more.

    Returns a row (shard, n, and what ``seen`` makes of the counted keys) per shard: the driver gets a few
    numbers for each shard, whatever the number of keys.
    """

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, counts = added_up(table)
        facts = seen(keys, counts)
        keep = counts >= least
        save_keys(f"{folder}/{shard}.keys", keys[keep], bits)
        save_small(f"{folder}/{shard}.counts", counts[keep])
        row = [shard, int(keep.sum()), *facts]
        return pa.table({n: pa.array([v], pa.int64()) for n, v in zip(["shard", "n", *columns], row, strict=True)})

    schema = ", ".join(f"{c} long" for c in ["shard", "n", *columns])
    with shuffles_dropped(rows.sparkSession):
        return rows.groupBy("shard").applyInArrow(write, schema).collect()


class HashArrays:
    """Sorted keys and their counts, mapped from the files of write_arrays when first needed."""

    def __init__(self, folder: str, sizes: dict[int, int], shards: int, bits: int = 64):
        self.folder, self.shards, self.bits = folder, shards, bits
        self.sizes = np.array([sizes.get(s, 0) for s in range(shards)], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.open: dict[int, Shard] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}

    def __len__(self) -> int:
        return int(self.starts[-1])

    def shard(self, s: int) -> Shard:
        if s not in self.open:
            if len(self.open) >= OPEN_SHARDS:
                self.open.pop(next(iter(self.open)))
            self.open[s] = Shard(f"{self.folder}/{s}", self.bits)
        return self.open[s]

    def keys_at(self, places: np.ndarray) -> np.ndarray:
        """The keys at some ascending places."""
        out = np.zeros(len(places), np.uint64)
        cuts = np.searchsorted(places, self.starts)
        for s in np.flatnonzero(cuts[1:] > cuts[:-1]):
            out[cuts[s]:cuts[s + 1]] = self.shard(s).keys_at(places[cuts[s]:cuts[s + 1]] - self.starts[s])
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1 if absent) and count (0 if absent) of each of some ascending keys."""
        place, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        if not len(keys):
            return place, count
        cuts = np.searchsorted(shards_of(keys, self.shards), np.arange(self.shards + 1))
        for s in np.flatnonzero((cuts[1:] > cuts[:-1]) & (self.sizes > 0)):
            shard = self.shard(s)
            at = shard.find(keys[cuts[s]:cuts[s + 1]])
            hit = np.flatnonzero(at >= 0)
            place[cuts[s] + hit] = at[hit] + self.starts[s]
            count[cuts[s] + hit] = shard.counts[at[hit]]
        return place, count


def sizes_of(rows: list) -> dict[int, int]:
    return {r["shard"]: r["n"] for r in rows}


def total(rows: list, column: str) -> int:
    return sum(r[column] for r in rows)
