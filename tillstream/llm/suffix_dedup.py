"""Suffix-array dedup: bytes covered by a string of LEAST bytes that starts earlier, too, are cut.

* Every string of LEAST bytes has a key, the least hash among its GRAM-byte strings, so equal strings have equal keys
  wherever they stand. Neighbouring strings mostly share it: a piece is a stretch of text whose strings have one key.
* Keys are counted over all documents (sorted hash arrays). Keys that occur once hold nothing that repeats. Where a key
  occurs more than HOT times, its pieces are cut into single strings, keyed and counted by all their bytes: so the many
  texts around one hot passage neither meet in one task nor travel.
* The pieces of repeated keys go to shards by key, equal ones of a chunk once. A shard keeps the first place
  of each distinct piece. A piece that alone has its key, and whose gram occurs once, shares no string with another place
  than its copies. The others are joined to texts of whole keys, the suffixes of each text are sorted by induced sorting, and
  the permuted common prefixes taken. Suffixes in a row that share LEAST bytes are one string; all its places but the first
  are marked.
* Documents read the marks of their pieces from mapped files: a piece at its first place loses what the shard marked,
  its copies lose everything. No document is shuffled or joined.

Order is (doc_id, start); "starts earlier" means a strictly smaller pair. Rows of one doc_id count as one document given
several times. Rows without doc_id come after all others and count as one document among themselves. Null texts are
empty; texts shorter than LEAST bytes stay whole. Keys collide harmlessly; pieces are told apart by 128 bits of hashes.
Long texts are cut into pieces in segments, so memory is that of a chunk, or of one longer text and its cuts.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import arrays
from tillstream.llm.suffix_array import common_prefixes, run_starts, suffix_array
from tillstream.llm.words import by_chunk, id_and_bytes, mix, text_bytes

LEAST = 100
GRAM = 32
PLACES = LEAST - GRAM + 1  # of a gram in a string
MOST_STRINGS = 2 * PLACES  # in a piece
HOT = 2_000
CHUNK_BYTES = 3 << 20
STEP = 1 << 17
MATRIX_ROWS = 10_000
SHARDS = 200  # each chunk looks into all of them: rather larger ones, as far as they fit into a task
SHARD_BYTES, MOST_SHARD_BYTES = 8 << 20, 32 << 20  # of pieces sent to a shard
SORT_BYTES = 2 << 20  # of the texts whose suffixes are sorted
OPEN_SHARDS = 4_000  # a map each
NO_ID = np.iinfo(np.int64).max

PIECES = "shard int, keys binary, prints binary, docs binary, starts binary, sizes binary, again binary, text binary"
PARTS = {"names": np.uint64, "docs": np.int64, "starts": np.int64, "cuts": np.int64, "from": np.int16, "to": np.int16}
FOUND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


# Keys and pieces


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on."""
    return np.lib.stride_tricks.as_strided(text[:8].view("<u8"), (len(text) - 7,), (1,))


def add(hashes: np.ndarray, words: np.ndarray, j: int) -> np.ndarray:
    value = words * np.uint64(0x9E3779B97F4A7C15 * (2 * j + 3) % (1 << 64))
    value ^= value >> np.uint64(31)
    return (hashes + value) * np.uint64(0xD6E8FEB86659FD93)


def least_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the gram at each place, and the least one of the string there: its key, before mixing."""
    n = len(text) - LEAST + 1
    grams, out = np.empty(n + PLACES - 1, np.uint64), np.empty(n, np.uint64)
    words = words_of(text)
    for a in range(0, n, STEP):
        m = min(STEP, n - a) + PLACES - 1
        low = np.zeros(m, np.uint64)
        for j in range(0, GRAM, 8):
            low = add(low, words[a + j:a + j + m], j)
        low ^= low >> np.uint64(32)
        low *= np.uint64(0xD6E8FEB86659FD93)
        grams[a:a + m] = low
        width = 1
        while 2 * width <= PLACES:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < PLACES:
            low = np.minimum(low[: len(low) - PLACES + width], low[PLACES - width:])
        out[a:a + len(low)] = low
    return grams, out


def string_hashes(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of all bytes of the strings at some places."""
    words, out = words_of(text), np.zeros(len(places), np.uint64)
    for j in (*range(0, LEAST - 8, 8), LEAST - 8):
        out = add(out, words[places + j], j)
    return mix(out)


class Segment:
    """Some whole texts, or a part of one longer than a chunk: rows, their offsets, and the bytes they share."""

    def __init__(self, rows: list[int], offsets: list[int], texts: list[bytes]):
        self.raw = b"".join(texts)
        self.text = np.frombuffer(self.raw, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.rows, self.offsets = np.array(rows, np.int64), np.array(offsets, np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.strings = np.maximum(0, sizes - LEAST + 1)

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, place, strings) of each piece; a place is one in the segment's text."""
        self.grams, low = least_hashes(self.text)
        new = np.ones(len(low), bool)
        new[1:] = low[1:] != low[:-1]
        new[self.begins] = True
        place = np.flatnonzero(new)
        at = np.searchsorted(self.begins, place, "right") - 1
        end = self.begins[at] + self.strings[at]
        place, end = place[place < end], end[place < end]
        count = np.minimum(np.append(place[1:], len(low)), end) - place
        # Long runs are cut, so that a repeated character makes equal pieces.
        parts = -(-count // MOST_STRINGS)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        count = np.minimum(np.repeat(count, parts) - k * MOST_STRINGS, MOST_STRINGS)
        place = np.repeat(place, parts) + k * MOST_STRINGS
        return mix(low[place]), place, count

    def again(self, place: np.ndarray, count: np.ndarray) -> np.ndarray:
        """True for pieces in which their gram occurs again: these may repeat themselves."""
        again, inside = np.zeros(len(place), bool), np.arange(PLACES)
        for a in range(0, len(place), MATRIX_ROWS):
            one = slice(a, a + MATRIX_ROWS)
            last = place[one] + count[one] - 1
            first, last = self.grams[place[one, None] + inside], self.grams[last[:, None] + inside[::-1]]
            # The gram's first place in the first string, and its last one in the last string.
            left = place[one] + first.argmin(axis=1)
            right = place[one] + count[one] - 1 + PLACES - 1 - last.argmin(axis=1)
            again[one] = left != right
        return again

    def keys(self) -> np.ndarray:
        """The key of each piece, twice where the piece may repeat itself."""
        keys, place, count = self.pieces()
        return np.concatenate((keys, keys[self.again(place, count)]))

    def where(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and place in its text."""
        at = np.searchsorted(self.begins, places, "right") - 1
        return self.rows[at], places - self.begins[at] + self.offsets[at]


def segments(rows: list[tuple]) -> Iterator[Segment]:
    """A text's pieces depend on the text alone: long texts are cut at multiples of CHUNK_BYTES."""
    short = [k for k, r in enumerate(rows) if LEAST <= len(r[1] or b"") <= CHUNK_BYTES]
    if short:
        yield Segment(short, [0] * len(short), [rows[k][1] for k in short])
    for k, (_, text) in enumerate(rows):
        if len(text or b"") > CHUNK_BYTES:
            for at in range(0, len(text) - LEAST + 1, CHUNK_BYTES):
                yield Segment([k], [at], [text[at:at + CHUNK_BYTES + LEAST - 1]])


class Repeated:
    """Which keys repeat, and which are hot; picks the pieces that need a look."""

    def __init__(self, keys: arrays.HashArrays, strings: arrays.HashArrays | None, hot: int):
        self.keys, self.strings, self.hot = keys, strings, hot

    def hot_strings(self, segment: Segment) -> np.ndarray:
        keys, places, count = segment.pieces()
        hot = counts_of(self.keys, keys) > self.hot
        return spread(places[hot], count[hot])

    def pieces(self, segment: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, places, count = segment.pieces()
        seen = counts_of(self.keys, keys)
        cold = (seen > 1) & (seen <= self.hot)
        found = [(keys[cold], places[cold], count[cold])]
        if self.strings is not None:
            hot = seen > self.hot
            single = spread(places[hot], count[hot])
            hashes = string_hashes(segment.text, single)
            again = counts_of(self.strings, hashes) > 1
            found.append((hashes[again], single[again], np.ones(again.sum(), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def counts_of(index: arrays.HashArrays, keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = index.find(keys[order])[1]
    return out


def spread(places: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The place of each string of some pieces."""
    return np.repeat(places - np.cumsum(count) + count, count) + np.arange(count.sum())


def prints_of(raw: bytes, places: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = places + count + LEAST - 1
    hashed = (xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(places.tolist(), ends.tolist(), strict=True))
    return np.fromiter(hashed, np.uint64, len(places))


def name_of(keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """One number for a piece within its shard."""
    return keys ^ mix(prints)


def ids_of(rows: list[tuple]) -> np.ndarray:
    return np.array([NO_ID if r[0] is None else r[0] for r in rows], np.int64)


# Counting keys


def counted(docs: DataFrame, keys_of, shards: int, folder: str, hot: int) -> tuple[arrays.HashArrays, int, int]:
    """Keys found twice or more; how often these occur altogether, and how often the hot ones do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            for segment in segments(rows):
                keys = keys_of(segment)
                if len(keys):
                    yield from arrays.blocks(keys, shards)

    def seen(keys: np.ndarray, counts: np.ndarray) -> list[int]:
        return [int(counts[counts > 1].sum()), int(counts[counts > hot].sum())]

    rows = arrays.write_arrays(docs.mapInArrow(run, arrays.BLOCKS), folder, 2, seen, ["again", "hot"])
    index = arrays.HashArrays(folder, arrays.sizes_of(rows), shards)
    return index, arrays.total(rows, "again"), arrays.total(rows, "hot")


def repeated_keys(docs: DataFrame, hot: int) -> tuple[Repeated, int]:
    """What repeats, and a bound of the bytes of the pieces that shards will be sent."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    keys, again, hot_pieces = counted(
        docs, lambda segment: segment.keys(), arrays.shard_count(size // (PLACES // 2)),
        arrays.shared_folder(spark, "keys"), hot,
    )
    bound = (again - hot_pieces) * (PLACES // 2 + LEAST)
    if not hot_pieces:
        return Repeated(keys, None, hot), bound
    # No key is too hot here: equal strings are one piece, and others do not meet.
    asked = Repeated(keys, None, hot)
    strings, again, _ = counted(
        docs, lambda segment: string_hashes(segment.text, asked.hot_strings(segment)),
        arrays.shard_count(hot_pieces * PLACES // 2), arrays.shared_folder(spark, "strings"), hot,
    )
    return Repeated(keys, strings, hot), bound + min(again, hot_pieces * PLACES) * LEAST // 8


# Shards


def sent(rows: list[tuple], segment: Segment, repeated: Repeated, shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct pieces of a segment, a row per shard, each at its first place."""
    keys, places, count = repeated.pieces(segment)
    if not len(keys):
        return
    prints = prints_of(segment.raw, places, count)
    row, start = segment.where(places)
    docs = ids_of(rows)[row]
    order = np.lexsort((start, docs, prints, keys))
    same = np.zeros(len(order), bool)
    a, b = order[1:], order[:-1]
    same[1:] = (keys[a] == keys[b]) & (prints[a] == prints[b])
    kept = order[~same]
    keys, prints, docs, start, places, count = (x[kept] for x in (keys, prints, docs, start, places, count))
    again, sizes = segment.again(places, count), count + LEAST - 1
    shard = arrays.shards_of(keys, shards)
    cuts = np.append(run_starts(shard)[0], len(shard))
    ends = (places + sizes).tolist()
    texts = [segment.raw[a:b] for a, b in zip(places.tolist(), ends, strict=True)]
    columns = {name: [] for name in ("shard", "keys", "prints", "docs", "starts", "sizes", "again", "text")}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        columns["shard"].append(int(shard[a]))
        for name, values in (("keys", keys), ("prints", prints), ("docs", docs), ("starts", start), ("again", again)):
            columns[name].append(values[a:b].tobytes())
        columns["sizes"].append(sizes[a:b].astype(np.int32).tobytes())
        columns["text"].append(b"".join(texts[a:b]))
    kinds = [pa.int32(), *[pa.binary()] * 7]
    yield pa.RecordBatch.from_arrays(
        [pa.array(v, kind) for v, kind in zip(columns.values(), kinds, strict=True)], list(columns)
    )


def marked(text: np.ndarray, sizes: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, string in it) of all strings of some distinct pieces that an earlier place holds, in this order."""
    # A zero ends each piece, so that no suffix reads on into the next one.
    begins = np.cumsum(sizes + 1) - sizes - 1
    piece = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(len(piece)) - begins[piece]
    joined = np.zeros(len(piece), np.uint16)
    joined[offset < sizes[piece]] = text
    joined[offset < sizes[piece]] += 1
    whole = offset <= (sizes - LEAST)[piece]
    suffixes = suffix_array(joined, 257)
    common = common_prefixes(joined, suffixes, whole, LEAST)
    # Suffixes in a row that share LEAST bytes are one string; those before them have fewer in common.
    strings = suffixes[whole[suffixes]]
    group = np.cumsum(common[strings] < LEAST)
    sizes_of = np.bincount(group, minlength=1)
    strings, group = strings[sizes_of[group] > 1], group[sizes_of[group] > 1]
    doc, start = docs[piece[strings]], starts[piece[strings]] + offset[strings]
    order = np.lexsort((start, doc, group))
    strings, group, doc, start = strings[order], group[order], doc[order], start[order]
    if len(group):
        first, length = run_starts(group)
        first = np.repeat(first, length)
        strings = strings[(doc != doc[first]) | (start != start[first])]
    strings = np.sort(strings)
    return piece[strings], offset[strings]


def marked_in_parts(
    keys: np.ndarray, again: np.ndarray, docs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begins: np.ndarray,
    text: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """What ``marked`` finds in distinct pieces in the order of their keys, sorted some whole keys at a time."""
    length = run_starts(keys)[1]
    asked = np.flatnonzero(again | np.repeat(length > 1, length))
    found = [(np.zeros(0, np.int64),) * 2]
    if len(asked):
        first, length = run_starts(keys[asked])
        before = np.cumsum(sizes[asked]) - sizes[asked]
        cuts = run_starts(np.repeat(before[first] // SORT_BYTES, length))[0]
        for part in np.split(asked, cuts[1:]):
            joined = text[spread(begins[part], sizes[part])]
            piece, string = marked(joined, sizes[part], docs[part], starts[part])
            found.append((part[piece], string))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def build(table: pa.Table, folder: str) -> int:
    """Write what documents ask about the pieces of a shard: first place and marked strings of each."""
    shard = table["shard"][0].as_py()

    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])

    keys, prints = column("keys", np.uint64), column("prints", np.uint64)
    docs, starts, sizes = column("docs", np.int64), column("starts", np.int64), column("sizes", np.int32)
    begins = np.cumsum(sizes, dtype=np.int64) - sizes
    order = np.lexsort((starts, docs, prints, keys))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (prints[order[1:]] != prints[order[:-1]])
    kept = order[new]
    keys, prints, docs, starts, begins = keys[kept], prints[kept], docs[kept], starts[kept], begins[kept]
    sizes, again = sizes[kept].astype(np.int64), column("again", bool)[kept]
    piece, string = marked_in_parts(keys, again, docs, starts, sizes, begins, column("text", np.uint8))
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (string[1:] != string[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(piece))[: len(first)] - 1
    # Pieces are looked up by their names.
    names = name_of(keys, prints)
    order = np.argsort(names)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    owner = place[piece[first]]
    runs = np.argsort(owner, kind="stable")
    found = {
        "names": names[order], "docs": docs[order], "starts": starts[order],
        "cuts": np.searchsorted(owner[runs], np.arange(len(order) + 1)),
        "from": string[first[runs]], "to": string[last[runs]],
    }
    parts = [np.array([len(order), len(runs)]), *(found[part].astype(kind) for part, kind in PARTS.items())]
    arrays.save(f"{folder}/{shard}", np.concatenate([x.view(np.uint8) for x in parts]))
    return len(order)


class Marks:
    """First places and marked strings, mapped from the shards' files; at most OPEN_SHARDS shards are open."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self.open: OrderedDict[int, dict[str, np.ndarray]] = OrderedDict()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": OrderedDict()}

    def shard(self, s: int) -> dict[str, np.ndarray]:
        if s not in self.open:
            if len(self.open) >= OPEN_SHARDS:
                self.open.popitem(last=False)
            raw = np.asarray(arrays.mapped(f"{self.folder}/{s}", np.uint8))
            n, runs = raw[:16].view(np.int64).tolist()
            ends = 16 + np.cumsum([8 * n, 8 * n, 8 * n, 8 * (n + 1), 2 * runs, 2 * runs])
            self.open[s] = {
                part: raw[a:b].view(kind)
                for (part, kind), a, b in zip(PARTS.items(), [16, *ends[:-1]], ends, strict=True)
            }
        self.open.move_to_end(s)
        return self.open[s]

    def removed(
        self, keys: np.ndarray, prints: np.ndarray, docs: np.ndarray, starts: np.ndarray, count: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, first byte, end) of what each piece loses; bytes count from the piece's start."""
        names = name_of(keys, prints)
        shard = arrays.shards_of(keys, self.shards)
        order = np.lexsort((names, shard))
        copy = np.zeros(len(order), bool)
        found = []
        first, length = run_starts(shard[order]) if len(order) else ((), ())
        for a, n in zip(first, length, strict=True):
            asked = order[a:a + n]
            there = self.shard(int(shard[asked[0]]))
            at = np.searchsorted(there["names"], names[asked])
            copy[asked] = (there["docs"][at] != docs[asked]) | (there["starts"][at] != starts[asked])
            begin, end = there["cuts"][at], there["cuts"][at + 1]
            some = (begin < end) & ~copy[asked]
            if some.any():
                asked, begin, end = asked[some], begin[some], end[some]
                runs = spread(begin, end - begin)
                found.append((np.repeat(asked, end - begin), there["from"][runs].astype(np.int64),
                              there["to"][runs].astype(np.int64) + LEAST))
        copies = np.flatnonzero(copy)
        found.append((copies, np.zeros(len(copies), np.int64), count[copies] - 1 + LEAST))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def cut_rows(rows: list[tuple], repeated: Repeated, marks: Marks) -> pa.RecordBatch:
    """The documents of a chunk without what they lose."""
    ids = ids_of(rows)
    sizes = np.array([len(r[1] or b"") for r in rows], np.int64)
    # One byte of room after each text keeps the last run of one from meeting the first of the next.
    base = np.cumsum(sizes + 1) - sizes - 1
    lost = [(np.zeros(0, np.int64),) * 2]
    for segment in segments(rows):
        keys, places, count = repeated.pieces(segment)
        row, start = segment.where(places)
        piece, first, end = marks.removed(keys, prints_of(segment.raw, places, count), ids[row], start, count)
        begin = (base[row] + start)[piece]
        lost.append((begin + first, begin + end))
    begin, end = (np.concatenate(x) for x in zip(*lost, strict=True))
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    first = np.flatnonzero(new)
    begin, end = begin[first], reach[np.append(first[1:], len(reach))[: len(first)] - 1]
    row = np.searchsorted(base, begin, "right") - 1
    spans = np.bincount(row, minlength=len(rows))
    removed = np.bincount(row, end - begin, len(rows)).astype(np.int64)
    cuts = np.concatenate(([0], np.cumsum(spans)))
    begin, end = (begin - base[row]).tolist(), (end - base[row]).tolist()
    kept = []
    for k, (_, text) in enumerate(rows):
        a, b = cuts[k], cuts[k + 1]
        text = text or b""
        if a < b:
            text = b"".join(text[x:y] for x, y in zip([0, *end[a:b]], [*begin[a:b], len(text)], strict=True))
        kept.append(text)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()), pa.array(sizes), pa.array(removed),
            pa.array(spans.astype(np.int64)), pa.array(kept, pa.binary()),
        ],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )


def shards_for(size: int) -> int:
    """Shards for so many bytes of pieces."""
    return max(1, -(-size // min(MOST_SHARD_BYTES, max(SHARD_BYTES, size // SHARDS))))


def dedup_substrings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: a cut may split a character) of each document."""
    spark, docs = docs.sparkSession, id_and_bytes(docs)
    repeated, bound = repeated_keys(docs, hot)
    shards = shards_for(bound)
    folder = arrays.shared_folder(spark, "suffixes")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            for segment in segments(rows):
                yield from sent(rows, segment, repeated, shards)

    def write(table: pa.Table) -> pa.Table:
        return pa.table({"n": pa.array([build(table, folder)], pa.int64())})

    docs.mapInArrow(send, PIECES).groupBy("shard").applyInArrow(write, "n long").agg(F.sum("n")).collect()
    marks = Marks(folder, shards)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            yield cut_rows(rows, repeated, marks)

    return docs.mapInArrow(cut, FOUND)


def op12_suffix_dedup(docs: DataFrame) -> DataFrame:
    """What each document loses, and the digest of the rest."""
    found = dedup_substrings(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
