"""Benchmark decontamination by templates: numbers, units and names become typed placeholders.

A word loses its case and the punctuation around it; then a number is <num>, a unit after a number <unit>, a
capitalised word <name>; one that opens a sentence may be a name or not and is read both ways. Each window of five such tokens is hashed; one with fewer than three literal
tokens is hashed by its words instead, so arithmetic, conversions and lists of names are found as they stand. Of an item
that has three literals but no such window the least wider windows are hashed too.
The windows of a block of benchmark items go to all tasks, which look up the windows of every document there. Equal
windows tell where an item may begin in the document, and all its windows are compared there. One with few literals
fits if its words are the item's own, or if the wider span around it that has three literals fits.
At each such place the fitting windows vote for one document value per item value and kind; only windows that agree with
the vote count, so a template filled at random does not match, a question with other numbers throughout does, and
copies with different values do not disturb each other. A document is contaminated by an item when the agreeing windows
at one place, or at all places under a common vote, are at least half of the item's, or when agreeing windows in a row at
one place cover RUN_WORDS words, however long the item is. Slots are values in windows with three literals.

Benchmarks are read in blocks of BLOCK_WORDS words, one pass over the documents for each, so what is broadcast is
bounded. Items with fewer than five words make one window of all their tokens. Null or empty items and texts match
nothing. Repeated documents and items are reported each; output has one row per document and item.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.arrays import shared_folder
from tillstream.llm.components import written
from tillstream.llm.words import by_chunk, id_and_bytes, mix, read_documents, starts_of

WINDOW = 5
LITERALS = 3
SHARE = 50  # per cent of an item's windows
RUN_WORDS = 13  # words in a row, whatever the item's length
BLOCK_WORDS = 1_000_000
CHUNK_BYTES = 3 << 20
FILTER_BITS = 22
KNOWN_WORDS = 250_000
FACTOR = np.uint64(pow(0x9E3779B97F4A7C15, 5, 1 << 64))

# What counts as a unit after a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes oz ounce ounces lb lbs pound "
    "pounds ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros percent % degree degrees mph kph watt watts volt "
    "volts joule joules newton newtons meter meters metre metres kilometer kilometers gram grams kilogram kilograms "
    "stunde stunden tag tage woche wochen jahr jahre meter heure heures jour jours hora horas dia dias".split()
)
NUMBER = regex.compile(r"[-+$€£]?\d[\d.,:/]*(%|[a-z]{1,3})?")
MARKS = ".,;:!?\"'()[]{}*#&|<>"
EDGES = regex.compile(r"^[^\p{L}\p{N}$€£+\-]+|[^\p{L}\p{N}%]+$")
NUM, UNIT, CAPITAL, STOP = 1, 2, 4, 8
PLACEHOLDERS = {NUM: b"<num>", UNIT: b"<unit>", CAPITAL: b"<name>"}
HOLDER = np.zeros(5, np.uint64)
for _kind, _name in PLACEHOLDERS.items():
    HOLDER[_kind] = xxhash.xxh3_64_intdigest(_name)


class Vocabulary(dict):
    """Number of each word form seen, with its hash and flags; a chunk begins anew after KNOWN_WORDS words."""

    def __init__(self):
        super().__init__()
        self.hashes, self.flags = np.zeros(KNOWN_WORDS, np.uint64), np.zeros(KNOWN_WORDS, np.uint8)

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        if k == len(self.flags):
            self.hashes = np.concatenate([self.hashes, np.zeros(k, np.uint64)])
            self.flags = np.concatenate([self.flags, np.zeros(k, np.uint8)])
        self.hashes[k], self.flags[k] = describe(word)
        return k

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def bare(word: bytes) -> str:
    text = word.decode().strip(MARKS)
    return text if text.isalpha() else EDGES.sub("", text)


def describe(word: bytes) -> tuple[int, int]:
    core = bare(word)
    low = core.lower()
    flags = UNIT if low in UNITS else 0 if low.isalpha() else NUM if NUMBER.fullmatch(low) else 0
    if not flags & NUM and len(core) > 1 and core[0].isupper() and core[1:].islower():
        flags |= CAPITAL
    if word.rstrip(b"\"')]").endswith((b".", b"!", b"?", b":")):
        flags |= STOP
    return xxhash.xxh3_64_intdigest(low.encode()), flags


def templates(words: list[list[bytes]], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the bare word and placeholder kind (0: literal) of every token of the texts, whether it may be a name or a
    literal word, and where each text begins."""
    starts = starts_of(np.array([len(w) for w in words], np.int64))
    number = vocabulary.numbers([w for ws in words for w in ws])
    plain, flags = vocabulary.hashes[number], vocabulary.flags[number]
    before = np.concatenate((np.zeros(1, np.uint8), flags[:-1])) if len(flags) else flags
    before = before.copy()
    before[starts[:-1][starts[:-1] < len(flags)]] = STOP
    kind = np.where(flags & NUM, NUM, 0)
    kind = np.where((flags & UNIT > 0) & (before & NUM > 0), UNIT, kind)
    kind = np.where((kind == 0) & (flags & CAPITAL > 0), CAPITAL, kind)
    return plain, kind, (kind == CAPITAL) & (before & STOP > 0), starts


def rolled(tokens: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = out * FACTOR + tokens[at + k]
    return mix(out)


def windows(plain: np.ndarray, kind: np.ndarray, opens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all windows: of the template, or of the words themselves where few tokens are literal. A
    window with words that open sentences has a second hash, with these words as literal ones."""
    n = max(0, len(plain) - size + 1)
    tokens, literal = np.where(kind > 0, HOLDER[kind], plain), literals(kind, size)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * FACTOR + tokens[k:k + n]
    out = mix(out)
    few = np.flatnonzero(literal < min(size, LITERALS))
    out[few] = rolled(plain, few, size)
    opening = size - literals(opens, size)
    both = np.flatnonzero((opening > 0) & (literal + opening >= min(size, LITERALS)))
    second = rolled(np.where(opens, plain, tokens), both, size)
    return np.concatenate((np.arange(n), both)), np.concatenate((out, second))


def literals(kind: np.ndarray, size: int) -> np.ndarray:
    """How many tokens of each window are literal."""
    upto = starts_of((kind == 0).astype(np.int64))
    return upto[size:] - upto[:len(upto) - size] if size < len(upto) else np.zeros(0, np.int64)


def all_of(good: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether all tokens of each span (begin, end) are good; an empty span is not."""
    upto = starts_of(good.astype(np.int64))
    size = spans[:, 1] - spans[:, 0]
    return (size > 0) & (upto[spans[:, 1]] - upto[spans[:, 0]] == size)


def longest_run(marks: np.ndarray) -> int:
    gaps = np.flatnonzero(~marks)
    return int(np.diff(gaps, prepend=-1, append=len(marks)).max()) - 1


class Item:
    """A benchmark item: its tokens, and the span that decides about each of its windows."""

    def __init__(self, item_id: int, words: list[bytes], plain: np.ndarray, kind: np.ndarray, opens: np.ndarray):
        self.id, self.plain, self.kind, self.opens = item_id, plain, kind, opens
        self.size = min(WINDOW, len(words))
        self.values = {k: (int(kind[k]), bare(words[k]).lower()) for k in np.flatnonzero(kind).tolist()}
        literal = literals(kind, self.size) if self.size else np.zeros(0, np.int64)
        self.total = len(literal)
        first = np.arange(self.total)
        self.spans = np.stack((first, first + self.size), axis=1)
        self.rich = literal >= min(self.size, LITERALS)
        self.covered = np.zeros(len(words), bool)
        for a, b in self.spans[self.rich].tolist():
            self.covered[a:b] = True
        # A window with few literal tokens is judged with its neighbours, until there are enough of them. Where the
        # whole item has too few, only the item's own values count.
        self.wide = self.spans.copy()
        upto, enough = starts_of((kind == 0).astype(np.int64)), min(self.size, LITERALS)
        for p in np.flatnonzero(~self.rich).tolist():
            a, b = p, p + self.size
            while upto[b] - upto[a] < enough and (a > 0 or b < len(kind)):
                a, b = max(0, a - 1), min(len(kind), b + 1)
            self.wide[p] = (a, b) if upto[b] - upto[a] >= enough else (0, 0)

    def enough(self, agree: np.ndarray) -> bool:
        """Whether these windows of one place are half of all, or enough in a row."""
        return self.half(agree) or longest_run(agree) + self.size - 1 >= RUN_WORDS

    def half(self, agree: np.ndarray) -> bool:
        return 100 * int(agree.sum()) >= SHARE * self.total

    def sizes(self) -> list[int]:
        """Windows to look up: the usual ones, and if none has enough literal tokens the least wider ones that do."""
        if not self.size or self.rich.any() or int((self.kind == 0).sum()) < LITERALS:
            return [self.size] if self.size else []
        size = self.size + 1
        while not (literals(self.kind, size) >= LITERALS).any():
            size += 1
        return [self.size, size]


class Spot:
    """A place of a document where an item may begin: which of its tokens stand there, and which values."""

    def __init__(self, item: Item, words: list[bytes], plain: np.ndarray, kind: np.ndarray, begin: int):
        a, b = max(0, -begin), min(len(item.plain), len(words) - begin)
        there = slice(begin + a, begin + b)
        self.item, self.words, self.begin = item, words, begin
        self.equal = np.zeros(len(item.plain), bool)
        self.equal[a:b] = item.plain[a:b] == plain[there]
        self.fits = self.equal.copy()
        self.fits[a:b] |= (item.kind[a:b] > 0) & (item.kind[a:b] == kind[there])
        self.windows = all_of(self.fits, item.spans)
        self.others: dict[int, str] = {}

    def read(self) -> None:
        """The document's values behind the placeholders, of fitting windows only."""
        covered = np.zeros(len(self.fits), bool)
        for a, b in self.item.spans[self.windows].tolist():
            covered[a:b] = True
        self.others = {k: bare(self.words[self.begin + k]).lower() for k in self.item.values if covered[k]}

    def agreeing(self, chosen: dict[tuple, str]) -> np.ndarray:
        """The item's windows that agree with the chosen values."""
        good = self.fits.copy()
        for k, other in self.others.items():
            good[k] = chosen[self.item.values[k]] == other
        return all_of(good, self.item.wide) | all_of(good & self.equal, self.item.spans)


def chosen_values(item: Item, spots: list[Spot]) -> dict[tuple, str]:
    votes: dict[tuple, Counter] = defaultdict(Counter)
    for spot in spots:
        for k, other in spot.others.items():
            votes[item.values[k]][other] += 1
    # The most frequent value; of several the item's own, then the least.
    return {v: min(c, key=lambda o, c=c, v=v: (-c[o], o != v[1], o)) for v, c in votes.items()}


class Items:
    """Windows of a block of benchmark items, sorted by hash."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        words = [text.split() for _, text in rows]
        plain, kind, opens, starts = templates(words, Vocabulary())
        self.items = [
            Item(row[0], w, plain[a:b], kind[a:b], opens[a:b])
            for row, w, a, b in zip(rows, words, starts, starts[1:], strict=False)
        ]
        found = [
            (int(h), i, int(p))
            for i, item in enumerate(self.items) for size in item.sizes()
            for p, h in zip(*windows(item.plain, item.kind, item.opens, size), strict=True)
        ]
        found.sort()
        self.sizes = sorted({size for item in self.items for size in item.sizes()})
        self.hashes = np.array([h for h, _, _ in found], np.uint64)
        self.item = np.array([i for _, i, _ in found], np.int64)
        self.place = np.array([p for _, _, p in found], np.int64)
        # A bit per hash remainder, so that nearly all windows of a document are settled by one look.
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def hits(self, places: np.ndarray, hashes: np.ndarray) -> list[tuple[int, int]]:
        """(place in the document, row of the item windows) of all equal windows."""
        maybe = np.flatnonzero(self.filter[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        low, high = (np.searchsorted(self.hashes, hashes[maybe], side) for side in ("left", "right"))
        return [
            (int(at), row)
            for at, a, b in zip(places[maybe[high > low]], low[high > low], high[high > low], strict=True)
            for row in range(a, b)
        ]

    def matches(
        self, words: list[bytes], plain: np.ndarray, kind: np.ndarray, hits: set[tuple[int, int]]
    ) -> Iterator[tuple]:
        """(item id, its windows, agreeing windows, slots, slots with another value) of the items found."""
        by_item: dict[int, list[int]] = defaultdict(list)
        for i, begin in sorted(hits):
            by_item[i].append(begin)
        for i, begins in by_item.items():
            item = self.items[i]
            spots = [Spot(item, words, plain, kind, begin) for begin in begins]
            if not any(item.enough(spot.windows) for spot in spots):
                if not item.half(np.logical_or.reduce([spot.windows for spot in spots])):
                    continue
            for spot in spots:
                spot.read()
            # Every copy has values of its own; parts that lie apart are taken together with one value for all of them.
            groups = [[spot] for spot in spots] + [spots] * (len(spots) > 1)
            best = None
            for group in groups:
                chosen = chosen_values(item, group)
                agree = np.logical_or.reduce([spot.agreeing(chosen) for spot in group])
                if item.enough(agree) if len(group) == 1 else item.half(agree):
                    slots = {item.values[k] for spot in group for k in spot.others if item.covered[k]}
                    changed = sum(v[1] != chosen[v] for v in slots)
                    best = max(best or (0, 0, 0), (int(agree.sum()), -changed, len(slots)))
            if best:
                yield item.id, item.total, best[0], best[2], -best[1]


MATCHES = "doc_id long, item_id long, item_windows long, matched_windows long, slots long, changed_slots long"


def matches_of_block(docs: DataFrame, items: Items) -> DataFrame:
    block = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, items = Vocabulary(), block.value
        for rows in by_chunk(batches, CHUNK_BYTES):
            words = [(r[1] or b"").split() for r in rows]
            plain, kind, opens, starts = templates(words, vocabulary)
            hits: dict[int, set[tuple[int, int]]] = defaultdict(set)
            for size in items.sizes:
                for at, row in items.hits(*windows(plain, kind, opens, size)):
                    doc = int(np.searchsorted(starts, at, "right")) - 1
                    if at + size <= starts[doc + 1]:
                        hits[doc].add((int(items.item[row]), int(at - starts[doc] - items.place[row])))
            out = [
                (rows[d][0], *found)
                for d, spots in hits.items()
                for found in items.matches(words[d], *(x[starts[d]:starts[d + 1]] for x in (plain, kind)), spots)
            ]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    ["doc_id", "item_id", "item_windows", "matched_windows", "slots", "changed_slots"],
                )

    return id_and_bytes(docs).mapInArrow(run, MATCHES)


def blocks_of(benchmark: DataFrame) -> Iterator[Items]:
    rows, n = [], 0
    texts = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).where("text is not null")
    for item_id, text in texts.toLocalIterator():
        rows.append((item_id, bytes(text)))
        n += len(rows[-1][1].split())
        if n >= BLOCK_WORDS:
            yield Items(rows)
            rows, n = [], 0
    yield Items(rows)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return reduce(DataFrame.unionAll, (matches_of_block(docs, items) for items in blocks_of(benchmark)))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that contain an item; rows without doc_id stay."""
    bad = contamination(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    # As a table the list has a known size: a short one is broadcast, and the documents stay where they are.
    bad = written(bad, f"{shared_folder(docs.sparkSession, 'contaminated')}/ids")
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(read_documents(spark, sf_dir), benchmark)
    return found.withColumn("coverage", F.col("matched_windows") / F.col("item_windows"))
