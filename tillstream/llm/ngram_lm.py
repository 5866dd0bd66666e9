"""LM scoring: an interpolated modified Kneser-Ney model of order 2 or 3 over the whole corpus.

Tokens are the words of the lower-cased (A-Z) text and one end token per document. Spark counts words, bigrams of
word numbers and (order 3) trigrams, each the number of its first bigram and a word number; all are sorted hash arrays
in the shared folder (``arrays``) that the scoring tasks map into memory, next to dense arrays with five numbers per
context (word or bigram): how often it is a context, with how many words it was seen once, twice and more often, and how
many different words came before it. The driver holds only totals, a few numbers for each shard.

A word's probability after u is (c(u w) - D(c)) / c(u) + g(u) * p(w), where p(w) has the same form over the number
of different words before w, and mixes with 1 / (V + 1), the unknown word included. After u v it is
(c(u v w) - D(c)) / c(u v) + g(u v) * p(w | v), where p(w | v) counts, instead of v w, the different words before v w.
The first token follows one and the second two places before the text. D1, D2 and D3 come from the numbers of
trigrams, bigrams or continuations counted 1 to 4 times. After an unseen context the next shorter one is used alone; after
one of whose words none is discounted, the shorter one counts as one occurrence more, so every score is finite.

Empty and null texts are one end token. Without any training document every token has probability 1 / (V + 1) = 1.
Word numbers take 32 bits, so a vocabulary of 2^32 words or more is refused; bigram and word number together take 64.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import arrays
from tillstream.llm.arrays import HashArrays
from tillstream.llm.words import (
    CHUNK_WORDS, SPACES, by_chunk, held_out, id_and_bytes, mix, mix_bits, starts_of, sums_by, text_bytes, unmix_bits
)

END = np.uint64(xxhash.xxh3_64_intdigest(b""))  # no word is empty
IS_SIGN = ~np.isin(np.arange(256), list(SPACES))
LONG_WORD = 64  # bytes
LANE_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
GAMMA = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 500_000
CHUNK_BYTES = CHUNK_WORDS * 6
STATS = ("context", "once", "twice", "more", "before")
BASE_ADD = 0.1


@dataclass
class Ids:
    """A number for each token: the different ones (the last ascending, -1 at most before them) and which a token has."""

    distinct: np.ndarray
    back: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> Ids:
        return cls(*np.unique(ids, return_inverse=True))

    @property
    def ids(self) -> np.ndarray:
        return self.distinct[self.back]

    def shifted(self, starts: np.ndarray, begin: int) -> Ids:
        """The number before each token; ``begin``, larger than all, at the start of a document."""
        return Ids(np.append(self.distinct, begin), contexts(self.back, starts, len(self.distinct)))


def word_hashes(data: bytes, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at some places, eight bytes of all words at a time; long words one by one."""
    # Eight bytes from each place on; what lies behind a word's end is masked.
    lanes = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    out = mix(size.astype(np.uint64) + GAMMA)
    for at in range(0, LONG_WORD, 8):
        more = np.flatnonzero(size > at) if at else slice(None)
        lane = lanes[first[more] + at] & LANE_MASKS[np.minimum(size[more] - at, 8)]
        out[more] = mix(out[more] * GAMMA + lane)
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(data[first[k]:first[k] + size[k]])
    return out


def tokens(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' tokens, one document after the other, and where each begins."""
    texts = [row[1] or b"" for row in rows]
    data = b"".join([part for text in texts for part in (text, b" ")]).lower()
    # Words begin after a space or at the start, and end before a space, as each text does.
    edges = np.flatnonzero(np.diff(IS_SIGN[np.frombuffer(data, np.uint8)], prepend=False))
    first, last = edges[::2], edges[1::2]
    ends = np.searchsorted(first, np.cumsum([len(text) + 1 for text in texts]))
    hashes = np.insert(word_hashes(data, first, last - first), ends, END)
    return hashes, starts_of(np.diff(ends, prepend=0) + 1)


def numbered(hashes: np.ndarray, words: HashArrays) -> tuple[Ids, np.ndarray]:
    """Word number (-1 if unknown) of each token, and the count of each different word number."""
    hashes, back = np.unique(hashes, return_inverse=True)
    place, count = words.find(hashes)
    hit = place >= 0
    which = np.where(hit, np.cumsum(hit), 0)
    return Ids(np.append(-1, place[hit]), which[back]), np.append(0, count[hit])


def contexts(ids: np.ndarray, starts: np.ndarray, begin: int) -> np.ndarray:
    """The number before each token; ``begin`` at the start of a document."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts[:-1]] = begin
    return before


@dataclass
class Pair:
    """How a context and a word number make a key: the bits they take, so that keys are sent and stored in few bytes."""

    word: int
    both: int

    def keys(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return mix_bits((before.astype(np.uint64) << np.uint64(self.word)) | ids.astype(np.uint64), self.both)

    def split(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word numbers of the keys."""
        pair = unmix_bits(keys, self.both)
        word = pair & np.uint64((1 << self.word) - 1)
        return (pair >> np.uint64(self.word)).astype(np.int64), word.astype(np.int64)


def found_grams(before: np.ndarray, ids: np.ndarray, grams: HashArrays, pair: Pair) -> tuple[Ids, np.ndarray]:
    """Place (-1 if unknown) of each context and token, and the count of each different place."""
    known = (ids >= 0) & (before >= 0)
    keys, back = np.unique(pair.keys(before[known], ids[known]), return_inverse=True)
    place, count = grams.find(keys)
    hit = place >= 0
    which = np.zeros(len(ids), np.int64)
    which[known] = np.where(hit, np.cumsum(hit), 0)[back]
    return Ids(np.append(-1, place[hit]), which), np.append(0, count[hit])


def dense(folder: str, size: int, ids: np.ndarray, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The given numbers of some ascending context numbers, from dense arrays of ``size`` numbers each."""
    out = [np.zeros(len(ids), np.int64) for _ in kinds]
    block = ids // size
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True):
        for values, kind in zip(out, kinds, strict=True):
            values[a:b] = arrays.Small(f"{folder}/{block[a]}.{kind}")[ids[a:b] % size]
    return out


def discounts(n: list[int]) -> np.ndarray:
    """D of a count of 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [k - (k + 1) * y * upper / lower if lower else 0.0
             for k, lower, upper in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in enumerate(found, 1))])


@dataclass
class Level:
    """Bigrams or trigrams."""

    grams: HashArrays
    folder: str  # of the dense arrays of their contexts
    discounts: np.ndarray
    pair: Pair
    before: str = ""  # dense arrays whose numbers of words before take the place of the counts


@dataclass
class Model:
    words: HashArrays
    levels: list[Level]  # bigrams and, if the order is 3, trigrams
    block: int  # context numbers in one dense array
    tokens: int
    word_discounts: np.ndarray
    unknown: float  # probability that p(w) gives to a word without any predecessor

    def log10(self, ids: np.ndarray | Ids, *before: np.ndarray | Ids, places: Ids | None = None) -> np.ndarray:
        """log10 of each token's probability after its contexts, a number for each level; unknown ones are -1.

        ``places`` are those of the bigrams, if they are known already.
        """
        ids, *before = (x if isinstance(x, Ids) else Ids.of(x) for x in (ids, *before))
        if not len(self.words):
            return np.zeros(len(ids.back))
        (seen,) = dense(self.levels[0].folder, self.block, np.maximum(ids.distinct, 0), ("before",))
        seen = np.where(ids.distinct < 0, 0, seen)
        d = self.word_discounts[np.minimum(seen, 3)]
        p = ((seen - d) / max(1, len(self.levels[0].grams)) + self.unknown)[ids.back]
        words = ids.ids
        for level, context in zip(self.levels, before, strict=True):
            p = self.mixed(level, words, context, p, places if level is self.levels[0] and level.before else None)
        return np.log10(p)

    def mixed(self, level: Level, ids: np.ndarray, before: Ids, low: np.ndarray, places: Ids | None) -> np.ndarray:
        context, once, twice, more = dense(level.folder, self.block, np.maximum(before.distinct, 0), STATS[:4])
        spread = once * level.discounts[1] + twice * level.discounts[2] + more * level.discounts[3]
        context = np.where(before.distinct < 0, 0, context)[before.back]
        if places is None:
            places, count = found_grams(before.ids, ids, level.grams, level.pair)
        if level.before:
            (count,) = dense(level.before, self.block, np.maximum(places.distinct, 0), ("before",))
            count[places.distinct < 0] = 0
        share = spread[before.back]
        high = ((count - level.discounts[np.minimum(count, 3)])[places.back] + share * low) / np.maximum(context, 1)
        # Where no word is discounted, one occurrence more is left to the shorter context: no probability is 0.
        high = np.where(share > 0, high, (count[places.back] + low) / (context + 1))
        return np.where(context > 0, high, low)


def count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def count_words(docs: DataFrame, folder: str) -> tuple[HashArrays, int]:
    shards = arrays.shard_count(text_bytes(docs) // 6)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            yield from arrays.blocks(tokens(rows)[0], shards)

    found = arrays.write_arrays(
        id_and_bytes(docs).mapInArrow(blocks, arrays.BLOCKS), folder, 1, lambda _, c: [int(c.sum())], ["tokens"]
    )
    return HashArrays(folder, arrays.sizes_of(found), shards), arrays.total(found, "tokens")


def contexts_of(ids: Ids, starts: np.ndarray, begin: int, pairs: Level | None) -> tuple[list[Ids], Ids | None]:
    """The context number of each token for each level: the word before it, and the bigram of the two before it.

    With the latter come the places of the tokens' own bigrams.
    """
    before = ids.shifted(starts, begin)
    if pairs is None:
        return [before], None
    places, _ = found_grams(before.ids, ids.ids, pairs.grams, pairs.pair)
    return [before, places.shifted(starts, len(pairs.grams))], places


def count_grams(
    docs: DataFrame, words: HashArrays, folder: str, pair: Pair, pairs: Level | None = None
) -> tuple[HashArrays, list[int]]:
    """Bigrams, or with these the trigrams, and how many are counted 1 to 4 times."""
    begin, shards = len(words), words.shards
    bits = arrays.stored_bits(pair.both, shards)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            hashes, starts = tokens(rows)
            ids = numbered(hashes, words)[0].ids
            before = contexts(ids, starts, begin)
            if pairs is not None:
                places = found_grams(before, ids, pairs.grams, pairs.pair)[0].ids
                before = contexts(places, starts, len(pairs.grams))
            yield from arrays.blocks(pair.keys(before, ids), shards)

    names = ["n1", "n2", "n3", "n4"]
    found = arrays.write_arrays(
        id_and_bytes(docs).mapInArrow(blocks, arrays.BLOCKS), folder, 1, lambda _, c: count_of_counts(c), names, bits
    )
    return HashArrays(folder, arrays.sizes_of(found), shards, bits), [arrays.total(found, n) for n in names]


def parts(place: np.ndarray, weight: list[np.ndarray], first: int, block: int) -> Iterator[tuple]:
    """Sums of the weights by context number, cut into blocks of numbers; the sums are the statistics from ``first`` on."""
    distinct, back = np.unique(place, return_inverse=True)
    sums = [np.bincount(back, w, len(distinct)).astype(np.int64) for w in weight]
    cuts = np.flatnonzero(np.diff(distinct // block, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(distinct)], strict=True):
        at = arrays.packed((distinct[a:b] % block).astype(np.uint64))
        yield int(distinct[a] // block), first, at, [arrays.packed_counts(s[a:b]) for s in sums]


def context_stats(
    spark: SparkSession, level: Level, n_contexts: int, begin: int = 0, pairs: Level | None = None
) -> list[int]:
    """The dense arrays of a level's contexts, block by block; returns how many have 1 to 4 different words before them.

    Contexts of trigrams are bigrams, and a word comes before the bigram of their last two words.
    """
    grams, folder, size = level.grams, level.folder, BLOCK
    shards = spark.range(0, grams.shards, 1, grams.shards)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                if not grams.sizes[shard]:
                    continue
                keys, counts = grams.shard(shard).all()
                if level.before:
                    places = np.arange(grams.starts[shard], grams.starts[shard + 1])
                    (counts,) = dense(level.before, size, places, ("before",))
                before, after = level.pair.split(keys)
                if pairs is not None:
                    # The last word of the context; the place before a text has no bigram and ends in its word number.
                    distinct, back = np.unique(before, return_inverse=True)
                    last = np.full(len(distinct), begin, np.int64)
                    real = distinct < len(pairs.grams)
                    last[real] = pairs.pair.split(pairs.grams.keys_at(distinct[real]))[1]
                    after = found_grams(last[back], after, pairs.grams, pairs.pair)[0].ids
                rows = [
                    *parts(before, [counts, counts == 1, counts == 2, counts >= 3], 0, size),
                    *parts(after, [np.ones(len(after))], 4, size),
                ]
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["block", "stat", "places", "sums"],
                )

    def write(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        values = np.zeros((len(STATS), size), np.int64)
        for stat, places, sums in zip(*(table[c].to_pylist() for c in table.column_names[1:]), strict=True):
            at = arrays.unpacked(places).astype(np.int64)
            for k, s in enumerate(sums, stat):
                values[k, at] += arrays.unpacked_counts(s)
        for k, kind in enumerate(STATS):
            arrays.save_small(f"{folder}/{block}.{kind}", values[k])
        return pa.table({f"n{k}": pa.array([n], pa.int64()) for k, n in enumerate(count_of_counts(values[4]), 1)})

    with arrays.shuffles_dropped(spark):
        found = (
            shards.mapInArrow(sums, "block long, stat int, places binary, sums array<binary>")
            .groupBy("block").applyInArrow(write, "n1 long, n2 long, n3 long, n4 long").collect()
        )
    written = -(-(n_contexts + 1) // size)
    for block in range(written):  # a block without any bigram cannot be, save at the very start token alone
        for kind in STATS:
            if not os.path.exists(f"{folder}/{block}.{kind}"):
                arrays.save_small(f"{folder}/{block}.{kind}", np.zeros(size, np.int64))
    return [arrays.total(found, f"n{k}") for k in (1, 2, 3, 4)]


def train(docs: DataFrame, order: int = 2) -> Model:
    """Count the model over all given documents."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    words, n_tokens = count_words(docs, arrays.shared_folder(spark, "lm-words"))
    if len(words) >= 1 << 32:
        raise ValueError("the vocabulary has 2^32 words or more")
    bits = max(1, len(words).bit_length())
    pair = Pair(bits, 2 * bits)
    bigrams, n = count_grams(docs, words, arrays.shared_folder(spark, "lm-bigrams"), pair)
    levels = [Level(bigrams, arrays.shared_folder(spark, "lm-stats"), discounts(n), pair)]
    if order == 3:
        pair = Pair(bits, bits + max(1, len(bigrams).bit_length()))
        if pair.both > 64:
            raise ValueError("bigram and word number together take more than 64 bits")
        trigrams, n = count_grams(docs, words, arrays.shared_folder(spark, "lm-trigrams"), pair, levels[0])
        levels.append(Level(trigrams, arrays.shared_folder(spark, "lm-pairs"), discounts(n), pair))
        n = context_stats(spark, levels[1], len(bigrams), len(words), levels[0])
        levels[0].discounts, levels[0].before = discounts(n), levels[1].folder
    m = context_stats(spark, levels[0], len(words))
    d = discounts(m)
    ones, twos = m[0], m[1]
    # Words with three or more different predecessors: all words but the rare ones.
    more = len(words) - ones - twos
    spread = d[1] * ones + d[2] * twos + d[3] * more
    unknown = spread / max(1, len(bigrams)) / (len(words) + 1)
    if len(words) and not unknown:  # no word is discounted: keep a share for the unknown word
        unknown = 1 / (len(bigrams) + 1) / (len(words) + 1)
    return Model(words, levels, BLOCK, n_tokens, d, unknown)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and the scores of each whole text."""
    words = model.words
    pairs = model.levels[0] if len(model.levels) > 1 else None

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            hashes, starts = tokens(rows)
            ids, count = numbered(hashes, words)
            base = np.log10((count + BASE_ADD) / (model.tokens + BASE_ADD * (len(words) + 1)))[ids.back]
            before, places = contexts_of(ids, starts, len(words), pairs)
            values = model.log10(ids, *before, places=places)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.bool_()),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.array(sums_by(ids.back > 0, starts).astype(np.int64), pa.int64()),
                    pa.array(np.full(len(rows), model.tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, starts[:-1]), pa.float64()),
                    pa.array(np.add.reduceat(values, starts[:-1]), pa.float64()),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return id_and_bytes(docs, held_out(10).alias("held_out")).mapInArrow(scored, schema)


def op10_ngram_lm(docs: DataFrame, order: int = 2) -> DataFrame:
    """Train on the documents outside the held-out fold, score all."""
    return score(docs, train(docs.where(~held_out(10)), order)).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    )
