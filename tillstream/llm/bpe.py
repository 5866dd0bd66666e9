"""BPE encoding and decoding by speculation and verification.

The merges of a word-level BPE file (byte alphabet, end-of-word suffix) are applied to the distinct new words of a
chunk at once: every word is cut greedily into the longest vocabulary entries, all words in step through one
prefix tree; then numpy tests every pair of neighbours. A cut is what merging gives exactly if every token merges to
itself and every pair of neighbours is compatible: undoing the merges of both in reverse order, no merge across
their border would have come earlier. Only words with an incompatible pair are merged one by one.

Normalisation and word pattern are those of the file (composed form, lower case, contractions, letter runs, single
digits, other runs; spaces dropped). The file's special tokens are found in the raw text. Decoding joins the
tokens' strings with spaces. Null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.words import by_chunk, id_and_bytes

CHUNK_BYTES = 2 << 20
DECODED_IDS = 1 << 20
# Between the words of the constant vocabulary, and in the place of an id that has no word.
SEPARATOR, MISSING = "\0", "\1"
CACHED_PIECES = 120_000
FINAL = 256  # added to the byte that ends a word
NEVER = np.int64(1) << 40
LONG_WORD = 64
# Lower-case ASCII and Latin letters, and the file's word pattern for such text, which re finds faster than regex.
LATIN = re.compile("[\t-\r -~À-ÖØ-öø-ɏ]*")
LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-zÀ-ɏ]+|[0-9]|[^\sA-Za-zÀ-ɏ0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the file: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Codec:
    """Tables of one vocabulary file; small (one entry per token and merge) and sent to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        parts = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = parts[0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (*model["vocab"].items(), *self.special.items())}
        vocab, letters = model["vocab"], byte_letters()

        size = max(vocab.values()) + 1
        self.symbol = np.zeros(2 * FINAL, np.int64)  # token of a byte, of a word's last byte
        for b, letter in letters.items():
            self.symbol[b], self.symbol[FINAL + b] = vocab[letter], vocab[letter + self.suffix]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        spelled: dict[int, tuple[int, ...]] = {int(t): (s,) for s, t in enumerate(self.symbol)}
        made_twice = set()
        for rank, (a, b) in enumerate(model["merges"]):
            a, b = vocab[a], vocab[b]
            new = vocab[self.strings[a] + self.strings[b]]
            self.merges[a, b] = (rank, new)
            if self.rank[new] >= 0 or new in spelled:
                made_twice.add(new)
            self.rank[new], self.left[new], self.right[new] = rank, a, b
            spelled[new] = spelled[a] + spelled[b]
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_ranks, self.pair_tokens = np.array(list(self.merges.values()), np.int64)[order].T.copy()

        # The prefix tree: a sorted array of state * 512 + symbol, the state it leads to, the state's token.
        edges: dict[int, int] = {}
        token = [-1]
        for t, symbols in spelled.items():
            state = 0
            for s in symbols:
                key = state * 2 * FINAL + s
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                state = edges[key]
            if t not in made_twice and self.merged(symbols) == [t]:
                token[state] = t
        order = np.argsort(np.fromiter(edges, np.int64, len(edges)))
        self.edge_keys = np.fromiter(edges, np.int64, len(edges))[order]
        self.edge_states = np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.state_token = np.array(token, np.int64)

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """Exact merging: always the pair of the lowest rank, the leftmost of several."""
        ids = [int(self.symbol[s]) for s in symbols]
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        queue = [(self.merges[p][0], i, p) for i, p in enumerate(pairwise(ids)) if p in self.merges]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i] if ids[i] == pair[0] else len(ids)
            if j >= len(ids) or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = self.merges[pair][1], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (p := (ids[a], ids[b])) in self.merges:
                    heapq.heappush(queue, (self.merges[p][0], a, p))
        return [t for t in ids if t >= 0]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of merging each pair, NEVER if they do not merge, and the place of the pair."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER), at

    def merged_together(self, words: list[np.ndarray]) -> list[list[int]]:
        """Like merged for many words in step: in each round every word merges its best pair."""
        out: list[list[int]] = [[] for _ in words]
        tokens = self.symbol[np.concatenate(words)] if words else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        best = np.full(len(tokens), NEVER)
        here = np.flatnonzero(owner[1:] == owner[:-1])
        best[here] = self.ranks(tokens[here], tokens[here + 1])[0]
        while len(tokens):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(best, first)
            word = np.cumsum(np.diff(owner, prepend=-1) > 0) - 1
            done = (least == NEVER)[word]
            if done.any():
                ended = np.flatnonzero(least == NEVER)
                ends = np.append(first[1:], len(tokens))
                for k in ended.tolist():
                    out[owner[first[k]]] = tokens[first[k]:ends[k]].tolist()
                tokens, owner, best, least, word = tokens[~done], owner[~done], best[~done], least, word[~done]
                if not len(tokens):
                    break
            hits = np.flatnonzero(best == least[word])
            hits = hits[np.diff(word[hits], prepend=-1) > 0]  # the leftmost of each word
            tokens[hits] = self.pair_tokens[self.ranks(tokens[hits], tokens[hits + 1])[1]]
            keep = np.ones(len(tokens), bool)
            keep[hits + 1] = False
            tokens, owner, best = tokens[keep], owner[keep], best[keep]
            at = hits - np.arange(len(hits))
            for place in (at, at[at > 0] - 1):
                inside = (place + 1 < len(tokens)) & (owner[np.minimum(place + 1, len(tokens) - 1)] == owner[place])
                best[place[~inside]] = NEVER
                place = place[inside]
                best[place] = self.ranks(tokens[place], tokens[place + 1])[0]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between a and b, for many pairs."""
        fine, live = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), NEVER)
        while len(live):
            rank, _ = self.ranks(a, b)
            fine[live[rank < limit]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = (rank >= limit) & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[on], a[on], b[on], ra[on], rb[on]
            # Undo the younger of both; of equal pairs to its right the left one is merged first.
            of_a = ra > rb
            limit = np.where(of_a, ra, rb + 1)
            a, b = np.where(of_a, self.right[a], a), np.where(of_a, b, self.left[b])
        return fine

    def longest(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy cut of all words: word and token of each piece in order, and which words have none."""
        ends, stuck = starts[1:], np.zeros(len(starts) - 1, bool)
        live = np.flatnonzero(ends > starts[:-1])
        at, end = starts[:-1][live], ends[live]
        state, best, best_end = np.zeros(len(live), np.int64), np.full(len(live), -1), at.copy()
        words, tokens = [], []
        while len(live):
            key = state * 2 * FINAL + symbols[np.minimum(at, end - 1)]
            edge = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            on = (self.edge_keys[edge] == key) & (at < end)
            state = np.where(on, self.edge_states[edge], 0)
            at = at + on
            token = np.where(on, self.state_token[state], -1)
            best, best_end = np.where(token >= 0, token, best), np.where(token >= 0, at, best_end)
            cut = ~on
            if cut.any():
                lost = cut & (best < 0)
                stuck[live[lost]] = True
                take = cut & ~lost
                words.append(live[take])
                tokens.append(best[take])
                at, best = np.where(cut, best_end, at), np.where(cut, -1, best)
                stay = ~lost & ~(cut & (best_end == end))
                live, at, end, state, best, best_end = (
                    x[stay] for x in (live, at, end, state, best, best_end)
                )
        words = np.concatenate([*words, np.zeros(0, np.int64)])
        order = np.argsort(words, kind="stable")
        return words[order], np.concatenate([*tokens, np.zeros(0, np.int64)])[order], stuck

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words needed exact merging."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        starts = np.concatenate(([0], np.cumsum(lengths)))
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        symbols[starts[1:][lengths > 0] - 1] += FINAL
        word, token, failed = self.longest(symbols, starts)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(token[inside] * self.size + token[inside + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size)[back]
        failed[word[inside[~fine]]] = True
        cuts = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        token = token.tolist()
        out = [token[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        # A very long word has as many rounds as letters: it is merged alone.
        wrong = np.flatnonzero(failed)
        short = wrong[lengths[wrong] <= LONG_WORD]
        together = self.merged_together([symbols[starts[k]:starts[k + 1]] for k in short.tolist()])
        for k, ids in zip(short.tolist(), together, strict=True):
            out[k] = ids
        for k in wrong[lengths[wrong] > LONG_WORD].tolist():
            out[k] = self.merged(symbols[starts[k]:starts[k + 1]].tolist())
        return out, len(wrong)


class Encoder:
    """Encodes texts in a task; keeps what it found for CACHED_PIECES words."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.words = regex.compile(codec.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, codec.special)) + ")")
        # Ids (as bytes) of each word.
        self.ids: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text in order; a special token is marked by a leading NUL."""
        if not any(s in text for s in self.codec.special):
            return self.plain(text)
        parts = self.special.split(text)
        return [p for k, part in enumerate(parts) for p in (["\0" + part] if k % 2 else self.plain(part))]

    def plain(self, text: str) -> list[str]:
        # Each letter is lowered by itself, so a final sigma is like any other.
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return LATIN_WORDS.findall(low) if LATIN.fullmatch(low) else self.words.findall(low)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.pieces(t) for t in texts]
        if len(self.ids) > CACHED_PIECES:
            self.ids.clear()
        for name, i in self.codec.special.items():
            self.ids["\0" + name] = struct.pack("<i", i)
        new = list(set(chain.from_iterable(cut)) - self.ids.keys())
        for word, ids in zip(new, self.codec.encode_words(new)[0], strict=True):
            self.ids[word] = struct.pack(f"<{len(ids)}i", *ids)
        return [np.frombuffer(b"".join(map(self.ids.__getitem__, words)), "<i4") for words in cut]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of each whole text."""
    codec = docs.sparkSession.sparkContext.broadcast(Codec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(codec.value)
        for rows in by_chunk(batches, CHUNK_BYTES):
            found = encoder.encode([(r[1] or b"").decode() for r in rows])
            starts = np.concatenate(([0], np.cumsum([len(ids) for ids in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(found), pa.int32())),
                ],
                ["doc_id", "ids"],
            )

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, ids array<int>")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded: the text of these ids, made by the same function as decode()'s, in one Python stage."""
    codec = docs.sparkSession.sparkContext.broadcast(Codec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = Encoder(codec.value), vocabulary(codec.value.strings)
        for rows in by_chunk(batches, CHUNK_BYTES):
            found = encoder.encode([(r[1] or b"").decode() for r in rows])
            sizes = np.array([len(ids) for ids in found], np.int64)
            part = np.cumsum(sizes) // DECODED_IDS
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
                starts = np.concatenate(([0], np.cumsum(sizes[a:b]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(found[a:b]), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows[a:b]], pa.int64()), ids, joined(ids, words)],
                    ["doc_id", "ids", "decoded"],
                )

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def vocabulary(strings: dict[int, str]) -> pa.Array:
    """The text of each id, by id."""
    return pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.large_string())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns and decoded, the text of ``ids``; null ids decode to null, an unknown id is an error.

    The vocabulary is one constant array, so the ids need no Python stage of their own.
    """
    strings = Codec(path).strings
    if any(SEPARATOR in word or word == MISSING for word in strings.values()):
        raise ValueError("a word of the vocabulary has the sign of a separator")
    known = [strings.get(i, MISSING) for i in range(max(strings) + 1)]
    words = F.split(F.lit(SEPARATOR.join(known)), SEPARATOR)
    unknown = F.raise_error(F.lit("an id that is null or not in the vocabulary")).cast("string")
    texts = F.transform("ids", lambda i: F.coalesce(F.nullif(F.get(words, i), F.lit(MISSING)), unknown))
    return encoded.drop("decoded").withColumn("decoded", F.array_join(texts, " "))


def joined(ids: pa.ListArray, words: pa.Array) -> pa.Array:
    """The words of each list with spaces between them."""
    # Ids beyond the vocabulary, negative ones too, are an error of take.
    found = words.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id that is null or not in the vocabulary")
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), found), pa.scalar(" ", words.type))
    return pc.if_else(ids.is_valid(), texts, pa.scalar(None, texts.type)).cast(pa.string())


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """What the query returns of ids and decoded, and more columns."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )


def op6_bpe(docs: DataFrame, path: str) -> DataFrame:
    return digests(decode(encode(docs, path), path))
