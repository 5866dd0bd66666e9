"""Token-ID output: fixed-width bit-packed files with random access.

Documents are range-partitioned by doc_id, sorted, and each partition is encoded and written as one file:

* blocks of BLOCK_IDS ids, each id in the fewest bits that hold the vocabulary, a block padded to whole bytes;
* a table with doc_id and first id of each document, and the byte offset of each block;
* a trailer of six little-endian 64-bit numbers: magic, width, documents, ids, blocks, offset of the table.

Any run of ids is read by unpacking its blocks only. The order over all files is ascending doc_id (null first),
then a hash of the text, then the text; repeated rows are kept. The driver gets two numbers per file and hands
every file the ids before it.
Files are written under another name and renamed, so a repeated task leaves the same file.
Null and empty texts have the end id alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm.arrays import shared_folder
from tillstream.llm.bpe import byte_letters
from tillstream.llm.words import by_chunk, id_and_bytes, starts_of, text_bytes

MAGIC = 0x31534449444B4F54
BLOCK_IDS = 8192
FILE_BYTES = 16 << 20  # of text
CHUNK_BYTES = 2 << 20
CACHED_PIECES = 200_000
MERGED_WORDS = 256
MARK = b"\xff"
# Settings of the library's model under which words between marks may not be merged like words alone.
WORD_SETTINGS = ("ignore_merges", "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
END_ID = 0

# Where the word pattern of the file sees ASCII text and Latin letters only: there it is followed byte by byte.
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ɏ]*")
# Of such text: each byte beyond ASCII belongs to a letter.
LETTER, DIGIT, SIGN, SPACE = range(4)
KINDS = np.array(
    [
        LETTER if b >= 0x80 or chr(b).isalpha() else DIGIT if chr(b).isdigit() else SPACE if chr(b).isspace() else SIGN
        for b in range(256)
    ],
    np.uint8,
)


def pack(ids: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Appends documents to one file; holds less than one block of ids besides the table."""

    def __init__(self, path: str, vocabulary: int):
        self.path, self.own = path, f"{path}.{uuid.uuid4().hex}"
        self.width = max(1, (vocabulary - 1).bit_length())
        self.out = open(self.own, "wb")
        self.docs: list[int | None] = []
        self.firsts, self.offsets, self.n = [0], [0], 0
        self.rest = np.zeros(0, np.uint32)

    def add(self, doc_ids: list[int | None], lengths: list[int] | np.ndarray, ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.firsts += (self.n + np.cumsum(lengths)).tolist()
        self.n += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        for a in range(0, whole, BLOCK_IDS):
            self.block(ids[a:a + BLOCK_IDS])
        self.rest = ids[whole:]

    def block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.offsets[-1] + self.out.write(pack(ids, self.width)))

    def close(self) -> None:
        if len(self.rest):
            self.block(self.rest)
        known = np.array([d is not None for d in self.docs], np.int64)
        docs = np.array([d or 0 for d in self.docs], np.int64)
        for table in (known, docs, np.array(self.firsts), np.array(self.offsets)):
            self.out.write(table.astype("<i8").tobytes())
        trailer = [MAGIC, self.width, len(docs), self.n, len(self.offsets) - 1, self.offsets[-1]]
        self.out.write(np.array(trailer, "<i8").tobytes())
        self.out.close()
        os.replace(self.own, self.path)


class Reader:
    """Random access to one file, mapped into memory."""

    def __init__(self, path: str):
        self.data = np.memmap(path, np.uint8, "r")
        magic, self.width, docs, self.n, blocks, table = self.data[-48:].view("<i8").tolist()
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        cuts = np.cumsum([table, 8 * docs, 8 * docs, 8 * docs + 8, 8 * blocks + 8])
        known, ids, self.firsts, self.offsets = (
            np.array(self.data[a:b]).view("<i8") for a, b in zip(cuts, cuts[1:], strict=False)
        )
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known.tolist(), strict=True)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file; reads the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, (stop - 1) // BLOCK_IDS
        found = [
            unpack(
                self.data[self.offsets[b]:self.offsets[b + 1]], min(BLOCK_IDS, self.n - b * BLOCK_IDS), self.width
            )
            for b in range(first, last + 1)
        ]
        return np.concatenate(found)[start - first * BLOCK_IDS:stop - first * BLOCK_IDS]


def word_starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words of PLAIN texts begin, which lie one after the other and begin at ``first`` (ascending).

    The file's own pattern: 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?signs|spaces(?!no space)|spaces. A word's ids do
    not depend on its neighbours.
    """
    n = len(data)
    kind = KINDS[data]
    opens = np.zeros(n + 1, bool)  # a text or the end
    opens[first] = opens[n] = True
    run = opens.copy()  # a text or a run of one kind
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    at = np.flatnonzero(run[:n] & ~opens[:n])
    # After spaces: the last space is a word by itself or, if blank, the first sign of the next one.
    after = at[(kind[at - 1] == SPACE) & (kind[at] != SPACE)]
    start[after - 1] = True
    start[after[data[after - 1] == ord(" ")]] = False
    # An apostrophe that begins a word, and the letters after it.
    quote = np.flatnonzero((data == ord("'")) & start[:n])
    for ending in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
        hit = quote[quote + len(ending) < n]
        for k, letter in enumerate(ending, 1):
            hit = hit[(data[hit + k] == letter) & ~opens[hit + k]]
        start[hit + 1] = False
        start[hit + 1 + len(ending)] = True
    return np.flatnonzero(start[:n])


class Pieces:
    """Ids of words as bytes, by the library's model. When full, the cache keeps one older generation to draw from."""

    def __init__(self, tokenizer: Tokenizer, spec: str):
        self.model = tokenizer.model
        self.letters = byte_letters()
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        model = json.loads(spec)["model"]
        # The letter of a byte that no text holds: as no merge has it, many words between such letters are merged at once.
        mark = MARK.decode("latin-1").translate(self.letters)
        self.mark = model["vocab"].get(mark)
        merged = any(mark in letter for merge in model["merges"] for letter in merge)
        self.step = 1 if merged or self.mark is None or any(map(model.get, WORD_SETTINGS)) else MERGED_WORDS

    def of(self, words: list[bytes]) -> list[bytes]:
        """The ids of some different words."""
        found = list(map(self.newer.get, words))
        missing = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            found[k] = self.older.get(words[k])
            if found[k] is None:
                missing.append(k)
            else:
                self.newer[words[k]] = found[k]
        for a in range(0, len(missing), self.step):
            some = missing[a:a + self.step]
            for k, ids in zip(some, self.merged([words[k] for k in some]), strict=True):
                found[k] = self.newer[words[k]] = ids
        if len(self.newer) >= CACHED_PIECES:
            self.older, self.newer = self.newer, {}
        return found

    def merged(self, words: list[bytes]) -> list[bytes]:
        # The byte alphabet of the file: what its word splitter hands to the model.
        spelled = MARK.join(words).decode("latin-1").translate(self.letters)
        ids = np.array([token.id for token in self.model.tokenize(spelled)], "<u4")
        if len(words) == 1:
            return [ids.tobytes()]
        ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
        data, starts = ids.tobytes(), [0, *(end + 1 for end in ends[:-1])]
        return [data[4 * a:4 * b] for a, b in zip(starts, ends, strict=True)]


class TextEncoder:
    """The library's ids of whole texts, word by word where words are certain to be cut alike."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self.tokenizer, spec)

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and how many each has."""
        whole = {}  # ids of texts that are not cut into words
        for k, text in enumerate(t.decode() for t in texts):
            if not PLAIN.fullmatch(text) or any(s in text for s in self.special):
                whole[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        data = b"".join(b"" if k in whole else text for k, text in enumerate(texts))
        first = starts_of(np.array([0 if k in whole else len(text) for k, text in enumerate(texts)], np.int64))
        starts = word_starts(np.frombuffer(data, np.uint8), first[:-1])
        offsets = np.append(starts, len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        words = words.dictionary_encode()
        found = self.pieces.of(words.dictionary.to_pylist())
        # Next to the words: the texts that are not cut, in their places, and the end of each text.
        number = {k: len(found) + n for n, k in enumerate(whole)}
        found += [*whole.values(), struct.pack("<I", end)]
        ends = np.searchsorted(starts, first[1:])
        places = np.concatenate([ends[list(whole)], ends])
        more = np.concatenate([np.fromiter(number.values(), np.int64, len(number)), np.full(len(ends), len(found) - 1)])
        order = np.argsort(np.concatenate([2 * np.array(list(whole), np.int64), 2 * np.arange(len(ends)) + 1]))
        which = np.insert(words.indices.to_numpy().astype(np.int64), places[order], more[order])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        taken = sizes[which]
        stops = np.cumsum(taken)
        shift = (np.cumsum(sizes) - sizes)[which] - (stops - taken)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(shift, taken) + np.arange(taken.sum())]
        return ids, np.diff(stops[which == len(found) - 1], prepend=0)


@lru_cache(maxsize=1)
def encoder_of(spec: str) -> TextEncoder:
    """A worker's encoder: its next task draws on the words of the tasks before."""
    return TextEncoder(spec)


def write_files(docs: DataFrame, path: str, folder: str) -> list[tuple[str, int, int]]:
    """Encode all documents into files below ``folder``; (file, documents, ids) in order."""
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    size = Tokenizer.from_str(spec.value).get_vocab_size()
    files = max(1, -(-text_bytes(docs) // FILE_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{TaskContext.get().partitionId():08d}.tids"
        encoder, out, n = encoder_of(spec.value), None, 0
        for rows in by_chunk(batches, CHUNK_BYTES):
            out = out or Writer(name, size)
            ids, lengths = encoder.encode([r[1] or b"" for r in rows], END_ID)
            out.add([r[0] for r in rows], lengths, ids)
            n += len(rows)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([n], pa.int64()), pa.array([out.n], pa.int64())], ["file", "docs", "ids"]
            )

    # The hash lets rows of one doc_id lie in several files; the text decides among equal hashes.
    tie = F.xxhash64("text")
    ordered = id_and_bytes(docs).repartitionByRange(files, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    found = ordered.mapInArrow(write, "file string, docs long, ids long").collect()
    return sorted((r["file"], r["docs"], r["ids"]) for r in found)


def read_files(spark: SparkSession, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start and ids (little-endian 32-bit numbers as one binary) of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = Reader(name)
                firsts = file.firsts
                a = 0
                while a < len(file.doc_ids):
                    # Whole documents of about a million ids at a time.
                    b = max(a + 1, int(np.searchsorted(firsts, firsts[a] + (1 << 20), "right")) - 1)
                    b = min(b, len(file.doc_ids))
                    ids = file.ids(int(firsts[a]), int(firsts[b]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[a:b], pa.int64()),
                            pa.array(base + firsts[a:b], pa.int64()),
                            pa.BinaryArray.from_buffers(
                                pa.binary(), b - a,
                                [None, pa.py_buffer((4 * (firsts[a:b + 1] - firsts[a])).astype(np.int32)),
                                 pa.py_buffer(ids.astype("<u4"))],
                            ),
                        ],
                        ["doc_id", "start", "ids"],
                    )
                    a = b

    bases = np.cumsum([0, *(n for _, _, n in files)]).tolist()
    rows = [(name, base) for (name, _, _), base in zip(files, bases, strict=False)]
    listed = spark.createDataFrame(rows, "file string, base long").repartition(max(1, len(rows)))
    return listed.mapInArrow(read, "doc_id long, start long, ids binary")


def op7_token_files(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents, read the files back, and describe what they hold."""
    spark = docs.sparkSession
    files = write_files(docs, path, shared_folder(spark, "token-files"))
    return read_files(spark, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
