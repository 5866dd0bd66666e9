"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are runs of 16 or more letters, digits and + / = _ - in every whole text, signed tokens of three parts, and
values of six or more signs of any kind that are assigned to a secret's name (quoted or not) or follow ``Bearer``; these take
the place of runs they overlap. Each is described by its length, how probable its character transitions are in the
corpus, how much of it dictionary words cover, its kinds of characters and entropy, the path it comes from, and the words
next to it (whether they name or deny a secret, and their hashes in NEAR_BUCKETS counts). A random forest trained on
labelled findings gives the probability of a secret. Transitions and dictionary come from all documents; the dictionary holds
every word of 4 to 24 letters that DICTIONARY_DOCS documents have, as sorted hash arrays that the tasks map (``arrays``).

Labelled findings are an input (doc_id, start, label). Where there are none, ``context_labels`` takes evidence that is no
feature: a known key format, or the name and the sign that assign a value, make a secret; standing free in running
text or in a URL makes none; everything else stays unlabelled (letters only, a denying word, a name that is near but
assigns nothing, quoted without a name). The assigning name and signs are withheld from the features.

The forest is fitted to at most SAMPLE findings per label, those with the least hash; with one label only, all
scores are that label. Null and empty texts have no candidates; a repeated row has its own findings.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import arrays
from tillstream.llm.arrays import HashArrays, shared_folder
from tillstream.llm.components import written
from tillstream.llm.words import by_chunk, held_out, id_and_bytes, least_hashes, mix, starts_of, text_bytes

CHUNK_BYTES = 4 << 20
SHORTEST, LONGEST = 4, 24  # letters of a dictionary word
DICTIONARY_DOCS = 3
SAMPLE = 20_000
TREES, DEPTH = 20, 6
NEAR = 60  # bytes looked at on either side
NEAR_BUCKETS = 16
PRIME = np.uint64(0x100000001B3)
WORD = regex.compile(rb"(?<![\w\x80-\xff])[a-z\x80-\xff]{%d,%d}(?![\w\x80-\xff])" % (SHORTEST, LONGEST))
RUN = regex.compile(rb"eyJ[\w\-]{8,}\.[\w\-]{8,}\.[\w\-]*|[A-Za-z0-9+/=_\-]{16,}")

# Words that announce a secret, that deny one, parts of paths that hold no real ones, public key formats.
NAMES = rb"token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth(?!ors?\b)|credential|private[_-]?key"
NAMED = regex.compile(rb"(?i)(?:%s|bearer)" % NAMES)
DENIALS = regex.compile(rb"(?i)(example|sample|dummy|placeholder|test|fake|checksum|sha1|sha256|md5|commit|digest|uuid)")
PATHS = regex.compile(r"(?i)(test|example|sample|fixture|mock|doc|vendor|lock)")
FILLERS = regex.compile(rb"(?i)(change.?me|your|x{4}|\*{3}|\.{3}|\$\{|\{\{)")
FORMATS = regex.compile(
    rb"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[\w\-]{20}|npm_[A-Za-z0-9]{36}|AIza[\w\-]{35}|"
    rb"sk_live_[0-9A-Za-z]{24,}|xox[abprs]-[0-9A-Za-z\-]{10,}|eyJ[\w\-]{8,}\.[\w\-]{8,}\.[\w\-]*"
)
# A name, a sign, and the value; or the scheme word of a header and the value.
BOUND = regex.compile(
    rb"(?i)(?:%s)[\w\-]{0,40}[\"']?[ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}(?:(?:bearer|basic)[ \t]{1,3})?[\"'`]?"
    rb"(?P<value>[^\s\"'`<>]{6,})|\bbearer[ \t]{1,3}(?P<value>[\w.~+/=\-]{6,})" % NAMES
)
BOUND_HINTS = (b"token", b"secret", b"passw", b"pwd", b"key", b"auth", b"credential", b"bearer")
TRAILING = b",;.)]}"
FREE_BEFORE, FREE_AFTER = (frozenset(signs) for signs in (b" \t\n\r(", b" \t\n\r).,;!?"))
FEATURES = (
    "length", "transition", "dictionary", "digits", "upper", "hex", "changes", "entropy", "path_depth", "path_words",
    "named", "denied", *(f"near_{k}" for k in range(NEAR_BUCKETS)),
)
FOUND = "doc_id long, start long, candidate string, x array<double>, evidence int"


def transition_counts(docs: DataFrame) -> np.ndarray:
    """How often each pair of neighbouring ASCII characters occurs in the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 14, np.int64)
        for rows in by_chunk(batches, CHUNK_BYTES):
            data = np.frombuffer(b" ".join(r[1] or b"" for r in rows), np.uint8).astype(np.int64)
            pair = (data[:-1] << 7) + data[1:]
            total += np.bincount(pair[(data[:-1] < 128) & (data[1:] < 128)], minlength=1 << 14)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["pair", "n"])

    found = id_and_bytes(docs).mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.ones(1 << 14)
    out[found["pair"]] += found["n"]
    out = out.reshape(128, 128)
    return np.log2(out / out.sum(axis=1, keepdims=True))


def word_keys(words: list[bytes]) -> np.ndarray:
    """The key of each word, as ``substring_keys`` gives it to an equal piece of a candidate."""
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts, keys = starts_of(sizes)[:-1], sizes.astype(np.uint64)
    keys[:] = 0
    for k in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > k)
        keys[some] = keys[some] * PRIME + data[starts[some] + k] + np.uint64(1)
    return mix(keys)


def dictionary(docs: DataFrame) -> HashArrays:
    """The words of DICTIONARY_DOCS documents or more; a chunk's words are counted before the shuffle."""
    shards = arrays.shard_count(text_bytes(docs) // 6)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_chunk(batches, CHUNK_BYTES):
            words = [word for row in rows for word in set(WORD.findall((row[1] or b"").lower()))]
            yield from arrays.blocks(word_keys(words), shards)

    folder = shared_folder(docs.sparkSession, "dictionary")
    counted = id_and_bytes(docs).mapInArrow(count, arrays.BLOCKS)
    found = arrays.write_arrays(counted, folder, DICTIONARY_DOCS, lambda keys, counts: [], [])
    return HashArrays(folder, arrays.sizes_of(found), shards)


def covered(texts: list[bytes], words: HashArrays) -> list[float]:
    """Share of each text that the longest dictionary words cover from left to right; all texts are looked up together."""
    data = np.frombuffer(b"\0".join(text.lower() for text in texts) + b"\0", np.uint8)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    stops = np.flatnonzero(~letter)
    left = stops[np.searchsorted(stops, np.arange(len(data)))] - np.arange(len(data))  # letters in a row from here on
    longest, keys = np.zeros(len(data), np.int64), np.zeros(len(data), np.uint64)
    for size in range(1, LONGEST + 1):
        at = np.flatnonzero(left >= size)
        keys[at] = keys[at] * PRIME + data[at + size - 1] + np.uint64(1)
        if size >= SHORTEST and len(at):
            asked, back = np.unique(mix(keys[at]), return_inverse=True)
            longest[at[words.find(asked)[0][back] >= 0]] = size
    out, begin = [], 0
    for text in texts:
        size = len(text.lower())
        sizes, at, n = longest[begin:begin + size].tolist(), 0, 0
        while at < size:
            n += sizes[at]
            at += sizes[at] or 1
        out.append(n / max(1, size))
        begin += size + 1
    return out


def looks(text: bytes, transitions: np.ndarray) -> tuple[float, ...]:
    """What a candidate's own characters say, but for the dictionary."""
    codes = np.frombuffer(text, np.uint8).astype(np.int64)
    digit = (codes >= 48) & (codes <= 57)
    upper = (codes >= 65) & (codes <= 90)
    share = np.bincount(codes) / len(codes)
    share = share[share > 0]
    plain = np.minimum(codes, 127)
    return (
        float(len(codes)),
        float(transitions[plain[:-1], plain[1:]].mean()),
        float(digit.mean()),
        float(upper.mean()),
        float(regex.fullmatch(rb"[0-9a-fA-F]+", text) is not None),
        float((digit[1:] != digit[:-1]).mean()),
        float(-(share * np.log2(share)).sum()),
    )


def spans(text: bytes) -> list[tuple[int, int, int]]:
    """Begin and end of every candidate, and where the name and sign that assign it begin (-1 if none do)."""
    low, bound = text.lower(), []
    if any(hint in low for hint in BOUND_HINTS):
        for match in BOUND.finditer(text):
            a, b = match.span("value")
            b = a + len(text[a:b].rstrip(TRAILING))
            if b - a >= 6:
                bound.append((a, b, match.start()))
    out, k = [], 0
    for match in RUN.finditer(text):
        a, b = match.span()
        while k < len(bound) and bound[k][1] <= a:
            k += 1
        if k == len(bound) or bound[k][0] >= b:
            out.append((a, b, -1))
    return sorted(bound + out)


def evidence(text: bytes, a: int, b: int, name: int, near: bytes) -> int | None:
    """1: a secret, 0: none, by what is no feature; None: unsure."""
    value = text[a:b]
    if FORMATS.fullmatch(value):
        return 1
    if DENIALS.search(near) and name >= 0 or FILLERS.search(value):
        return None
    if name >= 0:
        return None if value.isalpha() else 1
    before = text[max(0, a - 200):a]
    if b"://" in before[max(before.rfind(b" "), before.rfind(b"\n")) + 1:] or b"://" in value:
        return 0
    free = (not a or text[a - 1] in FREE_BEFORE) and (b == len(text) or text[b] in FREE_AFTER)
    if free and before.rstrip()[-1:] not in (b"=", b":") and not NAMED.search(near):
        return 0
    return None


def findings(row: tuple) -> Iterator[tuple]:
    """doc_id, start, candidate, features of path and neighbouring words, evidence."""
    doc_id, text, path = row[0], row[1] or b"", row[2] or ""
    place = (float(path.count("/")), float(PATHS.search(path) is not None))
    at, chars = 0, 0
    for a, b, name in spans(text):
        # Offsets count characters: bytes that do not continue one.
        chars += len(text[at:a].decode())
        at = a
        # The words next to the candidate, without a name and sign that assign it: four before it, two after it.
        upto = a if name < 0 else name
        words = [*text[max(0, upto - NEAR):upto].split()[-4:], *text[b + 1:b + 1 + NEAR].split()[:2]]
        near = b" ".join(words)
        buckets = [0.0] * NEAR_BUCKETS
        for word in words:
            buckets[zlib.crc32(word.lower().strip(b".,;:!?\"'()")) % NEAR_BUCKETS] += 1.0
        flags = float(NAMED.search(near) is not None), float(DENIALS.search(near) is not None)
        yield doc_id, chars, text[a:b], (*place, *flags, *buckets), evidence(text, a, b, name, near)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start (characters), candidate, features x, and evidence."""
    sent, words = docs.sparkSession.sparkContext.broadcast(transition_counts(docs)), dictionary(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FOUND.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.int32())
        for rows in by_chunk(batches, CHUNK_BYTES):
            found = [finding for row in rows for finding in findings(row)]
            if not found:
                continue
            texts = list(dict.fromkeys(f[2] for f in found))
            own = {}
            for text, share in zip(texts, covered(texts, words), strict=True):
                length, transition, *kind = looks(text, sent.value)
                own[text] = (length, transition, share, *kind)
            out = [(d, start, text.decode(), [*own[text], *x], label) for d, start, text, x, label in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

    path = F.col("source") if "source" in docs.columns else F.lit(None)
    return id_and_bytes(docs, path.cast("string").alias("path")).mapInArrow(run, FOUND)


def context_labels(found: DataFrame) -> DataFrame:
    """(doc_id, start, label) by evidence that is no feature, null where unsure: for tables without labelled findings."""
    return found.select("doc_id", "start", F.col("evidence").alias("label"))


def with_scores(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """Candidates with the forest's score and is_secret; of several labels of a place the highest counts."""
    labels = labelled.where("label is not null").groupBy("doc_id", "start").agg(F.max("label").alias("label"))
    joined = found.join(labels, ["doc_id", "start"]).select("x", "label", "candidate", "doc_id", "start")
    few = [least_hashes(joined.where(F.col("label") == k), SAMPLE, "candidate", "doc_id", "start") for k in (0, 1)]
    sample = few[0].unionAll(few[1]).select(array_to_vector("x").alias("features"), F.col("label").cast("double")).persist()
    seen = [int(r["label"]) for r in sample.select("label").distinct().collect()]
    if len(seen) < 2:
        out = found.withColumn("score", F.lit(float(seen[0] if seen else 0)))
    else:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7).fit(sample)
        scored = forest.transform(found.withColumn("features", array_to_vector("x")))
        out = scored.withColumn("score", vector_to_array("probability")[1])
    sample.unpersist()
    return out.withColumn("is_secret", F.col("score") >= 0.5)


def op4_secret_scan(docs: DataFrame) -> DataFrame:
    """All candidates with their scores; the forest learns from the documents outside the held-out fold."""
    folder = shared_folder(docs.sparkSession, "secrets")
    found = written(candidates(docs), f"{folder}/candidates")
    scored = with_scores(found, context_labels(found.where(~held_out(5))))
    return scored.select(
        "doc_id", "start", F.length("candidate").alias("length"), F.sha2(F.col("candidate").cast("binary"), 256).alias("sha256"),
        held_out(5).alias("held_out"), "score", "is_secret",
    )
