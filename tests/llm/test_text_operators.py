"""The numbered operators against plain Python, on small tables with all the odd rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tillstream.llm import (
    arrays, bpe, decontaminate, language, line_dedup, ngram_join, ngram_lm, oracles, quality, secret_scan, token_files,
    toxicity,
)
from tillstream.llm import words as words_of
from tillstream.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
BASE = " ".join(f"word{i}" for i in range(40))
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, "   \n\t\n", None, None),
    (4, "short", "en", None),
    (5, BASE, "en", "a"),
    (6, BASE.upper(), "en", "a"),
    (7, BASE + " and a tail", "de", "b"),
    (8, "A line that many hold\nown line of eight\n  a LINE that many hold \nx", "en", "a"),
    (9, "a line that many hold\nA line that many hold", "en", "b"),
    (10, "éÉ ßeta Σίγμας İstanbul naïve ﬁné 日本語テキスト 12345 'S don't I'LL", "fr", "b"),
    (11, "x" * 50_000 + " " + "ab12" * 2_000, "en", "c"),
    (12, "the same five words again the same five words again " * 6, "en", "c"),
    (13, "<|startoftext|>Hi<|endoftext|> there \x1c\x85 　 end\x00 \x0b\x0c\r\n", "en", "c"),
    (14, "### &&& *** $$$ %%% | < > " * 5, "en", "c"),
    (15, "Einen schönen Tag wünsche ich allen Leuten hier und überall auf der Welt", "de", "c"),
    (15, "Einen schönen Tag wünsche ich allen Leuten hier und überall auf der Welt", "de", "c"),
    (None, "a row without an id that says a few more words than ten of them", "en", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*row, len(row[1] or "")) for row in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def clashing(odd):
    """Columns named like those that operators add."""
    names = "n_lines n_dropped n_words kept base_failed ids decoded score n shared prefix _words _lang features component"
    return odd.selectExpr("*", *(f"'mine' AS {name}" for name in names.split()))


def key(row):
    return tuple((v is not None, v) for v in row)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=key)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def words(text):
    return text.encode().lower().split()


# Quality rules


def duck(df, sql):
    documents = df.toPandas()  # noqa: F841  read by the SQL
    found = duckdb.sql(sql)
    return sorted(found.fetchall(), key=key), found.columns


@pytest.mark.parametrize("table", ["odd", "docs", "empty"])
def test_quality_against_sql(request, table):
    df = request.getfixturevalue(table)
    want, columns = duck(df, oracles.registry()["op2_quality_rules"])
    assert rows(quality.op2_quality_rules(df), *columns) == want


def test_quality_thresholds_follow_the_group(spark):
    plain = [(i, " ".join(f"w{i:03}x{k:02}" for k in range(60)), "en", "a") for i in range(150)]
    tagged = [(200 + i, " ".join(f"w{i:03}y{k:02} #" for k in range(60)), "en", "b") for i in range(150)]
    odd_one = [(999, " ".join(f"w999z{k:02} #" for k in range(60)), "en", "a")]
    df = spark.createDataFrame(plain + tagged + odd_one, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.op2_quality_rules(df).collect()}
    assert not kept[999] and all(kept[i] for i in range(150)) and all(kept[200 + i] for i in range(150))


def test_quality_without_ceilings(spark):
    """Groups that are uneven or unusual by nature stay, their own outliers go; thresholds come from the sketches."""
    def text(i, letters, signs=0):
        return " ".join(f"{i:04}{k:02}".ljust(letters, "x") + " #" * (signs > k % 4) for k in range(40))

    rows = [(i, text(i, 5 + i % 3), "en", "a") for i in range(150)]
    rows += [(1000 + i, text(1000 + i, 80 + i % 60), "ja", "a") for i in range(150)]  # no blanks between words
    rows += [(2000 + i, text(2000 + i, 6, i % 5), "en", "tables") for i in range(150)]  # some rows full of signs
    rows += [(3000 + i, text(3000 + i, 30), "fi", "a") for i in range(5)]  # too few to have thresholds of their own
    bad = [(5000, text(5000, 40), "en", "a"), (5001, text(5001, 400), "ja", "a"), (5002, "# # # # # # # # " * 9, "en", "a")]
    df = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.op2_quality_rules(df).collect()}
    assert {i for i, k in kept.items() if not k} == {5000, 5001, 5002}


def test_quality_carries_columns(clashing):
    out = quality.judge(clashing)
    assert out.columns.count("kept") == 1 and "ids" in out.columns and out.count() == len(ODD)


# Language


def test_language(docs, odd, empty):
    out = language.op3_language_id(docs).toPandas().merge(docs.toPandas()[["doc_id", "lang"]], on="doc_id")
    held = out[out["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert out["score"].between(0, 1).all() and len(out) == docs.count()
    assert (out["held_out"] == out["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    out = {r["doc_id"]: r for r in language.op3_language_id(odd).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3, 14)] == ["und"] * 4 and out[1]["score"] == 0
    assert language.op3_language_id(empty).count() == 0


def test_language_probabilities(spark):
    train = spark.createDataFrame([(1, "ab ab", "x"), (2, "cd cd cd", "y")], "doc_id long, text string, lang string")
    langs, matrix = language.train(train)
    assert langs == ["x", "y"]

    def grams(text):
        padded = " " + text + " "
        return [padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)]

    x, y, query = (Counter(grams(t)) for t in ("ab ab", "cd cd cd", "ab d"))
    logs = [
        sum(n * np.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * language.FEATURES)) for g, n in query.items()) for c in (x, y)
    ]
    asked = spark.createDataFrame([(7, "AB, d!")], "doc_id long, text string")
    got = language.predict(asked, langs, matrix).first()
    assert got["lang_pred"] == "x" and got["score"] == pytest.approx(1 / (1 + np.exp(logs[1] - logs[0])), rel=1e-4)


# Near duplicates


def brute_components(pairs):
    sets = {}
    for doc_id, text in pairs:
        w = words(text)
        sets[doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            index[x].add(i)
    for i, s in sets.items():
        for j in set().union(*(index[x] for x in s)) if s else ():
            both = len(s & sets[j])
            if i < j and 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, families, members, length):
    """Families of texts with a few words changed, a passage that all share, exact copies and chains."""
    rng = np.random.default_rng(seed)
    shared = " ".join(f"common{i}" for i in range(30))
    out = []
    for f in range(families):
        text = [f"f{f}w{i}" for i in range(length)]
        for _ in range(members):
            text = list(text) if rng.random() < 0.4 else [f"f{f}w{i}" for i in range(length)]
            for at in rng.integers(0, length, rng.integers(0, max(2, length // 25))):
                text[at] = f"new{rng.integers(1 << 30)}"
            body = " ".join(text)
            out.append(body + " " + shared if rng.random() < 0.5 else body)
            if rng.random() < 0.2:
                out.append(out[-1].upper())
    return list(enumerate(out, 1))


@pytest.mark.parametrize("seed,length", [(1, 60), (2, 25), (3, 200)])
def test_ngram_join_against_brute_force(spark, seed, length):
    data = near_copies(seed, 8, 12, length)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.op5_ngram_join(df).collect()}
    assert got == brute_components(data)


def test_ngram_join_cuts_large_clusters(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "UNIT_COST", 20_000)
    data = near_copies(5, 2, 40, 80)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.op5_ngram_join(df).collect()}
    assert got == brute_components(data)


def test_ngram_join_odd_rows(odd, empty, clashing):
    got = rows(ngram_join.op5_ngram_join(odd), "doc_id", "n_shingles", "component_id")
    want = brute_components([(i, t) for i, t in texts(odd) if i is not None])
    assert [r for r in got if r[0] is not None] == sorted((i, *want[i]) for i, *_ in ODD if i is not None)
    assert [r for r in got if r[0] is None] == [(None, 11, None)]
    assert ngram_join.op5_ngram_join(empty).count() == 0
    assert rows(ngram_join.op5_ngram_join(clashing), "doc_id", "n_shingles", "component_id") == got


@pytest.mark.parametrize("bits", [6, 34])
def test_ngram_join_with_shared_count_keys(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "counted_bits", lambda n: bits)
    data = near_copies(7, 6, 10, 50)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.op5_ngram_join(df).collect()}
    assert got == brute_components(data)


def test_ngram_join_sends_few_bytes_for_a_shingle():
    keys = np.random.default_rng(4).integers(0, 1 << 64, 300_000, np.uint64)
    bits = ngram_join.counted_bits(len(keys))
    sent = arrays.blocks(ngram_join.first_bits(keys, bits), 1)
    # 12 bytes before: 8 of the key and 4 of the count.
    assert sum(len(b.column(1)[0].as_py()) + len(b.column(2)[0].as_py()) for b in sent) < 6 * len(keys)


def test_tree_finds_all_partners():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, rng.integers(3, 30))).astype(np.uint64) for _ in range(200)]
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.Tree(sets, sizes)
    for k, x in enumerate(sets):
        own = int(tree.rank[k])
        got = {int(tree.order[r]) for r in tree.partners(x, len(x), np.arange(len(sets)), own, -1)}
        want = {
            j for j, y in enumerate(sets)
            if j != k and 100 * len(b := set(x.tolist()) & set(y.tolist())) >= 75 * (len(x) + len(y) - len(b))
        }
        assert got == want


# BPE


def test_bpe_against_the_library(docs, odd, empty):
    library = Tokenizer.from_file(WORD_BPE)
    for df in (docs, odd):
        want = []
        for doc_id, text in texts(df):
            ids = library.encode(text, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
        got = rows(bpe.op6_bpe(df, WORD_BPE), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
        assert got == sorted(want, key=key)
    assert bpe.op6_bpe(empty, WORD_BPE).count() == 0


def test_bpe_words_speculation_equals_merging():
    codec = bpe.Codec(WORD_BPE)
    rng = np.random.default_rng(0)
    alphabet = list("abcdeghinorstu") + ["th", "ing", "er", "é", "日", "!", "??", "0"]
    random_words = ["".join(rng.choice(alphabet, rng.integers(1, 12))) for _ in range(20_000)]
    got, exact = codec.encode_words(random_words)
    for word, ids in zip(random_words, got, strict=True):
        raw = list(word.encode())
        raw[-1] += bpe.FINAL
        assert list(ids) == codec.merged(tuple(raw))
    assert 0 < exact < len(random_words)  # some cuts were wrong, and most were not


def test_bpe_decode(spark):
    df = spark.createDataFrame([(1, [320, 1125]), (2, []), (3, None)], "doc_id long, ids array<int>")
    library = Tokenizer.from_file(WORD_BPE)
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(df, WORD_BPE).collect()}
    assert got == {1: library.decode([320, 1125], skip_special_tokens=False), 2: "", 3: None}


def test_bpe_query_decodes_the_ids(spark, monkeypatch, sf_dir):
    wrong = lambda docs, path: docs.selectExpr("doc_id", "array(320, 1125) AS ids", "'other' AS decoded")
    monkeypatch.setattr(bpe, "encode", wrong)
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    text = Tokenizer.from_file(WORD_BPE).decode([320, 1125], skip_special_tokens=False)
    want = {hashlib.sha256(text.encode()).hexdigest()}
    assert {r["decoded_sha256"] for r in bpe.op6_bpe(df, WORD_BPE).collect()} == want
    assert {r["decoded_sha256"] for r in corpus_pipeline.token_ids(spark, df, sf_dir).collect()} == want


def test_bpe_decode_refuses_unknown_ids():
    with pytest.raises(IndexError):
        bpe.joined(pa.array([[0, -1]], pa.list_(pa.int32())), pa.array(["a", "b"], pa.large_string()))
    ids = pa.array([[0], None, [], [1, 0]], pa.list_(pa.int32())).slice(1)
    assert bpe.joined(ids, pa.array(["a", "b"], pa.large_string())).to_pylist() == [None, "", "b a"]


# Token files


@pytest.mark.parametrize("width", [1, 3, 8, 16, 17, 31, 32])
def test_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1000).astype(np.uint32)
    packed = np.frombuffer(token_files.pack(ids, width), np.uint8)
    assert len(packed) == -(-1000 * width // 8)
    assert (token_files.unpack(packed, 1000, width) == ids).all()


def test_token_files_against_the_library(docs, odd, empty, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 100_000)
    library = Tokenizer.from_file(BYTE_BPE)
    for df in (docs, odd):
        want, start = [], 0
        for doc_id, text in sorted(texts(df), key=lambda r: (r[0] is not None, r[0])):
            ids = [*library.encode(text, add_special_tokens=False).ids, 0]
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert rows(token_files.op7_token_files(df, BYTE_BPE), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(
            want, key=key
        )
    assert token_files.op7_token_files(empty, BYTE_BPE).count() == 0


def test_token_words_are_cut_as_by_the_pattern():
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ɏ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ɏ0-9]+|\s+(?!\S)|\s+")
    rng = np.random.default_rng(3)
    parts = [*"srtevlmd12!. \n\t'", "''", "'re", "'ll", "'s", "'ve", "é", "Ɏ", "  ", " '", " a"]
    data = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(20_000)]
    raw = [t.encode() for t in data]
    first = np.cumsum([0, *map(len, raw)])
    starts = token_files.word_starts(np.frombuffer(b"".join(raw), np.uint8), first[:-1])
    assert starts.tolist() == np.cumsum([0, *(len(w.encode()) for t in data for w in pattern.findall(t))])[:-1].tolist()


def test_token_words_go_to_the_model_together(monkeypatch):
    with open(BYTE_BPE, encoding="utf-8") as file:
        spec = file.read()
    encoder = token_files.encoder_of(spec)
    assert token_files.encoder_of(spec) is encoder
    calls, merged = [], encoder.pieces.merged
    monkeypatch.setattr(encoder.pieces, "merged", lambda words: calls.append(len(words)) or merged(words))
    rng = np.random.default_rng(4)
    data = [" ".join("".join(rng.choice([*"abcxyz'é"], 7)) for _ in range(300)) for _ in range(20)]
    data[3:5] = ["日本 <|endoftext|>", ""]
    library = Tokenizer.from_file(BYTE_BPE)
    want = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in data]
    for _ in range(2):
        ids, lengths = encoder.encode([t.encode() for t in data], 0)
        assert ids.tolist() == [i for w in want for i in w] and lengths.tolist() == [len(w) for w in want]
    assert sum(calls) > 3_000 and len(calls) < sum(calls) / 200


def test_token_file_random_access(tmp_path):
    path = str(tmp_path / "x.tids")
    ids = np.random.default_rng(1).integers(0, 50_257, 3 * token_files.BLOCK_IDS + 77).astype(np.uint32)
    writer = token_files.Writer(path, 50_257)
    writer.add([5, None], [100, 20_000], ids[:20_100])
    writer.add([9], [len(ids) - 20_100], ids[20_100:])
    writer.close()
    reader = token_files.Reader(path)
    assert reader.width == 16 and reader.doc_ids == [5, None, 9]
    for a, b in ((0, 1), (8191, 8193), (100, 20_100), (24_000, len(ids)), (7, 7)):
        assert (reader.ids(a, b) == ids[a:b]).all()


# Line dedup


@pytest.mark.parametrize("table", ["odd", "docs", "empty"])
def test_line_dedup_against_sql(request, table):
    df = request.getfixturevalue(table)
    df = df.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want, columns = duck(df, oracles.registry()["op9_line_dedup"])
    assert rows(line_dedup.op9_line_dedup(df), *columns) == want


def test_line_dedup_odd_rows(clashing, odd):
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(clashing).where("doc_id <> 15").collect()}
    assert out[8]["text"].startswith("A line") and out[8]["n_dropped"] == 0
    assert out[9]["text"] == "" and out[9]["n_dropped"] == 2 and out[1]["text"] is None and out[1]["n_lines"] == 1
    again = line_dedup.dedup_lines(odd).where("doc_id = 15").collect()
    assert [r["n_dropped"] for r in again] == [0, 0]  # one document, twice


def test_minimal_perfect_hash():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64), axis=0)
    hashes[:50, 0] = 7  # equal halves differ in the other half
    index, slot = line_dedup.build(hashes)
    assert sorted(slot.tolist()) == list(range(len(hashes)))
    index["prints"] = np.empty(len(hashes), np.uint64)
    index["prints"][slot] = hashes[:, 1]
    assert (line_dedup.probe(index, hashes) == slot).all()
    strangers = rng.integers(0, 1 << 63, (5_000, 2)).astype(np.uint64)
    assert (line_dedup.probe(index, strangers) == -1).all()


# Language model


def test_language_model_tokens_are_hashed_together(monkeypatch):
    rng = np.random.default_rng(5)
    parts = [*(bytes([b]) for b in b"aB\0 \n\x0b\r\x1c\x85"), "é ".encode(), b"x" * 8, b"y" * 57, b"z" * 70]
    rows = [(i, b"".join(rng.choice(np.array(parts, object), rng.integers(0, 12)))) for i in range(3_000)] + [(None, None)]
    calls, digest = [], ngram_lm.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(ngram_lm.xxhash, "xxh3_64_intdigest", lambda word: calls.append(len(word)) or digest(word))
    hashes, starts = ngram_lm.tokens(rows)
    want = [[*(t or b"").lower().split(), b""] for _, t in rows]
    assert starts.tolist() == np.cumsum([0, *map(len, want)]).tolist()
    flat = [w for t in want for w in t]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    assert min(calls) > ngram_lm.LONG_WORD  # short words are not hashed one by one


def kneser_ney(train, asked):
    """log10 scores by the formulas, with dictionaries."""
    bigrams, words_seen = Counter(), Counter()
    for text in train:
        t = [*words(text), b""]
        words_seen.update(t)
        bigrams.update(zip([None, *t], t, strict=False))
    before = Counter(w for _, w in bigrams)
    n, v = len(bigrams), len(words_seen)

    def discount(counts):
        k = [0, *(sum(c == i for c in counts.values()) for i in (1, 2, 3, 4))]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0
        d = [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0), i) if k[i] else 0 for i in (1, 2, 3)]
        return lambda c: d[min(c, 3) - 1] if c else 0

    dw, db = discount(before), discount(bigrams)
    spare = sum(dw(c) for c in before.values()) / n / (v + 1) or 1 / (n + 1) / (v + 1)
    context, spread = Counter(), Counter()
    for (u, _), c in bigrams.items():
        context[u] += c
        spread[u] += db(c)
    out = []
    for text in asked:
        t, total, base = [*words(text), b""], 0.0, 0.0
        for u, w in zip([None, *t], t, strict=False):
            low = (before[w] - dw(before[w])) / n + spare
            c = bigrams[u, w]
            p = (c - db(c) + spread[u] * low) / context[u] if context[u] else low
            p = p if spread[u] or not context[u] else (c + low) / (context[u] + 1)
            total += np.log10(p)
            base += np.log10((words_seen[w] + 0.1) / (sum(words_seen.values()) + 0.1 * (v + 1)))
        out.append((len(t), sum(w in words_seen for w in t), sum(words_seen.values()), base, total))
    return out


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_language_model_against_brute_force(request, table, monkeypatch):
    monkeypatch.setattr(arrays, "SHARD_KEYS", 10_000)
    monkeypatch.setattr(ngram_lm, "BLOCK", 3_000)
    df = request.getfixturevalue(table)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    data = sorted(texts(df), key=key)
    want = kneser_ney([t for i, t in data if not held(i)], [t for _, t in data])
    got = sorted((tuple(r) for r in ngram_lm.op10_ngram_lm(df).drop("perplexity").collect()), key=lambda r: (key(r[:1])))
    assert [r[:2] for r in got] == [(i, held(i)) for i, _ in data]
    assert np.allclose(np.array([r[2:] for r in got], float), np.array(want, float), rtol=1e-9)
    assert np.isfinite([r[-1] for r in got]).all()


def test_language_model_is_a_distribution(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "b c", "a b c d d", "c", "a"])], "doc_id long, text string")
    model = ngram_lm.train(df)
    n = len(model.words)
    for before in range(n + 1):
        p = 10 ** model.log10(np.arange(-1, n), np.full(n + 1, before))
        assert p.sum() == pytest.approx(1)


def test_language_model_without_training(spark, empty):
    df = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [r["score"] for r in ngram_lm.op10_ngram_lm(df).collect()] == [0.0]
    assert ngram_lm.op10_ngram_lm(empty).count() == 0


def trigram_scores(train, asked):
    """log10 scores of the trigram model by the formulas, with dictionaries."""
    trigrams = Counter()
    for text in train:
        t = [*words(text), b""]
        trigrams.update(zip([(None, None), (None, t[0]), *zip(t, t[1:], strict=False)], t, strict=False))
    pairs = Counter((u[1], w) for u, w in trigrams)
    before = Counter(w for _, w in pairs)
    n, v = len(pairs), len(before)

    def level(counts):
        k = [0, *(sum(c == i for c in counts.values()) for i in (1, 2, 3, 4))]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0
        d = [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0), i) if k[i] else 0 for i in (1, 2, 3)]
        cut = lambda c: d[min(c, 3) - 1] if c else 0
        return cut, sum(cut(c) for c in counts.values())

    def mixed(counts):
        cut, _ = level(counts)
        context, spread = Counter(), Counter()
        for (u, _), c in counts.items():
            context[u] += c
            spread[u] += cut(c)

        def probability(u, w, low):
            if not context[u]:
                return low
            if not spread[u]:
                return (counts[u, w] + low) / (context[u] + 1)
            return (counts[u, w] - cut(counts[u, w]) + spread[u] * low) / context[u]

        return probability

    cut, spare = level(before)
    spare = spare / n / (v + 1) or 1 / (n + 1) / (v + 1)
    by_pair, by_word = mixed(trigrams), mixed(pairs)
    out = []
    for text in asked:
        t, total = [*words(text), b""], 0.0
        for u, w in zip([(None, None), (None, t[0]), *zip(t, t[1:], strict=False)], t, strict=False):
            total += np.log10(by_pair(u, w, by_word(u[1], w, (before[w] - cut(before[w])) / n + spare)))
        out.append(total)
    return out


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_trigram_model_against_brute_force(request, table, monkeypatch):
    monkeypatch.setattr(arrays, "SHARD_KEYS", 10_000)
    monkeypatch.setattr(ngram_lm, "BLOCK", 3_000)
    df = request.getfixturevalue(table)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    data = sorted(texts(df), key=key)
    want = trigram_scores([t for i, t in data if not held(i)], [t for _, t in data])
    got = sorted((tuple(r) for r in ngram_lm.op10_ngram_lm(df, 3).select("doc_id", "score").collect()), key=key)
    assert [r[0] for r in got] == [i for i, _ in data]
    assert np.allclose([r[1] for r in got], want, rtol=1e-9)


def test_trigram_model_without_training(spark, empty):
    df = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [r["score"] for r in ngram_lm.op10_ngram_lm(df, 3).collect()] == [0.0]
    assert ngram_lm.op10_ngram_lm(empty, 3).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_files_are_small(spark, monkeypatch, tmp_path, order):
    folders = []

    def folder(_, name):
        folders.append(f"{tmp_path}/{name}")
        os.makedirs(folders[-1])
        return folders[-1]

    rng = np.random.default_rng(1)
    monkeypatch.setattr(ngram_lm, "BLOCK", 1_000)
    data = [(i, " ".join(f"w{w}" for w in rng.integers(0, 2_000, 400))) for i in range(100)]
    df = spark.createDataFrame([*data, (-1, "one more " * 1_000)], "doc_id long, text string")
    monkeypatch.setattr(arrays, "shared_folder", folder)
    model = ngram_lm.train(df, order)
    for level in model.levels:
        files = os.listdir(level.grams.folder)
        taken = sum(os.path.getsize(f"{level.grams.folder}/{f}") for f in files)
        assert taken < 5.5 * len(level.grams)  # 10 bytes before, as one count is over 255
    stats = [f"{f}/{n}" for f in folders if "stats" in f or "pairs" in f for n in os.listdir(f)]
    assert max(os.path.getsize(f) for f in stats) < 1_300


def test_shuffle_files_go_with_their_query(spark):
    name, session = arrays._CLEANUP, spark.newSession()
    assert session.conf.get(name, "false") == "false"
    with pytest.raises(ZeroDivisionError), arrays.shuffles_dropped(session):
        assert session.conf.get(name) == "true"
        1 / 0  # noqa: B018
    assert session.conf.get(name, "false") == "false"


@pytest.mark.parametrize("bits", [5, 32, 33, 38, 47, 64])
def test_narrow_keys_are_found(tmp_path, bits):
    rng = np.random.default_rng(bits)
    numbers = np.unique(rng.integers(0, 1 << bits, 20_000, np.uint64))
    keys = np.sort(words_of.mix_bits(numbers, bits))
    assert (np.sort(words_of.unmix_bits(keys, bits)) == numbers).all()
    counts = rng.integers(1, 300, len(keys))
    held = np.sort(rng.permutation(len(keys))[: len(keys) // 2 + 1])
    arrays.save_keys(f"{tmp_path}/0.keys", keys[held], bits)
    arrays.save_small(f"{tmp_path}/0.counts", counts[held])
    found = arrays.HashArrays(str(tmp_path), {0: len(held)}, 1, bits)
    for asked in (keys, keys[:3], keys[-1:], keys[:0]):
        place, count = found.find(asked)
        inside = np.isin(asked, keys[held])
        assert (place >= 0).tolist() == inside.tolist()
        assert (found.keys_at(place[inside]) == asked[inside]).all()
        assert (count == np.where(inside, counts[: len(keys)][np.searchsorted(keys, asked)], 0)).all()
    everything = found.shard(0).all()
    assert (everything[0] == keys[held]).all() and (everything[1] == counts[held]).all()


@pytest.mark.parametrize("values", [[0], [5], [0, 1, 1 << 63], [3 << 20, 5 << 20, 1 << 40], [(1 << 64) - 1]])
def test_packed_numbers_come_back(values):
    numbers = np.array(values, np.uint64)
    assert arrays.unpacked(arrays.packed(numbers)).tolist() == values
    small = np.array([v % 70_000 for v in values])
    assert arrays.unpacked_counts(arrays.packed_counts(small)).tolist() == small.tolist()


# Decontamination


QUESTION = "Anna Miller buys 12 apples for 3 dollars each and then sells 5 of them to her friend Peter on the market"


@pytest.fixture(scope="module")
def bench(spark):
    items = [
        (0, "Yesterday " + QUESTION), (1, "One two three four five six seven eight nine ten eleven twelve thirteen"), (2, None),
        (3, ""), (4, "tiny words only"), (5, "Mixed Numbers 1 2 3 4 5 6"),
    ]
    return spark.createDataFrame(items, "item_id long, text string")


def test_decontamination(spark, bench):
    other = QUESTION.replace("12", "30").replace("Anna", "Julia").replace("Peter", "Henry")
    data = [
        (1, f"Some words before. It says that {QUESTION} and goes on for some time"),
        (2, f"some words before. It says that yesterday {other} and goes on"),
        (3, "A clean text about apples that nobody sells to anyone on the market in town"),
        (4, "it has one two three four five six seven and then something else entirely"),
        (5, "as it was said: ONE TWO THREE FOUR, FIVE SIX SEVEN EIGHT NINE TEN ELEVEN TWELVE THIRTEEN!"),
        (6, None), (7, ""), (None, QUESTION), (1, QUESTION),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.contamination(df, bench).collect()
    by_doc = defaultdict(set)
    for r in found:
        by_doc[r["doc_id"]].add(r["item_id"])
    assert by_doc[1] == {0} and by_doc[2] == {0} and by_doc[5] == {1}
    assert not by_doc.keys() & {3, 6, 7} and 0 not in by_doc[4]
    assert next(r for r in found if r["doc_id"] == 2)["changed_slots"] == 2
    assert next(r for r in found if r["doc_id"] == 1)["changed_slots"] == 0
    left = sorted(r["doc_id"] or 0 for r in decontaminate.decontaminate(df, bench).collect())
    assert 3 in left and 1 not in left and 2 not in left and 0 in left


def test_decontamination_needs_consistent_slots(spark):
    item = "take 7 red balls and 7 blue balls then put 7 green balls into the box with 7 holes and 7 lids"
    mixed = "take 1 red balls and 2 blue balls then put 3 green balls into the box with 4 holes and 5 lids"
    same = item.replace("7", "9")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    df = spark.createDataFrame([(1, mixed), (2, same)], "doc_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contamination(df, bench).collect()} == {2}


def test_decontamination_blocks_and_empty(spark, bench, docs, empty, sf_dir, monkeypatch):
    full = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = rows(decontaminate.contamination(docs, full), "doc_id", "item_id", "matched_windows")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert rows(decontaminate.contamination(docs, full), "doc_id", "item_id", "matched_windows") == want
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_decontamination_against_plain_search(spark, docs, sf_dir):
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = set()
    for doc_id, text in texts(docs):
        w = words(text)
        held = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for item_id, q in items:
            own = [tuple(q[i:i + 5]) for i in range(len(q) - 4)]
            if sum(x in held for x in own) >= 0.75 * len(own):
                want.add((doc_id, item_id))
    full = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert set(rows(decontaminate.contamination(docs, full), "doc_id", "item_id")) == want


def found_pairs(spark, items, documents):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(documents)), "doc_id long, text string")
    return set(rows(decontaminate.contamination(df, bench), "doc_id", "item_id"))


def test_decontamination_finds_items_of_placeholders(spark):
    items = [
        "12 + 30 = 42", "3 km + 5 km = 8 km", "Anna Miller Peter Smith Carla Jones Henry Brown Julia Stone and Robert Field",
        "Anna Miller Peter and Carla Jones Henry met Julia Stone Robert and",
    ]
    renamed = items[3].replace("Henry", "Thomas").replace("Julia", "Sarah")
    documents = [f"as it was said before {item} and so on" for item in [*items, "13 + 31 = 44", renamed]]
    assert found_pairs(spark, items, documents) == {(0, 0), (1, 1), (2, 2), (3, 3), (5, 3)}


def test_decontamination_finds_parts_of_long_items(spark):
    item = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    question = "how many of the red boxes did the old driver leave at the last station of the line"
    items = [" ".join(item), " ".join(item[75:]) + " " + question]
    apart = " ".join(" ".join(item[k:k + 9]) + " and" for k in range(0, 60, 12))
    documents = ["it says " + " ".join(item[5:65]) + " there", f"she asked {question} yesterday", apart]
    assert found_pairs(spark, items, documents) == {(0, 0), (1, 1)}


def test_decontamination_reads_sentence_openers_both_ways(spark):
    item = "Anna has 12 apples. Anna gives 5 to Ben. Anna eats 2. How many apples are left?"
    asked = item.replace("Anna", "Julia")
    lower = item.replace(". How", ", how").replace("Anna", "Julia")
    assert found_pairs(spark, [item], [asked, f"a text says {asked}", lower]) == {(0, 0), (1, 0), (2, 0)}


def test_decontamination_votes_for_each_copy(spark):
    item = "take 12 red balls and 7 blue ones then 12 old men and 7 young men carry 12 boxes and 7 lids away"
    copies = [item.replace("12", str(a)).replace("7", str(b)) for a, b in ((20, 55), (20, 66), (41, 31), (73, 31))]
    mixed = "take 1 red balls and 2 blue ones then 3 old men and 4 young men carry 5 boxes and 6 lids away"
    found = decontaminate.contamination(
        spark.createDataFrame([(0, " \n".join([*copies, item])), (1, mixed)], "doc_id long, text string"),
        spark.createDataFrame([(0, item)], "item_id long, text string"),
    )
    assert rows(found, "doc_id", "matched_windows", "item_windows", "changed_slots") == [(0, 19, 19, 0)]


# Toxicity


def test_toxicity(spark, sf_dir, odd, empty):
    out = toxicity.op8_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = out[out["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() > 0.9 and out["score"].between(0, 1).all()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd, toxicity.train(odd, none)).collect()} == {toxicity.Classifier({}, -500.0).score(set())}
    assert toxicity.score(empty, toxicity.Classifier({"x": 1.0}, 0.0)).count() == 0


def test_toxicity_ignores_who_is_named():
    rng = np.random.default_rng(0)
    documents = []
    for _ in range(400):
        body = [f"w{i}" for i in rng.integers(0, 50, 12)]
        toxic = int(rng.random() < 0.4)
        body += ["idiot"] * toxic
        # Toxic sentences mostly name one group: the plain fit would learn the group.
        if rng.random() < (0.8 if toxic else 0.1):
            body.append("muslims")
        elif rng.random() < 0.3:
            body.append("believers")
        documents.append((sorted(set(body)), toxic))
    vocabulary = ["idiot", *(f"w{i}" for i in range(50))]
    fair = toxicity.fit(documents, vocabulary)
    factor = toxicity.COUNTERFACTUAL
    try:
        toxicity.COUNTERFACTUAL = 0.0
        plain = toxicity.fit(documents, vocabulary)
    finally:
        toxicity.COUNTERFACTUAL = factor
    assert plain.weights["muslims"] > 1 and abs(fair.weights.get("muslims", 0)) < 0.25 * plain.weights["muslims"]
    assert fair.score({"w1", "idiot"}) > 0.5 > fair.score({"w1", "muslims"})


# Secrets


def test_secret_scan(spark, empty, clashing):
    rng = np.random.default_rng(1)
    hexes = lambda: "".join(rng.choice(list("0123456789abcdef"), 40))
    data = []
    for i in range(120):
        data.append((i, f'some text here\ntoken = "{hexes()}" and the commit {hexes()} stays, as does averylongwordindeedhere'))
    data += [(900, None), (901, ""), (902, "é" * 20 + ' password: "Zm9vYmFyYmF6cXV4MTIzNDU2" end')]
    df = spark.createDataFrame([(*r, "repo/src") for r in data], "doc_id long, text string, source string")
    out = secret_scan.op4_secret_scan(df).toPandas()
    for doc_id, text in data:
        want = [m.start() for m in __import__("re").finditer(r"[A-Za-z0-9+/=_\-]{16,}", text or "")]
        assert sorted(out[out["doc_id"] == doc_id]["start"]) == want
    tokens = out[(out["start"] == 24) & (out["doc_id"] < 900)]
    assert tokens["is_secret"].all() and not out[(out["start"] > 24) & (out["doc_id"] < 900)]["is_secret"].any()
    assert secret_scan.op4_secret_scan(empty).count() == 0
    assert secret_scan.op4_secret_scan(clashing).count() >= 2


# Columns whose names the operators use themselves, for all of them


@pytest.mark.parametrize("name", ["op3", "op6", "op7", "op8", "op10", "contamination"])
def test_clashing_columns_change_nothing(odd, clashing, name, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    operator = {
        "op3": language.op3_language_id,
        "op6": lambda df: bpe.op6_bpe(df, WORD_BPE),
        "op7": lambda df: token_files.op7_token_files(df, BYTE_BPE),
        "op8": lambda df: toxicity.score(df, toxicity.train(df, none)),
        "op10": lambda df: ngram_lm.op10_ngram_lm(df, 3),
        "contamination": lambda df: decontaminate.contamination(df, items),
    }[name]
    plain = operator(odd)
    assert rows(operator(clashing), *plain.columns) == rows(plain)


# Components in several tasks, and one Python stage for ids and text


@pytest.mark.parametrize("most", [1_000_000, 7])
def test_components_against_a_search(spark, most):
    rnd = random.Random(most)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    near, want = defaultdict(set), {}
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in sorted(near):
        todo = [] if start in want else [start]
        while todo:
            node = todo.pop()
            if node not in want:
                want[node] = start
                todo += near[node]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(5), most)
    assert dict(map(tuple, found.collect())) == want
    assert components(spark.createDataFrame([], "a long, b long"), most).collect() == []


def test_ids_and_text_in_one_stage(odd, docs):
    for df in (odd, docs):
        once = bpe.encode_and_decode(df, WORD_BPE)
        twice = bpe.decode(bpe.encode(df, WORD_BPE), WORD_BPE)
        assert rows(once) == rows(twice)
        assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
