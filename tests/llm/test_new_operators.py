"""Hard negatives, suffix-array dedup and fill-in-the-middle against plain Python, on tables with all the odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillstream.llm import arrays, fim, hard_negatives, oracles, suffix_dedup
from tillstream.llm.suffix_array import common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA)
    if extra:
        names = "n form output prefix_chars ids kept shard place n_bytes n_removed score block"
        df = df.selectExpr("*", *(f"'mine' AS {name}" for name in names.split()))
    return df


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# Fill-in-the-middle

FIM_TEXTS = [
    None, "", " ", "word", "  two words ", "a\tb\n\nc \x0b\x0c\r d", "x <P> y", "<S>", "a<M>b", "< P> <", "ends in <",
    "ends in <M", "<S", "a\xa0b c\x1c d\x85e　f", "日本 語 テキスト 𝔘𝔫𝔦 é", "x" * 70_000, "word " * 30_000, " " * 50_000,
    "<P<S<M " * 40,
]


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(units) == text
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 80:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), sha(out), sha(text)


@pytest.mark.parametrize("extra", [False, True])
def test_fim_against_plain_python(spark, extra):
    rows = [(100 * k + j, t) for k, t in enumerate(FIM_TEXTS) for j in range(6)]
    rows += [(None, "a row without an id"), (7, "repeated row"), (7, "repeated row")]
    found = fim.op13_fim(documents(spark, rows, extra)).collect()
    order = lambda row: tuple((v is None, v) for v in row)
    assert sorted(map(tuple, found), key=order) == sorted((plain_fim(*row) for row in rows), key=order)
    forms = {row.form for row in found}
    assert forms == {"plain", "psm", "spm"}


def test_fim_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = {row.doc_id: plain_fim(row.doc_id, row.text) for row in docs.collect()}
    assert {row.doc_id: tuple(row) for row in fim.op13_fim(docs).collect()} == expected


def test_fim_settings_and_empty_table(spark):
    docs = documents(spark, [(1, "one two three"), (2, "four five")])
    assert {r.form for r in fim.fill_in_middle(docs, fim=100, spm=0).collect()} == {"psm"}
    assert {r.form for r in fim.fill_in_middle(docs, fim=100, spm=100).collect()} == {"spm"}
    assert fim.op13_fim(documents(spark, [])).collect() == []


# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score string, part string"


def plain_negatives(rows, scale=256, k=5):
    """The contract with whole sorted lists; equal (score, id) pairs of an anchor count once."""
    usable = []
    for i, vector, label in dict.fromkeys((r[0], None if r[1] is None else tuple(r[1]), r[2]) for r in rows):
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        whole = [math.floor(scale * x) for x in vector]
        if sum(float(x) ** 2 for x in whole) < 2.0**62:
            usable.append((i, int(label), whole))
    out = []
    for i, label, vector in (r for r in usable if r[0] % 100 == 0):
        scored = [(sum(a * b for a, b in zip(vector, other)), j, kind) for j, kind, other in usable]
        best = lambda found: sorted(set(found), key=lambda x: (-x[0], x[1]))[:k]
        for p, j in best((s, j) for s, j, kind in scored if kind == label and j != i):
            inside = ((s, n) for s, n, kind in scored if kind != label and 80 * p <= 100 * s <= 100 * p)
            out += [(i, j, rank, n, p, s) for rank, (s, n) in enumerate(best(inside), 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "mine", "mine") for row in rows], VECTORS)


def mined(spark, rows):
    return sorted(map(tuple, hard_negatives.op11_hard_negatives(vectors(spark, rows)).collect()))


def near_vectors(n, dim, seed, labels=10):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.2) for _ in range(dim)] for _ in range(4)]
    return [
        (i, [x + rnd.gauss(0, 0.1) for x in rnd.choice(centres)], rnd.randrange(labels)) for i in range(n)
    ]


def test_hard_negatives_against_plain_python(spark):
    rows = near_vectors(700, 12, 1)
    rows += [(900 + i, rows[0][1], i % 3) for i in range(250)]  # a hot vector
    rows += [rows[100], rows[100], (100, rows[101][1], 3), (200, rows[200][1], -7), (-700, rows[5][1], -1)]
    rows += [(1300, None, 1), (1301, rows[1][1], None), (None, rows[1][1], 1), (1400, [0.1, None], 1),
             (1500, [math.nan, 1.0], 2), (1600, [math.inf], 2), (1700, [], 2), (1701, [], 3), (1800, [0.5, -0.5], 2),
             (1900, [0.3] * 40, 2), (1901, [3e38, 1.0], 2), (2000, [3e6, -2e6, 1e6], 1), (2001, [3e6, -2e6, 2e6], 1),
             (2002, [3e6, -2e6, 1.5e6], 2), (2003, [3e6, -2e6, 0.5], 2)]
    found = mined(spark, rows)
    assert found == plain_negatives(rows) and len(found) > 100


def test_hard_negatives_in_many_cells_and_stripes(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "STRIPE_BYTES", 400)
    monkeypatch.setattr(hard_negatives, "CELL_BYTES", 3_000)
    monkeypatch.setattr(hard_negatives, "FAN_IN", 3)
    rows = near_vectors(900, 10, 2, labels=3)
    df = vectors(spark, rows).repartition(16)
    found = sorted(map(tuple, hard_negatives.op11_hard_negatives(df).collect()))
    assert found == plain_negatives(rows) and found


def test_hard_negatives_of_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.1], 1)]) == [] and mined(spark, [(100, [0.1], 1)]) == []
    assert mined(spark, [(100, None, 1), (101, None, 2)]) == []


def test_packed_scores_are_exact():
    rnd = np.random.default_rng(3)
    for size in (1, 3, 200, 40_000, 2**20, 2**26):
        for dim in (0, 1, 64):
            a, b = rnd.integers(-size, size + 1, (7, dim)), rnd.integers(-size, size + 1, (301, dim))
            found = np.concatenate([s for _, s in hard_negatives.Packed(a, b).parts()], axis=1)
            assert (found == a @ b.T).all()
    assert hard_negatives.Packed(a[:, :1] // 2**20, b[:, :1] // 2**20).fields > 2


def test_hard_negatives_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    found = con.sql(oracles.registry()["op11_hard_negatives"])
    got = hard_negatives.op11_hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    assert sorted(map(tuple, got.select(*found.columns).collect())) == sorted(found.fetchall())


# Suffix arrays and repeated strings


def test_suffix_arrays_against_sorting():
    rnd = random.Random(4)
    for _ in range(300):
        size = rnd.choice([1, 2, 3, 5, 200])
        text = np.array([rnd.randrange(size) for _ in range(rnd.randrange(80))], np.uint16)
        assert suffix_array(text, size).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    text = np.array([1 + i % 7 for i in range(5_000)] + [1] * 3_000, np.int32)
    assert suffix_array(text, 8).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_suffix_arrays_of_runs():
    rnd = random.Random(10)
    for _ in range(200):
        text = np.array([c for _ in range(30) for c in [rnd.randrange(3)] * rnd.randrange(12)], np.uint16)
        assert suffix_array(text, 3).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    text = np.repeat(np.array([70_000, 5, 70_000, 69_999, 5], np.int32), 40)
    assert suffix_array(text, 70_001).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_common_prefixes_against_comparing():
    rnd = random.Random(5)
    whole = "".join(rnd.choice("ab") for _ in range(300))
    text = np.frombuffer("\0".join([whole, whole[20:90], whole[100:250], whole[:50] + "x" * 50, ""]).encode(), np.uint8)
    suffixes = suffix_array(text.astype(np.uint16), 256)
    ends = np.flatnonzero(text == 0)
    asked = ends[np.searchsorted(ends, np.arange(len(text))).clip(max=len(ends) - 1)] - np.arange(len(text)) >= 30
    found = common_prefixes(text, suffixes, asked, 30)
    for before, here in zip(suffixes[:-1], suffixes[1:]):
        a, b = bytes(text[before:]), bytes(text[here:])
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert found[here] == (min(30, shared) if asked[here] else 0)


def plain_dedup(rows):
    """Every string of 100 bytes in a dictionary with its first place."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        for k in range(len(text) - 99):
            here = (*order(i), k)
            first[text[k:k + 100]] = min(first.get(text[k:k + 100], here), here)
    out = []
    for i, text in rows:
        lost = np.zeros(len(text) + 1, bool)
        for k in range(len(text) - 99):
            if first[text[k:k + 100]] < (*order(i), k):
                lost[k:k + 100] = True
        spans = int((lost[1:] & ~lost[:-1]).sum() + (len(text) > 0 and lost[0]))
        kept = bytes(b for b, gone in zip(text, lost) if not gone)
        out.append((i, len(text), int(lost.sum()), spans, sha(kept)))
    return sorted(out, key=lambda r: (*order(r[0]), r[1:]))


def found_dedup(df, **options):
    found = suffix_dedup.dedup_substrings(df, **options).collect()
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in found]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def repeating_texts():
    rnd = random.Random(6)
    words = lambda n: " ".join(rnd.choice("alpha beta gamma délta epsilon 日本 zeta").strip() + str(rnd.randrange(99))
                               for _ in range(n))
    passage, other = words(60), words(25)
    texts = [words(rnd.randrange(120)) + passage[rnd.randrange(30):rnd.randrange(100, 180)] + words(rnd.randrange(80))
             for _ in range(40)]
    texts += [None, "", "short", passage, passage, passage[:100], passage[:99], passage + passage, other * 3,
              "a" * 99, "a" * 100, "a" * 101, "a" * 5_000, "ab" * 900, "abc" * 35, "x" + "abcdefg" * 40, " " * 400,
              "a" * 300 + passage + "a" * 300, words(400) + other + words(5) + other, "\n".join([other] * 5),
              "".join(rnd.choice("ab") for _ in range(104)), "0123456789" * 10 + "0123456789"[:3]]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    rows += [(None, passage), (None, "tail " + passage), (7, texts[7]), (7, texts[7]), (7, texts[8][5:]), (-5, other)]
    return rows


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("hot", [2_000, 3])
def test_dedup_against_plain_python(spark, extra, hot):
    rows = repeating_texts()
    found = found_dedup(documents(spark, rows, extra).repartition(7), hot=hot)
    assert found == plain_dedup(rows)
    assert sum(r[2] for r in found) > 5_000


def test_dedup_of_long_texts_in_segments(spark, monkeypatch):
    """Segments and pieces are cut by the driver's own functions here."""
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 700)
    rows = [(i, (t or "").encode()) for i, t in repeating_texts()]
    for chunk in (rows, rows[::-1]):
        for segment in suffix_dedup.segments(chunk):
            assert len(segment.text) <= 50_000
            keys, places, count = segment.pieces()
            row, start = segment.where(places)
            for r, s, n, p in zip(row, start, count, places):
                assert chunk[r][1][s:s + n + 99] == segment.raw[p:p + n + 99] and len(chunk[r][1]) >= s + n + 99
        total = sum(int(s.pieces()[2].sum()) for s in suffix_dedup.segments(chunk))
        assert total == sum(max(0, len(t) - 99) for _, t in chunk)


class EveryPiece:
    """Sends all pieces to the shards, also those that occur once."""

    def pieces(self, segment):
        return segment.pieces()


def dedup_in_this_process(rows, folder, shards):
    """The steps after the counting, by the driver's own functions; rows go in three chunks."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    chunks = [rows[k::3] for k in range(3)]
    sent = [b for c in chunks for s in suffix_dedup.segments(c) for b in suffix_dedup.sent(c, s, EveryPiece(), shards)]
    table = pa.Table.from_batches(sent)
    at = np.array(table["shard"].to_pylist())
    for shard in np.unique(at):
        suffix_dedup.build(table.filter(pa.array(at == shard)), str(folder))
    marks = suffix_dedup.Marks(str(folder), shards)
    found = [r for c in chunks for r in suffix_dedup.cut_rows(c, EveryPiece(), marks).to_pylist()]
    rows = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(r["kept"])) for r in found]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("part", [2 << 20, 900])
def test_dedup_sorts_whole_keys_in_parts(tmp_path, monkeypatch, part):
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", part)
    rows = repeating_texts()
    assert dedup_in_this_process(rows, tmp_path, 3) == plain_dedup(rows)


def test_dedup_sorts_pieces_that_can_share_a_string_only(tmp_path, monkeypatch):
    """Copies of whole texts are told by their pieces; a text that repeats itself and half copies are sorted."""
    lengths, marked = [], suffix_dedup.marked
    monkeypatch.setattr(suffix_dedup, "marked", lambda text, *more: lengths.append(len(text)) or marked(text, *more))
    rnd = random.Random(8)
    texts = [" ".join(str(rnd.random()) for _ in range(60)) for _ in range(20)]
    copies = [(100 * k + j, t) for k, t in enumerate(texts) for j in range(4)]
    (tmp_path / "copies").mkdir()
    assert dedup_in_this_process(copies, tmp_path / "copies", 2) == plain_dedup(copies)
    assert sum(lengths) == 0
    rows = [*copies, (5, texts[3][:400] + "end"), (6, "start" + texts[4][500:]), (7, texts[0][:200] * 2), (8, "z" * 700)]
    assert dedup_in_this_process(rows, tmp_path, 2) == plain_dedup(rows)
    assert 0 < sum(lengths) < 10_000 < sum(map(len, texts))


def test_dedup_opens_a_shard_once_in_a_task(tmp_path, monkeypatch):
    opened, mapped = [], arrays.mapped
    monkeypatch.setattr(arrays, "mapped", lambda path, kind: opened.append(path) or mapped(path, kind))
    rnd = random.Random(9)
    rows = [(i, " ".join(str(rnd.random()) for _ in range(400))) for i in range(30)]
    rows += [(100 + i, text) for i, text in rows]
    assert dedup_in_this_process(rows, tmp_path, 600) == plain_dedup(rows)
    assert 256 < len(opened) <= 600


def test_dedup_shards_grow_with_the_input():
    """Every chunk looks into every shard: twelve times the input has not twelve times the shards."""
    sizes = [suffix_dedup.shards_for(n) for n in (0, 100 << 20, 1 << 30, 12 << 30, 60 << 30)]
    assert sizes == [1, 13, 128, 384, 1920]


def test_dedup_of_a_very_long_text(spark):
    rnd = random.Random(7)
    line = " ".join(str(rnd.random()) for _ in range(60))
    long = " ".join(str(rnd.random()) for _ in range(200_000))
    rows = [(1, long[:4_000_000]), (2, line + long[3_145_628:3_145_828] + line), (3, "y" * 400_000)]
    found = {r.doc_id: r for r in suffix_dedup.dedup_substrings(documents(spark, rows)).collect()}
    assert found[1].n_removed == 0
    assert (found[2].n_removed, found[2].n_spans) == (200 + len(line), 1)
    assert found[3].n_removed == 399_999 and bytes(found[3].kept) == b"y"


def test_dedup_of_the_documents_and_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = suffix_dedup.op12_suffix_dedup(docs).collect()
    assert sorted(map(tuple, found)) == plain_dedup([(r.doc_id, r.text) for r in docs.collect()])
    assert suffix_dedup.op12_suffix_dedup(documents(spark, [])).collect() == []
