"""The secret scan: features by plain Python, spans, evidence, and planted findings of several forms."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest

from tillstream.llm import secret_scan

SCHEMA = "doc_id long, text string, source string"
WORDS = "river stone garden window morning letter market bridge winter summer paper silver doctor teacher kitchen".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def value(rnd, signs, n):
    return "".join(rnd.choice(signs) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """(rows, secret values, harmless values): each document holds one secret in one of six forms and one harmless run."""
    rnd, rows, secrets, clean = random.Random(5), [], set(), set()
    hexes, letters = "0123456789abcdef", string.ascii_letters + string.digits
    for i in range(600):
        form = i % 6
        if form == 0:
            secret = value(rnd, hexes, 40)
            line = f'api_token = "{secret}"'
        elif form == 1:
            secret = value(rnd, letters, 32)
            line = f"SERVICE_TOKEN={secret}"
        elif form == 2:
            secret = value(rnd, letters, 30) + "." + value(rnd, letters, 12)
            line = f"Authorization: Bearer {secret}"
        elif form == 3:
            secret = value(rnd, letters, 6) + "!" + value(rnd, letters, 4) + "@" + value(rnd, string.digits, 3)
            line = f'password: "{secret}"'
        elif form == 4:
            secret = ".".join(["eyJ" + value(rnd, letters, 20), value(rnd, letters, 30), value(rnd, letters, 20)])
            line = f'"{secret}"'
        else:
            secret = "AKIA" + value(rnd, string.ascii_uppercase + string.digits, 16)
            line = f"see {secret} there"
        harmless = [
            f"commit {value(rnd, hexes, 40)}", value(rnd, string.digits, 16), "".join(rnd.choices(WORDS, k=3)) + "averylong",
        ][i % 3]
        secrets.add(secret)
        clean.add(harmless.split()[-1])
        rows.append((i, f"{prose(rnd, 20)}\n{line}\n{prose(rnd, 10)} {harmless} {prose(rnd, 5)}", "repo/src/a"))
    return rows, secrets, clean


def test_planted_secrets_are_found_and_harmless_runs_are_not(spark, planted):
    rows, secrets, clean = planted
    text = {r[0]: r[1] for r in rows}
    out = secret_scan.op4_secret_scan(spark.createDataFrame(rows, SCHEMA)).where("held_out").collect()
    said = {text[r["doc_id"]][r["start"]:r["start"] + r["length"]]: r["is_secret"] for r in out}
    asked = [v for v in secrets if any(v in text[r["doc_id"]] for r in out)]
    assert sum(said.get(v, False) for v in asked) >= 0.9 * len(asked) > 0
    harmless = [v for v in clean if v in said]
    assert harmless and sum(said[v] for v in harmless) <= 0.1 * len(harmless)


def test_features_against_plain_python(spark, planted):
    rows, _, _ = planted
    rows = rows[:60] + [(900, None, None), (901, "", "x"), (902, "q" * 3000 + " end", "a/test"), (903, "token: ü§$%&/é!", "s")]
    pairs, docs_with = Counter(), Counter()
    for _, text, _ in rows:
        docs_with.update({w for w in re.findall(r"(?<!\w)[a-zü]{4,24}(?!\w)", (text or "").lower())})
    # Neighbouring pairs run on from document to document by one blank; a single task reads them in order here.
    data = " ".join(t or "" for _, t, _ in rows).encode()
    pairs.update((a, b) for a, b in zip(data, data[1:]) if a < 128 and b < 128)
    totals = defaultdict(int)
    for (a, _), n in pairs.items():
        totals[a] += n
    known = {w for w, n in docs_with.items() if n >= secret_scan.DICTIONARY_DOCS}

    def coverage(text):
        at = n = 0
        while at < len(text):
            size = next((k for k in range(24, 3, -1) if text[at:at + k] in known and at + k <= len(text)), 0)
            n, at = n + size, at + (size or 1)
        return n / len(text)

    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    found = secret_scan.candidates(df).collect()
    assert len(found) > 100 and {r["doc_id"] for r in found} >= {902, 903}
    for r in found:
        text, raw = r["candidate"], r["candidate"].encode()
        x = dict(zip(secret_scan.FEATURES, r["x"], strict=True))
        steps = [math.log2((pairs[min(a, 127), min(b, 127)] + 1) / (totals[min(a, 127)] + 128)) for a, b in zip(raw, raw[1:])]
        assert x["length"] == len(raw)
        assert x["transition"] == pytest.approx(sum(steps) / len(steps))
        if raw.isascii():
            assert x["dictionary"] == pytest.approx(coverage(text.lower()))
        assert x["digits"] == pytest.approx(sum(c.isdigit() for c in text) / len(raw))
        assert x["hex"] == float(re.fullmatch(r"[0-9a-fA-F]+", text) is not None)
        assert x["entropy"] == pytest.approx(-sum(n / len(raw) * math.log2(n / len(raw)) for n in Counter(raw).values()))
        assert rows[[q[0] for q in rows].index(r["doc_id"])][1][r["start"]:].startswith(text)


def test_spans_evidence_and_neighbours():
    def found(text):
        return [(f[2].decode(), f[4]) for f in secret_scan.findings((1, text.encode(), ""))]

    run = "a1b2c3d4e5f6a7b8c9"
    assert found(f"DB_PASSWORD={run}") == [(run, 1)]
    assert found("password: 'p!w@9#z'") == [("p!w@9#z", 1)]
    assert found("password: required") == [("required", None)]
    assert found("token = \"changeme-1234\"") == [("changeme-1234", None)]
    assert found(f"example: token = {run}") == [(run, None)]
    assert found(f"Authorization: Bearer {run}.x, then") == [(run + ".x", 1)]
    assert found(f"author: {run}") == [(run, None)]
    assert found(f"the {run} stands free.") == [(run, 0)]
    assert found(f"my token is {run} so") == [(run, None)]
    assert [label for _, label in found(f"https://a.b/c/{run}")] == [0]
    assert found("") == found("short words only") == []
    # A name and sign that assign a value leave no trace in the features.
    named = secret_scan.FEATURES.index("named") - 8
    rows = [next(secret_scan.findings((1, t.encode(), ""))) for t in (f"here token={run} ok", f"here title={run}  ok")]
    assert rows[0][3][named] == rows[1][3][named] == 0.0
    word = zlib.crc32(b"here") % secret_scan.NEAR_BUCKETS
    assert rows[0][3][4 + word] >= 1.0


def test_repeated_rows_and_one_label(spark, planted):
    rows, _, _ = planted
    once = secret_scan.op4_secret_scan(spark.createDataFrame(rows[:50], SCHEMA)).count()
    assert secret_scan.op4_secret_scan(spark.createDataFrame(rows[:50] * 3, SCHEMA)).count() == 3 * once
    free = [(i, "the 1234567890123456 stands free", "a") for i in range(10)]
    out = secret_scan.op4_secret_scan(spark.createDataFrame(free, SCHEMA)).collect()
    assert len(out) == 10 and not any(r["is_secret"] for r in out)
