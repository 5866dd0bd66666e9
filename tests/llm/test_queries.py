"""The registered queries against their SQL, the pipeline against plain Python, and what the packages import."""

from __future__ import annotations

import ast
import os
import re

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry_points
from tillstream.llm import oracles, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NUMBERS = [*range(1, 14)]


def test_every_operator_is_registered():
    found = entry_points.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found if re.match(r"op\d+_", n)) == NUMBERS
    assert "pipeline" in found and set(oracles.registry()) <= set(queries.registry())


@pytest.mark.parametrize("name", sorted(oracles.registry()))
def test_query_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = con.sql(oracles.registry()[name])
    got = queries.registry()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(found.columns)
    assert sorted(map(tuple, got.select(*found.columns).collect())) == sorted(found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.registry()) - set(oracles.registry())))
def test_query_returns_all_rows(spark, sf_dir, name):
    got = queries.registry()[name](spark, sf_dir)
    if name not in ("op1_decontaminate", "op4_secret_scan"):
        assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    else:
        assert "doc_id" in got.columns and got.count() >= 0


def test_nothing_else_imports_the_operators():
    for folder, _, names in os.walk(f"{ROOT}/tillstream"):
        for name in names:
            if name.endswith(".py") and f"{os.sep}llm" not in folder:
                tree = ast.parse(open(f"{folder}/{name}", encoding="utf-8").read())
                for node in ast.walk(tree):
                    assert not (isinstance(node, ast.ImportFrom) and "llm" in (node.module or ""))
                    assert not (isinstance(node, ast.Import) and any("llm" in a.name for a in node.names))


def test_quality_runs_without_python(spark, sf_dir):
    plan = queries.registry()["op2_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_pipeline_stages(spark, sf_dir, tmp_path):
    """Every stage on its own input: what leaves it follows from what the operators' own tests establish."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frames = docs.columns, {"start": docs.toPandas().set_index("doc_id")}
    for name, stage in corpus_pipeline.STAGES:
        before = frames[list(frames)[-1]]
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = frames[name] = docs.toPandas().set_index("doc_id")
        assert after.index.is_unique and set(after.index) <= set(before.index)
        if name != "token_ids":
            assert docs.columns == columns
    assert set(frames["line_dedup"].index) == set(frames["quality_rules"].index)
    assert (frames["line_dedup"]["n_chars"] == frames["line_dedup"]["text"].str.len()).all()
    short = frames["line_dedup"]["text"] != frames["quality_rules"]["text"]
    assert 0 < short.sum() < len(short)
    assert set(frames["token_ids"].index) == set(frames["decontamination"].index)

    def words(text):
        return text.encode().lower().split()

    def shingles(text):
        w = words(text)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    # Every document that the near-duplicate stage drops has a chain of links to one that stays.
    sets = {i: shingles(t) for i, t in frames["line_dedup"]["text"].items()}
    gone = set(frames["line_dedup"].index) - set(frames["near_duplicates"].index)
    ids = sorted(sets)

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)

    assert all(any(linked(a, b) for b in ids if b != a) for a in gone)
    left = sorted(frames["near_duplicates"].index)
    assert not any(linked(a, b) for k, a in enumerate(left) for b in left[:k])
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for text in frames["decontamination"]["text"]:
        held = shingles(text)
        for w in items:
            own = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
            assert sum(x in held for x in own) < 0.75 * len(own)


def test_pipeline_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns) and out.count() > 0


def test_pipeline_takes_odd_rows(spark, sf_dir, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, _copy string"
    text = " ".join(f"w{i}" for i in range(30))
    data = [
        (1, None, None, None, 0, "x", "y"), (2, "", "en", "a", 0, "x", "y"), (3, text, "en", "a", 9, "x", "y"),
        (4, text.replace(" w15", "\nw15"), "en", "a", 9, "x", "y"), (4, text.replace(" w15", "\nw15"), "en", "a", 9, "x", "y"), (5, text, "en", "a", 9, "x", "y"), (None, text + " more", "en", "a", 9, "x", "y"),
    ]
    for k, rows in enumerate((data, [])):
        docs = spark.createDataFrame(rows, schema)
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}/{n}")
            docs = spark.read.parquet(f"{tmp_path}/{k}/{n}")
        # 4 has the words of 3 in other lines; 5 has lost its only line and stays as an empty text.
        assert sorted(r["doc_id"] or 0 for r in docs.collect()) == ([0, 3, 5] if rows else [])
