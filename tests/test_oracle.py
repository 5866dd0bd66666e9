"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from tillstream.plans import oracles, queries

QUERIES = queries.registry()
ORACLES = oracles.registry()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_points_hold_all_queries():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 13


@pytest.mark.parametrize("package", ["public_tokenizers", "tokenizers", "regex", "xxhash", "tillstream.llm", "corpus_pipeline"])
def test_core_queries_load_without_optional_packages(package):
    program = f"""
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {package!r}:
            raise ModuleNotFoundError(name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__
print(len(__spark_entry__.queries()))
"""
    root = os.path.dirname(entry_points.__file__)
    found = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True, timeout=60)
    assert found.stdout.strip() == str(len(QUERIES)), found.stderr
