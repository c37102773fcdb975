"""Every query of the core against its SQL on the smallest tables, and the driver's entry points."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, duck
from workload.oracles import ORACLES
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(REGISTRY[name](spark, sf_dir), con.execute(ORACLES[name])) is None


@pytest.mark.parametrize("absent", ["public_tokenizers", "numpy", "corpus_pipeline"])
def test_core_queries_without_what_training_text_needs(absent):
    """A package that only the training-text operators import may be missing."""
    code = f"import sys; sys.modules['{absent}'] = None; import __spark_entry__ as e; print(*sorted(e.queries()), *sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=True)
    assert said.stdout.split() == [*sorted(REGISTRY), *sorted(ORACLES)]


def test_entry(spark):
    assert entry(spark).count() > 0
