"""Queries that SQL can express give the rows of their SQL; every operator is registered."""

import re

import pytest

import __spark_entry__ as entry
import check
from reelrank.llm.oracles import ORACLES


@pytest.mark.parametrize("key", list(ORACLES))
def test_matches_oracle(spark, sf_dir, key):
    assert check.compare(spark, check.connect(sf_dir), sf_dir, key)[0] == "match"


def test_every_operator_is_registered():
    numbers = sorted(int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k)))
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLES) <= set(entry.queries())


def test_nothing_else_imports_the_operators():
    from pathlib import Path

    root = Path(entry.__file__).parent / "reelrank"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
