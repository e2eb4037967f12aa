"""Queries of this subpackage that SQL can express, against their SQL."""

import pytest

from foulee.llm import catalogue
from tools import check_oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_twin(spark, monkeypatch, name):
    monkeypatch.setattr(check_oracle, "QUERIES", catalogue.QUERIES)
    monkeypatch.setattr(check_oracle, "oracle_sql", lambda: catalogue.ORACLE_SQL)
    assert check_oracle.compare(spark, check_oracle.connect(SF_DIR), SF_DIR, name) is None
