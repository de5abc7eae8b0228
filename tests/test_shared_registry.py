"""Queries that read the finalised registry more than once compute it once."""

from __future__ import annotations

import os

import pytest

from catalog import QUERIES, reports

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", ["inclusion_share", "label_crosstab", "country_info", "gap_fill_applied", "mart_bundle"])
def test_registry_is_computed_once(spark, monkeypatch, name):
    times, finalized = [], reports.finalized

    def counted(t):
        times.append(name)
        return finalized(t)

    monkeypatch.setattr(reports, "finalized", counted)
    assert QUERIES[name](spark, SF_DIR).columns
    assert len(times) == 1
