"""Every registered query against its SQL in DuckDB, at the smallest scale."""

from __future__ import annotations

import pytest
from compare import compare, connect

from __spark_entry__ import entry
from changeloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) is None


def test_checksums_against_python(spark):
    import zlib

    from changeloom.plans.queries_values import _definition_texts
    from changeloom.sources.registry import canonical_text

    texts = {r.p_partkey: r.text for r in _definition_texts(spark, SF).collect()}
    for r in QUERIES["schema_checksum"](spark, SF).collect():
        assert r.checksum == zlib.crc32(canonical_text(texts[r.p_partkey]).encode())


def test_flagship(spark):
    assert entry(spark).count() == 743
