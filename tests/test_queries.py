"""Every registered query against its SQL twin at the smallest scale."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from checker import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, FOLDER).count() > 0
        return
    problem = compare(spark, FOLDER, con, QUERIES[name], ORACLES[name])
    assert problem in (None, "both sides are empty")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 20
    assert df.columns[0] == "id"


def test_first_page_ids(spark):
    from millrace.operators import reads
    from millrace.plans import records

    rows = records.ingestion(spark, FOLDER)
    page = reads.page(rows, 1, 5, reads.equal_to(source_type="kafka"))
    assert [r.id for r in page.collect()] == [996, 989, 980, 973, 967]
