"""Every driver query with SQL gives the rows of its SQL, on the smallest tables."""

import decimal
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from lodestone.plans import audit_sql, audits, oracle, stored  # noqa: E402, F401
from lodestone.plans.queries import QUERIES  # noqa: E402

ORACLE = {**oracle.ORACLE, **audit_sql.SQL, **stored.SQL}

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{file}')")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else float(value) if isinstance(value, decimal.Decimal) else value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_is_its_sql(spark, sql, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    cursor = sql.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [[row[names.index(c)] for c in columns] for row in cursor.fetchall()]
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert ordered(rows) == ordered(want)
    assert rows or name in ("exact_dup", "rule_audit")


def test_the_entry_module_has_all_of_them():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
