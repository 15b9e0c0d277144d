"""Every registered query against its DuckDB oracle, at the smallest scale."""

import duckdb
import pytest

from checks.registry import ORACLES, QUERIES
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB types with the same values.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "timestamp_ntz": {"TIMESTAMP"},
    "date": {"DATE"},
    "boolean": {"BOOLEAN"},
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, repr(v)) for v in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    columns = sorted(result.columns)
    assert columns == sorted(described)
    for field in result.schema:
        assert described[field.name] in SAME_TYPE[field.dataType.simpleString()], field.name
    picked = [order.index(c) for c in columns]
    assert _sorted(tuple(r) for r in result.select(*columns).collect()) == _sorted(
        tuple(r[i] for i in picked) for r in expected
    )
