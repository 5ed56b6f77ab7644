import pytest
from tests.conftest import SF, same_rows
from tidelog.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, oracle, name):
    same_rows(spark, oracle, QUERIES[name], ORACLE_SQL[name], SF)


def test_json_props(spark):
    rows = QUERIES["json_props_text"](spark, SF).limit(20).collect()
    assert rows and all(r.props.startswith("{") for r in rows)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
