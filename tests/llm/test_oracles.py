import pytest

from casebook.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, name):
    cursor = connect(sf).execute(ORACLES[name])
    names, rows = [c[0] for c in cursor.description], cursor.fetchall()
    assert compare(QUERIES[name](spark, sf), names, rows) == ""


def test_all_operators_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14))
