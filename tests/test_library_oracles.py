"""Every registered query against its SQL on the smallest tables; of the jobs those that need most of
the others, as they are slow: ``python -m workload.check`` runs them all."""

import pytest

from workload import ORACLES, QUERIES
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


JOBS = ("job_curate", "job_hospital_extract", "job_patient", "job_report")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("job_") or n in JOBS))
def test_query(spark, con, name):
    cursor = con.execute(ORACLES[name])
    names, found = [c[0] for c in cursor.description], cursor.fetchall()
    assert compare(QUERIES[name](spark, SF), names, found) == ""
