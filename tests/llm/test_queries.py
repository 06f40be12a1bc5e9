"""The operators' queries against their SQL, on the smallest tables."""

import pytest

from abasto.llm.queries import ORACLES, QUERIES
from abasto.workload.compare import duck

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    answer = duck(FOLDER).execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(tuple, frame.select(*columns).collect())) == sorted(answer.fetchall())
