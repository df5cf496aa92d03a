import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import difference, duck  # noqa: E402

from meterline.llm.oracles import oracle_sql  # noqa: E402
from meterline.llm.queries import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf01, name):
    want = duck(sf01).execute(oracle_sql()[name]).fetchdf()
    assert len(want) > 0
    assert difference(queries()[name](spark, sf01).toPandas(), want) is None
