import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cairn.session import get_spark
    s = get_spark("local[*]", 8)
    yield s


def points_df(spark, vecs, weights=None, ids=None):
    ids = ids if ids is not None else list(range(len(vecs)))
    weights = weights if weights is not None else [1] * len(vecs)
    rows = [(int(i), [float(x) for x in v], int(w)) for i, v, w in zip(ids, vecs, weights)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, w bigint")


def centres_df(spark, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                 "cid int, v array<double>")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
