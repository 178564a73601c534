import os
import sys

import duckdb
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gradeloom.schema import ACTIVITY  # noqa: E402
from gradeloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


def activity(spark, rows):
    """An activity log from dicts; columns left out are null."""
    filled = [tuple(row.get(f.name) for f in ACTIVITY) for row in rows]
    return spark.createDataFrame(filled, ACTIVITY)


def row(row_id, learner="L1", course="C1", step=1.0, **rest):
    return {"row_id": row_id, "learner_id": learner, "course_id": course, "course_name": f"name {course}",
            "learner_no": f"N{learner}", "term": "3-2024", "step": step, "final_grade": 5.0, **rest}


def same(left: pd.DataFrame, right: pd.DataFrame, tolerance=1e-9):
    """Equal rows in any order, columns by name."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert len(left) == len(right)

    def ready(df):
        df = df[columns].copy()
        for c in columns:
            if pd.api.types.is_numeric_dtype(df[c]) or df[c].isna().all():
                df[c] = df[c].astype(float)
            else:
                df[c] = df[c].map(lambda v: "~" if pd.isna(v) else str(v))
        keys = [c for c in ("row_id", "learner_id", "course_id", "place") if c in columns]
        return df.sort_values(keys + [c for c in columns if c not in keys]).reset_index(drop=True)

    pd.testing.assert_frame_equal(ready(left), ready(right), check_exact=False, rtol=tolerance, atol=tolerance)
