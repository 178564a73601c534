"""A whole run, from raw events to probabilities, against stored answers."""

import json
import os

import pytest
from conftest import SF
from pyspark.sql import functions as F

from gradeloom.operators import model as M
from gradeloom.operators.sample import balance, split
from gradeloom.operators.trees import forest_of
from gradeloom.plans.gradebook import EXAMS, gradebook
from gradeloom.plans.process import feature_table
from gradeloom.schema import FEATURES

PARAMS = {"trees": 3, "leaves": 5, "rate": 0.3, "leaf_rows": 5, "columns": 0.8, "drop": 0.1, "l1": 0.1, "l2": 1.0}


def golden_run(spark):
    """Clean, build features, split, balance, fit leaf-wise trees, score the test rows."""
    cut = split(feature_table(gradebook(spark, SF), EXAMS))
    train = balance(cut.where("split = 'train'"), "under", FEATURES)
    model = M.fit(train, M.BOOSTED_FINE, PARAMS)
    forest = forest_of(model)
    rows = M.score(model, cut.where("split = 'test'")).orderBy("row_id")
    return {
        "splits": [[FEATURES[f], round(t, 6)] for f, t in zip(forest.feature.tolist(), forest.threshold.tolist()) if f >= 0],
        "probabilities": {str(r.row_id): round(r.p, 9) for r in rows.select("row_id", F.col("p")).collect()},
    }


def test_a_whole_run_gives_the_stored_answers(spark):
    with open(os.path.join(os.path.dirname(__file__), "golden_forest.json")) as file:
        want = json.load(file)
    got = golden_run(spark)
    assert got["splits"] == want["splits"] and len(want["splits"]) == 12
    assert got["probabilities"] == pytest.approx(want["probabilities"], abs=1e-8)
