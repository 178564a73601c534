"""Carried running features against a rebuild over all events."""

import pytest
from conftest import SF, same
from pyspark.sql import functions as F

from gradeloom.operators.carry import Conflict, carry_on, load_state, save_state, state_columns, without_groups
from gradeloom.operators.prefix import measured, running, running_in_blocks
from gradeloom.plans.gradebook import EXAMS, gradebook
from gradeloom.plans.process import clean_log
from gradeloom.schema import KEYS
from gradeloom.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    return materialize(measured(clean_log(gradebook(spark, SF)), EXAMS))


def cuts(rows, *bounds):
    low, out = None, []
    for high in [*bounds, None]:
        part = rows if low is None else rows.where(F.col("step") > low)
        out.append(part if high is None else part.where(F.col("step") <= high))
        low = high
    return out


def test_three_loads_equal_a_rebuild(rows):
    state, got = None, None
    for part in cuts(rows, 8, 19):
        carried = carry_on(part, state)
        assert carried.late.count() == 0
        state = materialize(carried.state)
        got = carried.features if got is None else got.unionByName(carried.features)
    for whole in (running(rows), running_in_blocks(rows)):
        same(got.toPandas(), whole.select(*got.columns).toPandas(), 1e-9)
    # the state behind all loads is the state of one load
    once = carry_on(rows).state
    assert state.columns == once.columns == state_columns()
    flat = [c for c in once.columns if c != "last"]
    same(state.select(*flat, "last.*").toPandas(), once.select(*flat, "last.*").toPandas(), 1e-9)


def test_late_rows_are_held_and_their_groups_rebuilt(rows):
    first, second = cuts(rows, 15)
    missed = first.where("row_id % 40 = 3")
    state = materialize(carry_on(first.where("row_id % 40 <> 3")).state)
    carried = carry_on(second.unionByName(missed), state)
    late = carried.late.select(*KEYS).distinct()
    assert set(late.collect()) == set(missed.join(state, KEYS, "left_semi").select(*KEYS).distinct().collect())
    # nothing is lost: late groups' events come again as new ones, all others are done
    again = carry_on(rows.join(late, KEYS, "left_semi"), without_groups(carried.state, late))
    whole = running(rows)
    done = carried.features.unionByName(again.features)
    want = whole.join(done.select("row_id"), "row_id", "left_semi")
    same(done.toPandas(), want.select(*done.columns).toPandas(), 1e-9)
    assert again.late.count() == 0 and again.state.count() == rows.select(*KEYS).distinct().count()


def test_no_new_rows_null_steps_and_the_same_load_twice(rows):
    some = rows.withColumn("step", F.when(F.col("row_id") % 9 != 0, F.col("step")))
    state = materialize(carry_on(some).state)
    none = carry_on(some.limit(0), state)
    assert none.features.count() == 0 and none.state.count() == state.count()
    twice = carry_on(some, state)
    assert twice.features.count() == 0 and twice.late.count() == some.count()
    same(carry_on(some).features.toPandas(), running(some).select(*carry_on(some).features.columns).toPandas(), 1e-9)


def test_two_jobs_cannot_carry_on_the_same_state(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    assert load_state(spark, path) == (None, 0)
    first = carry_on(rows.where("step <= 15")).state
    save_state(first, path, 0)
    state, number = load_state(spark, path)
    assert number == 1 and state.count() == first.count()
    save_state(carry_on(rows.where("step > 15"), state).state, path, number)
    with pytest.raises(Conflict):
        save_state(state, path, number)
    assert load_state(spark, path)[1] == 2
