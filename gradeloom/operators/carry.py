"""Running features carried on: new events meet a stored state instead of all events before them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gradeloom.operators.prefix import MEET, ORDER, features_of_parts, frame, part_calls
from gradeloom.operators.runs import Conflict, data_of, last_snapshot, put_commit
from gradeloom.schema import COUNTERS, KEYS, MEASURES
from gradeloom.session import materialize


def place(prefix: str = "") -> str:
    """The order of a row as one value; a null step comes first, as in a window."""
    return (f"struct(coalesce({prefix}step, double('-infinity')) as step, {prefix}tie_rank as tie_rank, "
            f"coalesce({prefix}tie_name, '') as tie_name, {prefix}row_id as row_id)")


@dataclass
class Carried:
    """What carrying on gave: features of the new rows, the state behind them, and the rows that came too late."""

    features: DataFrame
    state: DataFrame
    late: DataFrame


def state_columns(counters: dict = COUNTERS, measures: list[str] = MEASURES) -> list[str]:
    """Of a learner and course: the last row's place, the first target, and what can be merged of its rows.

    A measure has its first value as centre, and count, sum and sum of squares around it, least and greatest.
    """
    parts, _ = part_calls(counters, measures)
    return [*KEYS, "last", "target_first", *[f"{m}_centre" for m in measures], *parts]


def carry_on(rows: DataFrame, state: DataFrame | None = None, counters: dict = COUNTERS, measures: list[str] = MEASURES) -> Carried:
    """Running features of `rows`, rows of `measured`, all of which come behind those that `state` knows of.

    State and old events are exchangeable: features are those of a rebuild over all events. A state has one row a
    learner and course and is merged with the new rows alone, in one exchange of both by their keys. Rows that come
    before or at a group's last known place would change features already given; they are put into `late`, with all
    else of their group's new rows, and the group's state stays: rebuild it from its events, see `without_groups`.
    Groups without new rows keep their state; without any state all groups are new. No rows give no features.
    """
    parts, fold = part_calls(counters, measures)
    names = state_columns(counters, measures)
    kept = [c for c in names if c not in KEYS]
    if state is None:
        empty = [f"cast(null as {kind}) as {n}_old" for n, kind in _kinds(counters, measures).items()]
        both = rows.selectExpr("*", f"{place()} as place", *empty)
    else:
        old = state.selectExpr(*KEYS, *[f"{c} as {c}_old" for c in kept])
        both = rows.selectExpr("*", f"{place()} as place").join(old, KEYS, "left")
    group = f"(partition by {', '.join(KEYS)})"
    w = frame(KEYS)
    both = both.selectExpr("*", f"coalesce(max(last_old is not null and place <= last_old) over {group}, false) as behind")
    late = both.where("behind").select(*rows.columns)
    both = both.where("not behind").selectExpr(
        "*", f"coalesce(target_first_old, first(target) over {w}) as target_first",
        *[f"coalesce({m}_centre_old, first({m}, true) over {w}) as {m}_centre" for m in measures])
    both = both.selectExpr("*", *[f"{m} - {m}_centre as {m}_dev" for m in measures])
    here = both.selectExpr(
        *KEYS, "place", "row_id", "tie_rank", "tie_name", "target_first", *[f"{m}_centre" for m in measures],
        *[f"{call} over {w} as {n}" for n, call in parts.items()], *[f"{n}_old as {n}_before" for n in parts])
    whole = materialize(here.selectExpr(
        *KEYS, "place", "row_id", "tie_rank", "tie_name", "target_first", *[f"{m}_centre" for m in measures],
        *[f"{MEET[how].format(n)} as {n}" for n, how in fold.items()]))
    features = whole.selectExpr(
        *KEYS, "row_id", "tie_rank", "tie_name", "target_first as target", *features_of_parts(counters, measures))
    newest = F.max_by(F.struct(F.col("place").alias("last"), *[c for c in kept if c != "last"]), "place")
    renewed = whole.groupBy(*KEYS).agg(newest.alias("s")).select(*KEYS, "s.*").select(*names)
    if state is not None:
        renewed = renewed.unionByName(state.select(*names).join(renewed.select(*KEYS), KEYS, "left_anti"))
    return Carried(features, renewed, late)


def _kinds(counters: dict, measures: list[str]) -> dict[str, str]:
    parts, _ = part_calls(counters, measures)
    kinds = {"last": "struct<step:double,tie_rank:int,tie_name:string,row_id:bigint>", "target_first": "int"}
    kinds |= {f"{m}_centre": "double" for m in measures}
    return kinds | {n: "bigint" if call.startswith(("count", "sum")) and not n.endswith(("dev_part", "sq_part")) else "double" for n, call in parts.items()}


def without_groups(state: DataFrame, groups: DataFrame) -> DataFrame:
    """The state without some groups, whose events then come as new ones."""
    return state.join(groups.select(*KEYS).distinct(), KEYS, "left_anti")


def load_state(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The stored state and the number of its commit; none and 0 at first."""
    number = last_snapshot(spark, path)
    return (spark.read.parquet(data_of(spark, path, number)) if number else None), number


def save_state(state: DataFrame, path: str, number: int) -> None:
    """Commit the state that follows commit `number`; a `Conflict` says that another job has carried it on meanwhile."""
    data = f"data-{uuid.uuid4().hex}"
    state.write.mode("error").parquet(f"{path}/{data}")
    put_commit(state.sparkSession, path, number + 1, data)


__all__ = ["Carried", "Conflict", "carry_on", "load_state", "save_state", "state_columns", "without_groups"]
