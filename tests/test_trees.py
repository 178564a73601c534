"""Trees as arrays, their attributions, many models in one pass, leaf-wise boosting and Parzen search."""

import itertools
import math
import random

import numpy as np
import pytest
from conftest import same
from pyspark.sql import functions as F

from gradeloom.operators import boost, parzen
from gradeloom.operators import model as M
from gradeloom.operators.trees import Forest, TreeModel, attributed_importance, forest_of, score_all, tree_attributions

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(1)
    x = np.round(draw.normal(size=(600, 3)), 2)
    y = ((x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + draw.normal(size=600) * 0.3) > 0.2).astype(int)
    data = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "row_id long, a double, b double, c double, target int").cache()


@pytest.fixture(scope="module")
def models(rows):
    return {
        "forest": M.fit(rows, M.FOREST, {"trees": 4, "depth": 4}, FEATURES),
        "boosted": M.fit(rows, M.BOOSTED_FINE, {"trees": 3, "depth": 3, "rate": 0.3}, FEATURES),
        "leafwise": boost.fit_leafwise(rows, FEATURES, {"trees": 4, "leaves": 6, "rate": 0.4}),
    }


def values(df, columns):
    return np.array([[float(r[c]) for c in columns] for r in df.orderBy("row_id").collect()])


def expectation(forest, root, known, x):
    """What a tree says if only the `known` features of x are: both ways by cover at the others."""
    f = forest.feature[root]
    if f < 0:
        return forest.value[root]
    left, right = forest.left[root], forest.right[root]
    if f in known:
        return expectation(forest, left if x[f] <= forest.threshold[root] else right, known, x)
    cover = forest.cover[root]
    return (forest.cover[left] * expectation(forest, left, known, x) + forest.cover[right] * expectation(forest, right, known, x)) / cover


def shapley(forest, x):
    """By the definition: every subset of the other features."""
    n, out = len(x), []
    value = lambda known: forest.base + sum(expectation(forest, r, known, x) for r in forest.roots)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        out.append(sum(math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) * (value({*s, i}) - value(set(s)))
                       for k in range(n) for s in itertools.combinations(others, k)))
    return out


@pytest.mark.parametrize("name", ["forest", "boosted", "leafwise"])
def test_forest_scores_like_its_model_and_attributions_add_up(rows, models, name):
    want = values(M.score(models[name], rows), ["p"])[:, 0]
    forest = forest_of(models[name])
    x = values(rows, FEATURES)
    assert np.allclose(forest.probabilities(x), want, atol=1e-12)
    got = values(tree_attributions(models[name], rows, FEATURES), ["margin", "expected", *FEATURES])
    assert np.allclose(got[:, 2:].sum(axis=1), got[:, 0] - got[:, 1], atol=1e-9)
    for i in range(0, 600, 60):
        assert np.allclose(got[i, 2:], shapley(forest, x[i]), atol=1e-9)


def test_attributions_on_random_trees_with_missing_values():
    draw = np.random.default_rng(2)
    for _ in range(30):
        feature, threshold, left, right, value, cover = [], [], [], [], [], []

        def grow(depth, weight):
            at = len(feature)
            leaf = depth == 0 or draw.random() < 0.2
            for column, v in ((feature, -1 if leaf else int(draw.integers(5))), (threshold, float(np.round(draw.normal(), 1))), (left, -1), (right, -1),
                              (value, float(draw.normal())), (cover, weight)):
                column.append(v)
            if not leaf:
                part = float(draw.uniform(0.1, 0.9))
                left[at], right[at] = grow(depth - 1, weight * part), grow(depth - 1, weight * (1 - part))
            return at

        roots = [grow(5, 10.0) for _ in range(2)]
        forest = Forest(*(np.array(c) for c in (feature, threshold, left, right, value, cover)), np.array(roots), 0.5)
        x = np.round(draw.normal(size=(6, 5)), 1)
        x[0, 2] = x[3, 0] = np.nan
        got, expected = forest.attributions(x, 5)
        assert np.allclose(got.sum(axis=1), forest.margins(x) - expected)
        for i in range(6):
            assert np.allclose(got[i], shapley(forest, x[i]))


def test_importance_ranks_what_the_target_follows(rows, models):
    ranked = attributed_importance(models["leafwise"], rows, FEATURES).orderBy("place").collect()
    assert [r.feature for r in ranked][0] == "a" and abs(ranked[-1].running_share - 1) < 1e-9


def test_many_models_in_one_pass(rows, models):
    got = score_all(models, rows, FEATURES)
    plan = got._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") <= 4 and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    for name, model in models.items():
        want = M.score(model, rows).select("row_id", "target", "p")
        same(got.where(F.col("run_id") == name).select("row_id", "target", "p").toPandas(), want.toPandas(), 1e-9)
    assert score_all(models, rows.limit(0), FEATURES).count() == 0
    assert score_all({}, rows, FEATURES).count() == 0


def test_missing_values_and_empty_tables(spark, rows, models):
    odd = spark.createDataFrame([(1, None, 0.5, float("nan")), (2, 0.1, None, 0.2)], "row_id long, a double, b double, c double")
    got = values(tree_attributions(models["leafwise"], odd, FEATURES), ["margin", "expected", *FEATURES])
    assert np.allclose(got[:, 2:].sum(axis=1), got[:, 0] - got[:, 1])
    assert tree_attributions(models["forest"], odd.limit(0), FEATURES).count() == 0
    none = boost.fit_leafwise(rows.limit(0), FEATURES, {"trees": 2})
    assert {r.p for r in M.score(none, rows).collect()} == {0.5}


# -- leaf-wise boosting ---------------------------------------------------------------------------

def plain_tree(x, g, h, options):
    """Best-first growth over all values by loops; sums of whole units like the library's."""
    nodes, waiting = [{"rows": np.arange(len(x)), "depth": 0}], []

    def worth(rows_):
        total = g[rows_].sum() / boost.UNIT
        return (np.sign(total) * max(abs(total) - options.l1, 0)) ** 2 / (h[rows_].sum() / boost.UNIT + options.l2 + 1e-12)

    def weigh(number):
        rows_ = nodes[number]["rows"]
        total = g[rows_].sum() / boost.UNIT
        nodes[number]["value"] = -options.rate * np.sign(total) * max(abs(total) - options.l1, 0) / (h[rows_].sum() / boost.UNIT + options.l2 + 1e-12)
        best = None
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left, right = rows_[x[rows_, f] <= cut], rows_[x[rows_, f] > cut]
                if min(len(left), len(right)) >= max(1, options.leaf_rows):
                    gain = 0.5 * (worth(left) + worth(right) - worth(rows_))
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, left, right)
        if best and nodes[number]["depth"] < options.depth:
            waiting.append((best, number))

    weigh(0)
    leaves = 1
    while waiting and leaves < options.leaves:
        waiting.sort(key=lambda item: (-item[0][0], item[1]))
        (_, f, cut, left, right), number = waiting.pop(0)
        nodes[number]["split"] = (f, cut, len(nodes))
        nodes += [{"rows": r, "depth": nodes[number]["depth"] + 1} for r in (left, right)]
        weigh(len(nodes) - 2)
        weigh(len(nodes) - 1)
        leaves += 1
    out = np.empty(len(x))
    for n in nodes:
        if "split" not in n:
            out[n["rows"]] = n["value"]
    return out, [n["split"][:2] for n in nodes if "split" in n]


@pytest.mark.parametrize("params", [
    {"trees": 3, "leaves": 7, "rate": 0.5}, {"trees": 2, "leaves": 12, "l1": 2.0, "l2": 0.1, "leaf_rows": 9},
    {"trees": 2, "leaves": 20, "depth": 2, "objective": "hinge"},
])
def test_trees_equal_brute_force(spark, params):
    draw = np.random.default_rng(3)
    x = np.round(draw.normal(size=(200, 3)), 1)  # fewer values than bins, so every value is a cut
    y = (x[:, 0] * x[:, 1] + draw.normal(size=200) * 0.2 > 0).astype(int)
    w = np.where(y == 1, 2.0, 1.0)
    table = spark.createDataFrame([(i, *map(float, v), int(t), float(u)) for i, (v, t, u) in enumerate(zip(x, y, w))],
                                  "row_id long, a double, b double, c double, target int, weight double")
    options = boost.Options.of(params)
    margin, splits = np.zeros(len(x)), []
    for _ in range(options.trees):
        g, h, *_ = boost.slopes(options.objective, y, w, margin)
        values_, own = plain_tree(x, g, h, options)
        margin, splits = margin + values_, splits + own
    forests = [boost.fit_leafwise(t, FEATURES, params).forest for t in (table, table.repartition(7))]
    for forest in forests:
        assert np.allclose(forest.margins(x), margin, atol=1e-9)
        assert [(int(f), t) for f, t in zip(forest.feature, forest.threshold) if f >= 0] == splits
    assert all((forests[0].value == forests[1].value).tolist())  # to the last bit, however rows lie


def test_dropped_trees_and_columns(rows):
    params = {"trees": 6, "leaves": 5, "drop": 0.6, "columns": 0.67, "rate": 0.5}
    one, two = (boost.fit_leafwise(t, FEATURES, params, seed=4).forest for t in (rows, rows.repartition(3)))
    x, y = values(rows, FEATURES), values(rows, ["target"])[:, 0]
    assert (one.value == two.value).all() and not (one.value == boost.fit_leafwise(rows, FEATURES, {**params, "drop": 0.0}, 4).forest.value).all()
    assert ((one.probabilities(x) > 0.5) == y).mean() > 0.85
    for root, following in zip(one.roots, [*one.roots[1:], len(one.feature)]):
        assert len(set(one.feature[root:following]) - {-1}) <= 2


def test_margins_moved_with_dropped_trees_are_those_of_the_forest(spark, rows):
    """The margins kept in the blocks and the forest put out at the end agree: each round sees the right gradients."""
    seen = []
    kept = boost.moved_on
    boost.moved_on = lambda state, *rest: seen.append(kept(state, *rest)) or seen[-1]
    try:
        model = boost.fit_leafwise(rows, FEATURES, {"trees": 5, "leaves": 4, "drop": 0.5}, seed=9)
    finally:
        boost.moved_on = kept
    margins = np.concatenate([np.frombuffer(r.margin, np.float64) for r in seen[-1].collect()])
    assert np.allclose(np.sort(margins), np.sort(model.forest.margins(values(rows, FEATURES))), atol=1e-9)


@pytest.mark.parametrize("params", [
    {"trees": 7, "leaves": 20, "drop": 0.5, "columns": 0.67, "rate": 0.4, "l1": 0.3},
    {"trees": 3, "leaves": 40, "depth": 6, "leaf_rows": 3, "objective": "hinge"},
])
def test_passes_in_one_task_make_the_same_trees(rows, params):
    given = boost.into_bins(rows.withColumn("a", F.when(F.col("row_id") % 9 > 0, F.col("a"))).repartition(5), FEATURES)
    assert given.count() == 600
    here, spread = (boost.fit_binned(given, params, 3, one_task=n).forest for n in (600, 599))
    for name in ("feature", "threshold", "left", "right", "value", "cover", "roots"):
        assert (getattr(here, name) == getattr(spread, name)).all()
    none = boost.into_bins(rows.limit(0), FEATURES)
    assert {r.p for r in M.score(boost.fit_binned(none, params), rows).collect()} <= {0.0, 0.5}


def test_stored_forest_is_read_back(spark, rows, models, tmp_path):
    models["leafwise"].save(spark, f"{tmp_path}/m")
    again = TreeModel.load(spark, f"{tmp_path}/m")
    x = values(rows, FEATURES)
    assert again.features == FEATURES and (again.forest.probabilities(x) == models["leafwise"].forest.probabilities(x)).all()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        models["leafwise"].save(spark, f"{tmp_path}/m")


# -- Parzen search --------------------------------------------------------------------------------

SPACE = {"one": {"x": ("real", -5.0, 5.0), "n": ("int", 1, 40), "rate": ("log", 0.001, 1.0), "kind": ("choice", ["u", "v", "w"])},
         "two": {"x": ("real", 0.0, 1.0)}}


def cost(algorithm, params):
    if algorithm == "two":
        return 30 + params["x"]
    return (params["x"] - 2) ** 2 + abs(params["n"] - 11) / 4 + (math.log(params["rate"]) - math.log(0.05)) ** 2 + 3 * (params["kind"] != "v")


def run(seed, draws=70, **options):
    search = parzen.Search(SPACE, seed, **options)
    for _ in range(draws):
        algorithm, params, origin = search.next()
        search.tell(algorithm, params, cost(algorithm, params))
    return search


def test_draws_repeat_and_keep_their_limits():
    assert run(3).history == run(3).history != run(4).history
    for _, p, _ in (h for h in run(5).history if h[0] == "one"):
        assert -5 <= p["x"] <= 5 and 1 <= p["n"] <= 40 and isinstance(p["n"], int) and 0.001 <= p["rate"] <= 1 and p["kind"] in "uvw"
    assert all(1 <= p["n"] <= 40 for p in (parzen.at_random(random.Random(i), SPACE["one"]) for i in range(300)))


def test_search_beats_random_draws():
    model, chance = [], []
    for seed in range(15):
        model.append(min(loss for *_, loss in run(seed).history))
        chance.append(min(loss for *_, loss in run(seed, starts=10**9).history))
    assert np.mean(model) < 0.6 * np.mean(chance) and sum(m < c for m, c in zip(model, chance)) >= 12


def test_densities_equal_a_plain_version():
    rng = random.Random(6)
    for _ in range(50):
        low, high = -1.0, rng.uniform(0, 3)
        past = [rng.uniform(low, high) for _ in range(rng.randrange(0, 9))]
        density = parzen.Density(past, low, high)
        middle = (low + high) / 2
        at = sorted([*past, middle])
        norm = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
        for x in (low, middle, high, rng.uniform(low, high)):
            total = 0.0
            for i, m in enumerate(at):
                around = [low, *at, high]
                width = max(m - around[i], around[i + 2] - m)
                width = high - low if i == at.index(middle) else min(max(width, (high - low) / min(100, 1 + len(at))), high - low)
                total += math.exp(-0.5 * ((x - m) / width) ** 2) / (width * math.sqrt(2 * math.pi)) / (norm((high - m) / width) - norm((low - m) / width))
            assert math.isclose(float(density.log_density([x])[0]), math.log(total / len(at)), abs_tol=1e-9)
        # it is a density: the whole range weighs one
        grid = np.linspace(low, high, 20001)
        assert abs(np.exp(density.log_density(grid)).mean() * (high - low) - 1) < 1e-3


def test_first_draw_is_the_stored_one():
    search = parzen.Search(SPACE, 1, first=("one", {"x": "1.25", "n": "99", "kind": "w", "old": "7"}))
    algorithm, params, origin = search.next()
    assert (algorithm, origin, params["x"], params["n"], params["kind"]) == ("one", "stored", 1.25, 40, "w") and 0.001 <= params["rate"] <= 1
    search.tell(algorithm, params, float("nan"))
    assert search.next()[2] == "random"
    assert parzen.Search(SPACE, 1, first=("gone", {})).next()[2] == "random"
    assert run(2).next()[2] == "model"


def test_cut_points_are_merged_by_feature(spark):
    """Features are keys of the exchange, so no single task merges all their sketches."""
    from gradeloom.operators import boost

    rows = spark.range(1000).selectExpr("cast(id % 7 as double) a", "if(id % 2 = 0, null, double(id)) b", "cast('nan' as double) c", "1.0D d")
    frame = type(rows)
    plans, kept = [], frame.collect
    frame.collect = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df)
    try:
        cuts = boost.cut_points(rows, ["a", "b", "c", "d"], 4)
    finally:
        frame.collect = kept
    assert [c.tolist() for c in cuts] == [[0.0, 1.0, 3.0, 5.0], [1.0, 249.0, 499.0, 749.0], [], []]
    assert plans and "hashpartitioning(f" in plans[0] and "SinglePartition" not in plans[0]
