"""Boosting that stops, and exact attribution of trees."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from roadspark.operators import boosting, training
from roadspark.operators.sampling import with_folds
from roadspark.operators.tree_attribution import leaf_paths, tree_attribution

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 5, 900), rng.random(900), np.ones(900)])
    y = np.where(x[:, 0] > 0.3, 1.0, 0.0) + 0.3 * x[:, 1] + np.sin(5 * x[:, 2]) + 0.1 * rng.normal(size=900)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "Index long, a double, b double, c double, d double, demand double")
    return with_folds(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df), 3).select("Index", "features", "demand", "fold")


def arrays(table):
    rows = table.orderBy("Index").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.demand for r in rows])


def plain_tree(x, g, params, depth=0):
    """The best tree by trying every cut of every feature, as nested tuples."""
    value = np.sign(g.sum()) * max(abs(g.sum()) - params.l1, 0) / (len(g) + params.l2)
    strength = lambda part: max(abs(part.sum()) - params.l1, 0) ** 2 / (len(part) + params.l2)
    best = (1e-12, None)
    if depth < params.depth:
        for k in range(x.shape[1]):
            for cut in np.unique(x[:, k])[:-1]:
                left = x[:, k] <= cut
                if min(left.sum(), (~left).sum()) >= params.min_leaf:
                    gain = strength(g[left]) + strength(g[~left]) - strength(g)
                    if gain > best[0] + 1e-9:
                        best = (gain, (k, cut))
    if best[1] is None:
        return value
    k, cut = best[1]
    left = x[:, k] <= cut
    return k, cut, plain_tree(x[left], g[left], params, depth + 1), plain_tree(x[~left], g[~left], params, depth + 1)


def plain_predict(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, cut, left, right = tree
    return np.where(x[:, k] <= cut, plain_predict(left, x), plain_predict(right, x))


def test_boosting_equals_trying_every_cut(spark, table):
    """With few distinct values the bins are the values, so trees must agree."""
    v = vector_to_array("features")
    coarse = table.select("Index", "demand", F.round(v[0]).alias("a"), v[1].alias("b"), F.round(4 * v[2]).alias("c"))
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(coarse)
    params = training.boosted(rounds=4, depth=3, rate=0.5, min_leaf=7, l1=0.2, l2=1.5)
    x, y = arrays(rows)
    score = np.full(len(y), y.mean())
    for _ in range(params.rounds):
        score = score + params.rate * plain_predict(plain_tree(x, y - score, params), x)
    model = training.fit(params, rows)
    got = [r.prediction for r in model.transform(rows).orderBy("Index").collect()]
    assert got == pytest.approx(list(score), abs=1e-6)
    assert len(model.trees) == params.rounds + 1 and sum(model.featureImportances) == pytest.approx(1)


def grown(table, **options):
    fits = [boosting.Fit(training.boosted(6, 4, rows=0.7, columns=0.7, seed=3), fold, True) for fold in (0, 1)]
    fits.append(boosting.Fit(training.boosted(3, 2, l2=1.0)))
    edges = boosting.grow(table, fits, **options)
    return edges, fits


def test_trees_do_not_depend_on_the_layout(spark, table):
    _, one = grown(table)
    for options in ({"local_rows": 0}, {"local_rows": 150, "chunk_rows": 100}, {"block": 1, "chunk_rows": 50}, {"block": 2, "local_rows": 40}):
        _, other = grown(table.repartition(5), **options)
        for a, b in zip(one, other):
            assert len(a.trees) == len(b.trees) and a.errors == pytest.approx(b.errors, abs=1e-9)
            for s, t in zip(a.trees, b.trees):
                assert (s["feature"] == t["feature"]).all() and (s["bin"] == t["bin"]).all()
                assert s["value"] == pytest.approx(t["value"], abs=1e-9)


def test_rows_of_a_node_travel_together():
    """A task sends one record per block and small node, not one per row."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (500, 4)).astype(np.uint8)
    y = rng.normal(size=500)
    columns = [pa.array([r.tobytes() for r in x], pa.binary()), y, np.full(500, -1, np.int32), np.zeros(500, bool), np.arange(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bins", "y", "fold", "held", "mark"])
    blocks = list(boosting._blocked(iter([batch, batch]), [0.25, 0.5]))
    params = training.boosted(1, 3)
    tree = boosting._empty_tree(3)
    tree["feature"][0], tree["bin"][0] = 2, 4
    active = {1: (0, [], tree, np.array([], np.int64), np.array([1, 2]), False)}
    work = boosting._Pass([(params, None, False)] * 2, active, 4, 9, 2.0**20)
    steps = [r for b in boosting._visit(iter(blocks), work) for r in b.to_pylist()]
    assert [r["node"] for r in steps] == [1, 2, 1, 2] and {r["job"] for r in steps} == {1}
    right = x[:, 2] > 4
    for r, own in zip(steps, (~right, right) * 2):
        assert (np.frombuffer(r["data"], np.uint8).reshape(4, -1).T == x[own]).all() and r["n"] == own.sum()
        assert (np.frombuffer(r["g"]) == np.rint((y[own] - 0.5) * 2.0**20)).all()


def test_larger_children_are_differences():
    """Growing from a node's rows gives the splits that counting every node anew gives."""
    rng = np.random.default_rng(4)
    x, g = rng.integers(0, 12, (5, 700)).astype(np.uint8), np.rint(rng.normal(size=700) * 2.0**20)
    params, allowed = training.boosted(1, 5, min_leaf=3, l2=1.0), np.ones(5, bool)
    found = {f[0]: f[1:] for f in boosting._grow_here(0, x, g, allowed, params, 2.0**20, 12)}
    rows = {0: np.arange(700)}
    while rows:
        node, own = rows.popitem()
        split = found.pop(node)
        assert split[4] == len(own) and split[3] == g[own].sum()
        if (node + 1).bit_length() <= 5:
            hist = boosting._histogram(np.zeros(len(own), int), 1, x[:, own], g[own], 12)
            assert split == boosting._best_splits(hist, allowed, params, 2.0**20)[0]
        if split[0] >= 0:
            right = x[split[0], own] > split[1]
            rows |= {2 * node + 1: own[~right], 2 * node + 2: own[right]}
    assert not found


def test_features_share_bytes():
    """Few bytes hold all features; what is counted by byte gives the sums by bin, and rows go the ways of their bins."""
    rng = np.random.default_rng(6)
    sizes = [24, 2, 2, 64, 5, 1, 3, 2, 64, 7]
    bundles = boosting.bundled(sizes)
    assert len(bundles.totals) == 4 and max(bundles.totals) <= 256
    bins = np.stack([rng.integers(0, s, 800) for s in sizes])
    x = np.zeros((4, 800), np.int64)
    np.add.at(x, bundles.byte, bins * bundles.step[:, None])
    assert x.max() < 256 and (x[bundles.byte] // bundles.step[:, None] % bundles.size[:, None] == bins).all()
    x, own, g = x.astype(np.uint8), bins.astype(np.uint8), np.rint(rng.normal(size=800) * 2.0**20)
    node = rng.integers(0, 3, 800)
    by_byte = boosting._histogram(node, 3, x, g, bundles.span)
    assert (bundles.by_bin(by_byte, 64) == boosting._histogram(node, 3, own, g, 64)).all()
    params, allowed = training.boosted(1, 5, l2=1.0), np.ones(len(sizes), bool)
    found = boosting._grow_here(0, x, g, allowed, params, 2.0**20, 64, bundles)
    assert found == boosting._grow_here(0, own, g, allowed, params, 2.0**20, 64)
    tree = boosting._empty_tree(5)
    for i, feature, cut, *_ in found:
        tree["feature"][i], tree["bin"][i] = feature, cut
    route = boosting._route(tree, bundles, 64, 0.1)
    assert (boosting._follow(route, x, 5, bundles.cuts(64)) == boosting._walk(tree, own, 5)).all()
    assert (boosting._follow(boosting._route(tree, bundles, 64, 0.1), x, 2, bundles.cuts(64)) == boosting._walk(tree, own, 2)).all()


def test_nodes_are_dealt_evenly(spark):
    """Every node has a group of its own, and the tasks about as many rows each."""
    homes = boosting._homes(spark)
    tasks = {slot: task for task, slots in enumerate(homes) for slot in slots}
    sizes = {(job, node): 1000 + job for job in range(15) for node in (1, 2)} | {(job, -1): 0 for job in range(15)}
    slots = boosting._dealt(sizes, homes)
    assert len(set(slots.values())) == len(sizes)
    load = [sum(sizes[k] for k, slot in slots.items() if tasks[slot] == task) for task in range(len(homes))]
    assert max(load) - min(load) <= 1014
    few = boosting._dealt(sizes, [[0], [1]])
    assert len(set(few.values())) == len(sizes)


def test_growth_stops_after_the_best_round(spark, table):
    noise = table.withColumn("demand", F.rand(5))
    fits = [boosting.Fit(training.boosted(200, 6, rate=0.5), fold, True) for fold in range(3)]
    boosting.grow(noise, fits, patience=4)
    for fit in fits:
        assert len(fit.errors) == len(fit.trees) == fit.best() + 4
        assert min(fit.errors) == fit.errors[fit.best() - 1]
    short = boosting.Fit(training.boosted(3, 2), stop=True)
    edges = boosting.grow(table, [short], patience=50)
    assert len(short.errors) == len(short.trees) == 3
    aside = table.where(boosting.stop_rows())
    model = boosting.as_model(spark, short, edges)
    error = model.transform(aside).agg(F.avg((F.col("prediction") - F.col("demand")) ** 2)).first()[0]
    assert error == pytest.approx(min(short.errors), abs=1e-7)


def test_folds_are_never_seen(spark, table):
    spoiled = table.withColumn("demand", F.when(F.col("fold") == 1, F.lit(1e6)).otherwise(F.col("demand")))
    fit = boosting.Fit(training.boosted(3, 3), 1, True)
    model = boosting.as_model(spark, fit, boosting.grow(spoiled, [fit]))
    assert model.transform(table).agg(F.max("prediction")).first()[0] < 10


def test_odd_targets(spark, table):
    some = table.limit(40).withColumn("demand", F.when(F.col("Index") % 2 == 0, F.lit(2.0)))
    model = training.fit(training.boosted(2, 3), some)
    assert {r.prediction for r in model.transform(table).collect()} == {2.0}
    with pytest.raises(ValueError):
        training.fit(training.boosted(2, 3), table.withColumn("demand", F.lit(None).cast("double")))
    with pytest.raises(ValueError):
        training.fit(training.boosted(2, 99), table)


# ---- attribution


def expectation(table, x, known):
    """A tree's value where only the features ``known`` of ``x`` are known."""
    total = 0.0
    for i, value in enumerate(table.value):
        part = value
        for k, low, high, share in zip(table.feature[i], table.low[i], table.high[i], table.share[i]):
            if k in known:
                part *= low < x[k] <= high
            else:
                part *= share
        total += part
    return total


def by_subsets(trees, x):
    m = len(x)
    phi = np.zeros(m)
    for i in range(m):
        for size in range(m):
            for known in itertools.combinations([j for j in range(m) if j != i], size):
                weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                phi[i] += weight * sum(expectation(t, x, {*known, i}) - expectation(t, x, set(known)) for t in trees)
    return phi


@pytest.fixture(scope="module", params=["forest", "boosted"])
def model(request, table):
    if request.param == "forest":
        return RandomForestRegressor(labelCol="demand", numTrees=5, maxDepth=4, seed=1, featureSubsetStrategy="all").fit(table)
    return training.fit(training.boosted(rounds=5, depth=4, rate=0.4), table)


def test_attribution_equals_all_subsets(spark, table, model):
    phi, base = tree_attribution(table, model, NAMES)
    trees = leaf_paths(model, spark)
    x, _ = arrays(table)
    got = {}
    for r in phi.where("Index < 12").collect():
        got.setdefault(r.Index, {})[r.feature] = (r.value, r.phi)
    for index, values in got.items():
        want = by_subsets(trees, x[index])
        assert [values[n][0] for n in NAMES] == list(x[index])
        assert [values[n][1] for n in NAMES] == pytest.approx(list(want), abs=1e-10)
    assert base.first()[0] == pytest.approx(sum(expectation(t, x[0], set()) for t in trees))


def test_attribution_of_all_rows_adds_up(spark, table, model):
    whole = {(r.Index, r.feature): r.phi for r in tree_attribution(table, model, NAMES)[0].collect()}
    assert len(whole) == 900 * 4 and all(abs(whole[i, "d"]) < 1e-12 for i in range(900))
    phi, base = tree_attribution(table.repartition(7), model, NAMES, part_bytes=1)
    sums = phi.groupBy("Index").agg(F.sum("phi").alias("s"))
    off = model.transform(table).join(sums, "Index").select(F.abs(F.col("s") + base.first()[0] - F.col("prediction")).alias("d"))
    assert off.count() == 900 and off.agg(F.max("d")).first()[0] < 1e-9
    for r in phi.collect():
        assert r.phi == pytest.approx(whole[r.Index, r.feature], abs=1e-10)


def test_attribution_of_no_rows(spark, table, model):
    odd = table.where("Index < 3").withColumn("features", F.when(F.col("Index") > 0, F.col("features")))
    assert tree_attribution(odd, model, NAMES)[0].count() == 8
    assert tree_attribution(odd.where("Index < 0"), model, NAMES)[0].count() == 0


def test_leaves_of_the_last_level_are_not_visited(spark, table, monkeypatch):
    """A pass for every level but the last, whose sums are the splits'; nothing but the rows of the model stays behind."""
    passes, visit = [], boosting._passed

    def passed(rows, work):
        passes.append([len(a[3]) + len(a[4]) for a in work.active.values()])
        return visit(rows, work)

    monkeypatch.setattr(boosting, "_passed", passed)
    removed = []
    monkeypatch.setattr(boosting, "remove", lambda s, path: removed.append(path.rsplit("/", 1)[1].rsplit("-", 1)[0]))
    fit = boosting.Fit(training.boosted(1, 3, min_leaf=7))
    boosting.grow(table, [fit], local_rows=0)
    assert passes == [[1], [2], [4]]
    whole = boosting.Fit(training.boosted(1, 3, min_leaf=7))
    boosting.grow(table, [whole])
    assert set(whole.trees[0]["stats"].items()) == set(fit.trees[0]["stats"].items()) and len(fit.trees[0]["stats"]) == 15
    assert sorted(removed[:2]) == ["binned", "boosting-rows"]
