"""Fits side by side over blocks, against fits made alone, closed answers and the library's own isotonic regression."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from flatspan.operators import boost, isotonic, linear, train
from flatspan.operators.blocks import Block, Blocks, Fit, make_blocks
from flatspan.operators.forest import Forest, Spec
from flatspan.operators.models import FittedModel
from flatspan.session import new_stage_path

D = 5
NAMES = [f"f{i}" for i in range(D)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    df = pd.DataFrame(rng.standard_normal((600, D)), columns=NAMES)
    df["f4"] = rng.integers(0, 3, 600)
    signal = df["f0"] * 2 + np.sin(3 * df["f1"]) + df["f2"] * df["f3"] + rng.standard_normal(600) * 0.3
    return df.assign(id=range(600), fold=rng.integers(0, 3, 600), number=signal, two=(signal > 0.7).astype(float), many=np.digitize(signal, [-1.0, 1.0]).astype(float))


@pytest.fixture(scope="module")
def blocks(spark, data):
    made = {}
    for target, k in (("number", 0), ("two", 2), ("many", 3)):
        frame = VectorAssembler(inputCols=NAMES, outputCol="features").transform(spark.createDataFrame(data)).withColumn("label", F.col(target))
        made[target] = (make_blocks(frame, "id", ["fold"], k), frame)
    return made


FOLDS = [Fit((("fold", k),), ("fold", k)) for k in range(3)]


def test_blocks_hold_all_rows(blocks, data):
    b: Blocks = blocks["two"][0]
    rows = b.frame.collect()
    assert sum(r["n"] for r in rows) == b.n_rows == 600
    for r in rows:
        x = np.frombuffer(r["x"]).reshape(-1, D)
        bins = np.frombuffer(r["bins"], "u1").reshape(D, -1)
        for j, edges in enumerate(b.edges):
            assert len(edges) < 64 and all(((x[:, j] <= e) == (bins[j] <= i)).all() for i, e in enumerate(edges))
    seen = np.concatenate([np.frombuffer(r["x"]).reshape(-1, D) for r in rows])
    assert sorted(map(tuple, seen)) == sorted(map(tuple, data[NAMES].to_numpy(float)))


@pytest.mark.parametrize("target", ["number", "two", "many"])
def test_a_boosted_model_holds_the_shorter_one(blocks, target):
    b = blocks[target][0]
    both = boost.Boosting(b, FOLDS * 2, [0.05] * 3 + [0.1] * 3)
    both.grow(6)
    early = both.confusion() if b.n_classes else both.squared_errors()
    both.grow(12)  # over a checkpoint
    late = both.confusion() if b.n_classes else both.squared_errors()
    alone = boost.Boosting(b, FOLDS[1:2], [0.1])
    alone.grow(6)
    n = both.outputs
    for i in range(6):
        assert (both.trees.feature[i][4 * n : 5 * n] == alone.trees.feature[i]).all() and (both.trees.cut[i][4 * n : 5 * n] == alone.trees.cut[i]).all()
        assert np.allclose(both.trees.value[i][4 * n : 5 * n], alone.trees.value[i], rtol=1e-9, atol=1e-12)
    score = alone.confusion() if b.n_classes else alone.squared_errors()
    assert np.allclose(early[4], score[0]) and not np.allclose(early[4], late[4])
    both.release()


def test_a_first_tree_is_the_best_one(blocks, data):
    """One round of depth 1 at rate 1 predicts the mean of the number on each side of the cut with the least squared error."""
    b = blocks["number"][0]
    model = train.fitted_models(b, "gradient_boosting", {"iterations": 1, "rate": 1.0}, [Fit()], 1)[0]
    one = boost.Boosting(b, [Fit()], [1.0], depth=1, min_rows=20)
    one.grow(1)
    x, y = data[NAMES].to_numpy(float), data["number"].to_numpy()
    best = min(((y[x[:, j] <= e].var() * (x[:, j] <= e).sum() + y[x[:, j] > e].var() * (x[:, j] > e).sum(), j, e) for j, edges in enumerate(b.edges) for e in edges if 20 <= (x[:, j] <= e).sum() <= 580))
    j, cut = one.trees.feature[0][0, 0], one.trees.cut[0][0, 0]
    assert (best[1], best[2]) == (j, b.edges[j][cut])
    left = x[:, j] <= best[2]
    assert np.allclose(one.trees.base[0] + one.trees.value[0][0], [y[left].mean(), y[~left].mean()])
    assert ((model.values(x)[:, 0] - y) ** 2).mean() < y.var() / 2


def test_softmax(spark, blocks, data):
    b, frame = blocks["many"]
    x, y = data[NAMES].to_numpy(float), data["many"].to_numpy(int)
    losses = []
    for rounds in (0, 1, 5, 15):
        model = train.fitted_models(b, "gradient_boosting", {"iterations": rounds, "rate": 0.2}, [Fit()], 1)[0] if rounds else None
        p = model.values(x) if rounds else np.full((600, 3), 1 / 3)
        assert np.allclose(p.sum(axis=1), 1) and (p > 0).all()
        weight = (600 / (3 * np.bincount(y)))[y]
        losses.append(float(-(weight * np.log(p[np.arange(600), y])).mean()))
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.5 * losses[0]
    scored = model.transform(frame).select("id", "prediction", vector_to_array("probability").alias("p")).orderBy("id").collect()
    assert np.allclose([r["p"] for r in scored], p) and [r["prediction"] for r in scored] == p.argmax(axis=1).tolist()


def held_counts(b, model, fit):
    """What a model says of the rows that a fit is scored on, by its transformer's values."""
    k, total = b.n_classes, np.zeros((max(b.n_classes, 1) ** 2 if b.n_classes else 2))
    for r in b.frame.collect():
        n = r["n"]
        block = Block(r["block"], n, np.frombuffer(r["x"]).reshape(n, -1), np.frombuffer(r["bins"], "u1").reshape(-1, n), np.frombuffer(r["y"]), {"fold": np.frombuffer(r["splits"], "<i2")})
        held = block.held(fit)
        v, y = model.values(block.x[held]), block.y[held]
        if k:
            total += np.bincount(y.astype(int) * k + v.argmax(axis=1), minlength=k * k)
        else:
            total += [held.sum(), ((v[:, 0] - y) ** 2).sum()]
    return total


@pytest.mark.parametrize("target", ["number", "two", "many"])
def test_one_forest_serves_all_points(blocks, target):
    b = blocks[target][0]
    spec = Spec(6, 30, 2, True, 7, b.n_classes)
    scores = Forest(b, FOLDS, spec).scores([2, 5, 30], [3, 6])
    split_up = Forest(b, FOLDS, spec, local_rows=60)
    assert split_up.levels > 1 and np.allclose(split_up.scores([2, 5, 30], [3, 6]), scores)
    assert Forest(b, FOLDS, spec, local_rows=5).levels > split_up.levels
    for trees, depth in ((3, 2), (6, 5), (3, 30)):
        own = Spec(trees, depth, 2, True, 7, b.n_classes)
        model = FittedModel("forest", b.n_classes, train.together(Forest(b, [FOLDS[1]], own, local_rows=60).trees()))
        want = scores[1, [3, 6].index(trees), [2, 5, 30].index(depth)].ravel()
        assert np.allclose(held_counts(b, model, FOLDS[1]), want)


def test_an_unlimited_tree_tells_its_rows_apart(blocks, data):
    b = blocks["two"][0]
    model = train.fitted_models(b, "random_forest", {"trees": 1, "depth": None, "bootstrap": False}, [Fit()], 3)[0]
    x = data[NAMES].to_numpy(float)
    binned = np.column_stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(b.edges)])
    alone = data["two"].groupby([str(v) for v in binned]).nunique()
    assert (alone == 1).all() and (model.values(x).argmax(axis=1) == data["two"]).all()


def test_linear_fits_of_all_folds(blocks, data):
    b = blocks["number"][0]
    betas, errors = linear.linear_fits(b, FOLDS)
    x, y = np.column_stack([np.ones(600), data[NAMES].to_numpy(float)]), data["number"].to_numpy()
    for k in range(3):
        inside = (data["fold"] != k).to_numpy()
        want = np.linalg.lstsq(x[inside], y[inside], rcond=None)[0]
        assert np.allclose(betas[k], want) and np.allclose(errors[k], [(~inside).sum(), ((y - x @ want)[~inside] ** 2).sum()])


@pytest.mark.parametrize("target", ["two", "many"])
def test_logistic_fits_are_the_optimum(blocks, data, target):
    b = blocks[target][0]
    points = [(f, c) for c in (0.01, 1, 100) for f in FOLDS]
    fits = linear.Logistic(b, points)
    x, y = data[NAMES].to_numpy(float), data[target].to_numpy(int)
    for beta, (fit, c) in zip(fits.beta, points, strict=True):
        inside = (data["fold"] != fit.held[1]).to_numpy()
        k = b.n_classes
        w = (inside.sum() / (k * np.bincount(y[inside])))[y[inside]]
        p = linear.chances(x[inside], beta)
        gap = ((p - np.eye(k)[y[inside]]) * w[:, None])[:, -len(beta) :]
        slope = np.column_stack([gap.sum(axis=0), gap.T @ x[inside] + beta[:, 1:] / c])
        assert np.abs(slope).max() < 1e-3  # sums over 400 rows
        held = (data["fold"] == fit.held[1]).to_numpy()
        counts = np.bincount(y[held] * k + linear.chances(x[held], beta).argmax(axis=1), minlength=k * k)
        assert (fits.confusion()[points.index((fit, c))].ravel() == counts).all()


@pytest.mark.parametrize(("target", "name", "params"), [("number", "linear_regression", {}), ("two", "logistic_regression", {"C": 1}), ("many", "logistic_regression", {"C": 1}), ("many", "random_forest", {"trees": 3}), ("number", "gradient_boosting", {"iterations": 3})])
def test_saved_models(spark, blocks, data, target, name, params):
    b, frame = blocks[target]
    model = train.fitted_models(b, name, params, [Fit()], 5)[0]
    path = new_stage_path(spark, "model")
    model.write().overwrite().save(path)
    again = FittedModel.load(path)
    x = data[NAMES].to_numpy(float)
    assert (again.values(x) == model.values(x)).all() and again.kind == model.kind
    told = [r["prediction"] for r in again.transform(frame).orderBy("id").select("prediction").collect()]
    assert np.allclose(told, model.values(x).argmax(axis=1) if b.n_classes else model.values(x)[:, 0])


@pytest.mark.parametrize("ranges", [1, 6])
@pytest.mark.parametrize("shape", ["random", "rising", "falling", "ties", "late low"])
def test_isotonic_equals_the_library(spark, ranges, shape):
    rng = np.random.default_rng(2)
    p = np.sort(rng.random(300))
    y = {"random": (rng.random(300) < p).astype(float), "rising": p**2, "falling": 1 - p, "ties": np.repeat([0.2, 0.9, 0.5], 100), "late low": np.r_[p[:250], np.zeros(50)]}[shape]
    n = rng.integers(1, 9, 300).astype(float)
    points = spark.createDataFrame(pd.DataFrame({"p": p, "y": y, "n": n}))
    library = IsotonicRegression(featuresCol="p", labelCol="y", weightCol="n", predictionCol="want").fit(points)
    asked = spark.createDataFrame(pd.DataFrame({"p": np.r_[p, -1.0, 2.0, rng.random(200), p[:5]]}))
    got = isotonic.apply(isotonic.fit(points, ranges), library.transform(asked), "p", "got").collect()
    assert len(got) == 507 and np.allclose([r["got"] for r in got], [r["want"] for r in got])


def test_importances_do_not_depend_on_ranges(spark, blocks, data, monkeypatch):
    b, frame = blocks["two"]
    model = train.fitted_models(b, "logistic_regression", {"C": 1}, [Fit()], 1)[0]
    p = train.Prepared(frame, NAMES, "binary_classification", [0, 1], "id", "row_random")
    whole = {r["feature"]: r["importance_mean"] for r in train.permutation_importance(model, frame, p, 3).collect()}
    monkeypatch.setattr(train, "RANGE_ROWS", 130)  # five ranges, the last one short
    cut = {r["feature"]: r["importance_mean"] for r in train.permutation_importance(model, frame, p, 3).collect()}
    assert whole.keys() == cut.keys() == set(NAMES) and all(abs(whole[f] - cut[f]) < 0.05 for f in NAMES)
    assert max(whole, key=whole.get) == max(cut, key=cut.get) == "f0"


def test_boosted_fits_reach_the_driver_in_bounded_parts(blocks, monkeypatch):
    """Fits whose sums would be too large together grow in parts: the same trees, and no sum above the limit."""
    b = blocks["many"][0]
    whole = boost.Boosting(b, FOLDS, [0.1] * len(FOLDS))
    whole.grow(3)
    one = whole.outputs * 2 ** (boost.DEPTH - 2) * b.features * boost.BINS * 3 * 8  # the last level of a fit
    monkeypatch.setattr(boost, "SUM_BYTES", 2 * one)
    parted, sizes = boost.Boosting(b, FOLDS, [0.1] * len(FOLDS)), []
    aggregate = parted.aggregate
    monkeypatch.setattr(parted, "aggregate", lambda of: sizes.append(aggregate(of)) or sizes[-1])
    parted.grow(3)
    assert len(parted.parts()) == 2 and max(s.nbytes for s in sizes) <= 2 * one
    for name in ("feature", "cut", "value"):
        for x, y in zip(getattr(whole.trees, name), getattr(parted.trees, name), strict=True):
            assert np.allclose(x, y, rtol=1e-9, atol=1e-12)
    whole.release()
    parted.release()


def test_a_level_of_a_forest_takes_one_pass_a_tree(blocks, monkeypatch):
    """However many nodes a level has, a block is summed once for each tree, feature and output, and each node gets its own rows."""
    from flatspan.operators import forest

    b = blocks["many"][0]
    spec = forest.Spec(2, 6, 2, True, 3, 3)
    grown, held = Forest(b, FOLDS[:1], spec, local_rows=40), b.rdd.collect()
    nodes = [(s, int(i)) for s in range(2) for i in np.flatnonzero(grown.tops.depth[s, : grown.tops.size[s]] == 2)]
    assert len(nodes) > 4
    calls, bincount, sums = [], np.bincount, {}
    monkeypatch.setattr(forest, "sum_over", lambda rdd, visit: sums.setdefault("of", visit(iter(held))))
    monkeypatch.setattr(np, "bincount", lambda *x, **y: calls.append(1) or bincount(*x, **y))
    grown.levels = 2
    got = grown.node_sums(nodes, np.tile([0, 3], (len(nodes), 1)))
    monkeypatch.undo()
    assert len(calls) <= len(held) * 2 * 2 * (spec.outputs + 2)
    for (s, node), of in zip(nodes, got, strict=True):
        for j, f in enumerate((0, 3)):
            rows = np.zeros(of.shape[1])
            for x in held:
                n = forest.draws(spec.seed, s, x.block, x.n) * x.member(FOLDS[0]) * (grown.tops.route(s, x.bins, 2) == node)
                rows += bincount(x.bins[f], n, of.shape[1])
            assert (of[j, :, -1] == rows).all()


@pytest.mark.parametrize("k", [0, 2, 3])
def test_sorted_rows_give_the_same_cut(k):
    """Nodes with few rows are cut by sorting, others by sums over bins; both give the same gain, feature and cut."""
    from flatspan.operators import forest

    rng = np.random.default_rng(k)
    n, a = 400, 60
    node, y = np.sort(np.r_[np.arange(a), rng.integers(0, a, n - a)]), rng.integers(0, k or 50, n)
    data = forest.Rows(rng.integers(0, 6, (n, D)).astype("u1"), y if k else y * 1.7 - 1000, rng.integers(1, 5, n), np.linspace(0.5, 2, max(k, 1)), k)
    rows = rng.permutation(n)
    node = node[np.argsort(rows)][rows]  # nodes in no order
    features = np.array([rng.permutation(D)[:3] for _ in range(a)])
    total = data.by_key(node, data.of(rows), a)
    few, many = (cut(data, rows, node, features, total) for cut in (forest.cut_few, forest.cut_many))
    assert (np.isfinite(few[0]) == np.isfinite(many[0])).all() and np.isfinite(few[0]).sum() > a // 2
    splits = np.isfinite(few[0])
    assert np.allclose(few[0][splits], many[0][splits], rtol=1e-9, atol=1e-9) and all((few[i][splits] == many[i][splits]).all() for i in (1, 2))


def test_scored_rows_are_added_up_where_they_are(spark, blocks, monkeypatch):
    """What trees say of a row is added up in a task before it is passed on: not a row for each node and block."""
    from flatspan.operators.blocks import COLUMNS, unpack

    b, small = blocks["two"][0], []
    for r in b.frame.collect():
        x, bins, y, splits = (np.frombuffer(r[c], t) for c, t in (("x", "<f8"), ("bins", "u1"), ("y", "<f8"), ("splits", "<i2")))
        for at in range(0, r["n"], 6):
            some = slice(at, min(at + 6, r["n"]))
            data = [x.reshape(-1, D)[some], bins.reshape(D, -1)[:, some], y[some], splits.reshape(1, -1)[:, some]]
            small.append((len(small) << 32, some.stop - at, *(bytearray(np.ascontiguousarray(v).tobytes()) for v in data)))
    frame = spark.createDataFrame(small, COLUMNS).repartition(3).persist()
    features, names = b.features, b.splits
    many = Blocks(frame, frame.rdd.map(lambda r: unpack(r[0], r[1], r[2:], features, names)), b.features, b.splits, b.edges, b.n_classes, b.n_rows)
    grown = Forest(many, FOLDS, Spec(6, 30, 2, True, 7, 2), local_rows=60)
    assert len(small) == 100 and grown.levels > 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert grown.finish([5, 30], [3, 6]).count() <= tasks * len(FOLDS) * 2
    assert (grown.scores([5, 30], [3, 6]).sum(axis=(0, 3, 4)) == 600).all()
    frame.unpersist()


def test_narrow_features_are_summed_as_one(spark, monkeypatch):
    """Features of few bins whose combinations are few are one column of sums; their trees are those of sums by feature."""
    from flatspan.operators import blocks as made

    rng = np.random.default_rng(5)
    kind, other = rng.integers(0, 4, 500), rng.integers(0, 3, 500)
    df = pd.DataFrame({f"k{i}": (kind == i).astype(float) for i in range(4)} | {f"o{i}": (other == i).astype(float) for i in range(3)})
    df = df.assign(x=rng.standard_normal(500), id=range(500), fold=rng.integers(0, 3, 500))
    df["label"] = ((kind == 1) * 1.0 + (other == 2) + df["x"] > 0.8).astype(float)
    frame = VectorAssembler(inputCols=[*df.columns[:8]], outputCol="features").transform(spark.createDataFrame(df))
    b = make_blocks(frame, "id", ["fold"], 2)
    found = made.bundles(b)
    assert [x.features.tolist() for x in found] == [[0, 1, 2, 3, 4, 5, 6]] and len(found[0].keys) == 12
    one, sizes = boost.Boosting(b, FOLDS, [0.1] * 3), []
    aggregate = one.aggregate
    monkeypatch.setattr(one, "aggregate", lambda of: sizes.append(aggregate(of)) or sizes[-1])
    one.grow(4)
    assert all(len(s) == 2 for s in sizes)  # columns: the bundle and x
    monkeypatch.setattr(boost, "bundles", lambda _: [])
    each = boost.Boosting(b, FOLDS, [0.1] * 3)
    each.grow(4)
    for x, y in zip(one.trees.value, each.trees.value, strict=True):
        assert np.allclose(x, y, rtol=1e-9, atol=1e-12)
    assert (one.confusion() == each.confusion()).all()
    monkeypatch.setattr(made, "COMBINATIONS", 5)
    assert made.bundles(b) == []  # too many to know them all
    one.release()
    each.release()
    b.release()
