"""Model training and selection.

The kinds of models, the grids and the selection rules are fixed defaults; every grid is a
parameter.  Fits of one kind run side by side over the same blocks of rows (``blocks``): folds, outer folds, seeds and grid points are
fits, and one fit serves several points (``boost``: rounds; ``forest``: trees and depths; ``linear``: penalties from the same sums).
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatspan.functions.schema import as_double, content_id
from flatspan.functions.seeded import placed_rows
from flatspan.operators import clean, evaluate, facts, isotonic, select, split
from flatspan.operators.blocks import Blocks, Fit, add_up, keyed, make_blocks
from flatspan.operators.boost import Boosting
from flatspan.operators.forest import MAX_DEPTH, Forest, Spec
from flatspan.operators.linear import Logistic, linear_fits
from flatspan.operators.models import FittedModel, values
from flatspan.session import write_stage

log = logging.getLogger(__name__)

SEED, FOLDS, OUTER_FOLDS = 42, 5, 3
IMPORTANCE_REPEATS = 10
ECE_LIMIT, CALIBRATION_FOLDS, ISOTONIC_ROWS = 0.05, 3, 1000
SEEDS = (42, 7, 123, 2024, 99)

Grid = dict[str, list]

# The default grids.
GRIDS: dict[str, Grid] = {
    "logistic_regression": {"C": [0.01, 0.1, 1, 10]},
    "linear_regression": {},
    "random_forest": {"trees": [100, 200], "depth": [5, 10, None]},
    "gradient_boosting": {"iterations": [100, 200], "rate": [0.05, 0.1]},
}


@dataclass
class Config:
    """What a run may change; the defaults are the full search.  ``calibration`` is isotonic, sigmoid, or auto: isotonic from
    ``ISOTONIC_ROWS`` training rows on."""

    test_size: float = 0.2
    seed: int = SEED
    folds: int = FOLDS
    grids: dict[str, Grid] = field(default_factory=lambda: GRIDS)
    max_classes: int = 20
    top_features: int | None = None
    calibration: str = "auto"
    importance_repeats: int = IMPORTANCE_REPEATS
    nested: bool = True
    outer_folds: int = OUTER_FOLDS
    segment_columns: list[str] | None = None


@dataclass
class Prepared:
    """All rows as ``frame`` with ``features``, ``label`` (index or number), ``actual``, and the split columns of one seed: which rows
    are tested, their fold, their outer fold, and within the rows outside of each outer fold the inner ones."""

    frame: DataFrame
    features: list[str]
    task: str
    labels: list
    id_col: str
    strategy: str
    seed: int = SEED
    blocks: Blocks | None = None

    def column(self, name: str) -> str:
        return f"{name}_{self.seed}"

    @property
    def train(self) -> DataFrame:
        return self.frame.where(F.col(self.column("test")) == 0)

    @property
    def test(self) -> DataFrame:
        return self.frame.where(F.col(self.column("test")) == 1)

    @property
    def n_classes(self) -> int:
        return 0 if self.task == split.REGRESSION else len(self.labels)

    @cached_property
    def n_train(self) -> int:
        return self.train.count()

    def release(self) -> None:
        self.frame.unpersist()
        if self.blocks is not None:
            self.blocks.release()

    # --- fits ---

    @property
    def whole(self) -> Fit:
        """All training rows."""
        return Fit(((self.column("test"), 1),))

    def folds(self, n: int) -> list[Fit]:
        test, fold = self.column("test"), self.column("fold")
        return [Fit(((test, 1), (fold, k)), (fold, k)) for k in range(n)]

    def outer(self, n: int) -> list[Fit]:
        test, outer = self.column("test"), self.column("outer")
        return [Fit(((test, 1), (outer, k)), (outer, k)) for k in range(n)]

    def inner(self, outer: int, n: int) -> list[Fit]:
        test, of, inner = self.column("test"), self.column("outer"), self.column(f"inner{outer}")
        return [Fit(((test, 1), (of, outer), (inner, k)), (inner, k)) for k in range(n)]

    def parts(self, n: int) -> list[Fit]:
        test, part = self.column("test"), self.column("part")
        return [Fit(((test, 1), (part, k)), (part, k)) for k in range(n)]


class Result:
    """A finished run; what few callers need (nested scores, calibration, importances) is worked out when it is first asked for."""

    def __init__(self, p: Prepared, best: str, params: dict, model: FittedModel, fold_scores: DataFrame, config: Config) -> None:
        self.prepared, self.best, self.params, self.model, self.fold_scores, self.config = p, best, params, model, fold_scores, config
        self.task, self.features = p.task, p.features
        self.board = select.leaderboard(fold_scores)
        self.scored = score_frame(model, p.test, p)

    @cached_property
    def metrics(self) -> dict[str, float]:
        return test_metrics(self.scored, self.prepared)

    @cached_property
    def importances(self) -> DataFrame:
        return permutation_importance(self.model, self.prepared.test, self.prepared, self.config.importance_repeats, self.config.top_features, self.config.seed)

    @cached_property
    def nested(self) -> tuple[float, float] | None:
        return nested_cv(self.prepared, self.best, self.config) if self.config.nested else None

    @cached_property
    def calibrated(self) -> DataFrame | None:
        """Test rows with calibrated scores, where the raw error asks for them; None where it does not."""
        if "score" not in self.scored.columns or calibration_row(self.scored, "raw", None).first()["ece"] <= ECE_LIMIT:
            return None
        return calibrated_scores(self.prepared, self.best, self.params, self.config)


# --- preparation ------------------------------------------------------------------------------


def prepare(df: DataFrame, target: str, id_col: str, group_col: str | None = None, config: Config = Config()) -> Prepared:
    """Feature matrix, task, split, overlap guard, fills, blocks."""
    return prepare_seeds(df, target, id_col, group_col, config, [config.seed])[0]


def prepare_seeds(df: DataFrame, target: str, id_col: str, group_col: str | None, config: Config, seeds: list[int]) -> list[Prepared]:
    """``prepare`` for several seeds.  Missing feature values are filled with the training rows' medians; seeds with the same fills
    share their rows and blocks."""
    if id_col not in df.columns:
        log.warning("no column %r: rows are told apart by their content", id_col)
        df = content_id(df, id_col)
    features, _, _ = split.feature_matrix(df, target, id_col, group_col)
    if group_col not in df.columns:
        group_col = None
    rows = df.where(F.col(target).isNotNull())
    task = split.detect_task_type(rows, target, config.max_classes)
    classify = task != split.REGRESSION
    labels: list = []
    label: Column = as_double(target)
    if classify:
        labels = [r[0] for r in rows.select(target).distinct().orderBy(target).collect()]  # max_classes at most, or two
        label = (F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(target)) - 1).cast("double")
    keep = [id_col, *([group_col] if group_col and group_col != id_col else [])]
    base = rows.select(*keep, *[as_double(c).alias(c) for c in features if c not in keep], F.col(target).alias("actual"), label.alias("label"))
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    gaps = [r["column_name"] for r in clean.missing_fractions(base.select(*features)).where("missing_fraction > 0").collect()]
    by, out = "label" if classify else None, []
    places, fills_of = {}, {}
    for seed in seeds:
        named = replace(config, seed=seed)
        places[seed] = split_places(base, id_col, group_col, by, named)
        fills = clean.FillValues()
        if gaps:
            fills = clean.fit_fill_values(base.where(places[seed]["test"] == 0).select(*gaps))
            fills.numeric = {c: 0.0 if v is None else v for c, v in fills.numeric.items()}
        fills_of.setdefault(tuple(sorted(fills.numeric.items())), (fills, []))[1].append(seed)
    for fills, some in fills_of.values():
        ready = clean.fill_missing(base, fills) if gaps else base
        splits = {f"{name}_{seed}": place for seed in some for name, place in places[seed].items()}
        ready = ready.withColumns(splits)
        frame = VectorAssembler(inputCols=features, outputCol="features").transform(ready).select(id_col, *[c for c in features if c != id_col], "actual", "label", "features", *splits)
        frame = write_stage(frame, "training").persist(StorageLevel.MEMORY_AND_DISK)
        blocks = make_blocks(frame, id_col, list(splits), len(labels))
        for seed in some:
            out.append(Prepared(frame, features, task, labels, id_col, "grouped" if group_col else "row_random", seed, blocks))
    base.unpersist()
    return sorted(out, key=lambda p: seeds.index(p.seed))


def split_places(base: DataFrame, id_col: str, group_col: str | None, by: str | None, config: Config) -> dict[str, Column]:
    """The split columns of a seed, as expressions over ``base``; a row that a column does not concern has -1."""
    if group_col:
        divided = split.split_groups(base, group_col, config.test_size, config.seed)
        if not split.group_overlap(divided, group_col).isEmpty():
            raise ValueError(f"groups of {group_col!r} are on both sides of the split")
    is_test = split.test_rows(base, group_col or id_col, config.test_size, config.seed, None if group_col else by, bool(group_col))
    inside = base.where(~is_test)
    fold = lambda df, n, seed: split.fold_number(df, id_col, n, by, seed)
    wanted = {"fold": (config.folds, config.seed), "part": (CALIBRATION_FOLDS, config.seed), **({"outer": (config.outer_folds, config.seed + 1)} if config.nested else {})}
    places = {"test": is_test.cast("int")}
    with ThreadPoolExecutor(4) as pool:  # each has jobs of its own, which are small
        found = dict(zip(wanted, pool.map(lambda x: fold(inside, *x), wanted.values()), strict=True))
        places.update({name: F.when(~is_test, number) for name, number in found.items()})
        if config.nested:
            rests = [~is_test & (found["outer"] != k) for k in range(config.outer_folds)]
            inner = pool.map(lambda rest: fold(base.where(rest), config.folds, config.seed), rests)
            places.update({f"inner{k}": F.when(rest, number) for k, (rest, number) in enumerate(zip(rests, inner, strict=True))})
    return {name: F.coalesce(place.cast("int"), F.lit(-1)) for name, place in places.items()}


# --- candidates -------------------------------------------------------------------------------


def candidates(task: str) -> list[str]:
    first = "linear_regression" if task == split.REGRESSION else "logistic_regression"
    return [first, "random_forest", "gradient_boosting"]


def grid_points(grid: Grid) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())] or [{}]


def forest_spec(points: list[dict], blocks: Blocks, seed: int) -> Spec:
    """One growth for all points: the most trees and the largest depth."""
    depth = max(p.get("depth") or MAX_DEPTH for p in points)
    tried = max(int(blocks.features**0.5), 1) if blocks.n_classes else blocks.features
    return Spec(max(p.get("trees", 100) for p in points), depth, tried, points[0].get("bootstrap", True), seed, blocks.n_classes)


def fold_score(counts: np.ndarray, n_classes: int) -> float:
    """What selection maximises: macro F1 from actual x predicted counts, or minus the root mean squared error; NaN without rows."""
    if not n_classes:
        return round(-float((counts[1] / counts[0]) ** 0.5), 6) if counts[0] else float("nan")
    sides = counts.sum(axis=0) + counts.sum(axis=1)
    there = sides > 0
    return round(float((2 * np.diag(counts)[there] / sides[there]).mean()), 6) if there.any() else float("nan")


def fit_scores(blocks: Blocks, name: str, points: list[dict], fits: list[Fit], seed: int, models: dict | None = None) -> np.ndarray:
    """The score of every grid point (rows) in every fit (columns).  Models that come with the search are left in ``models``, by
    point and fit: every fit of a boosted grid holds those of its points."""
    k, out = blocks.n_classes, np.full((len(points), len(fits)), np.nan)
    if name == "linear_regression":
        errors = linear_fits(blocks, fits)[1]
        out[:] = [fold_score(e, 0) for e in errors]
    elif name == "logistic_regression":
        counts = Logistic(blocks, [(f, p.get("C", 1.0)) for p in points for f in fits]).confusion()
        out[:] = np.array([fold_score(c, k) for c in counts]).reshape(out.shape)
    elif name == "random_forest":
        for drawn in {p.get("bootstrap", True) for p in points}:
            mine = [i for i, p in enumerate(points) if p.get("bootstrap", True) == drawn]
            spec = forest_spec([points[i] for i in mine], blocks, seed)
            sizes = sorted({points[i].get("trees", 100) for i in mine})
            cuts = sorted({points[i].get("depth") or MAX_DEPTH for i in mine})
            counts = Forest(blocks, fits, spec).scores(cuts, sizes)
            for i in mine:
                s, c = sizes.index(points[i].get("trees", 100)), cuts.index(points[i].get("depth") or MAX_DEPTH)
                out[i] = [fold_score(counts[m, s, c], k) for m in range(len(fits))]
    elif name == "gradient_boosting":
        rates = sorted({p.get("rate", 0.1) for p in points})
        boosting = Boosting(blocks, fits * len(rates), [r for r in rates for _ in fits])
        for rounds in sorted({p.get("iterations", 100) for p in points}):
            boosting.grow(rounds)
            counts = boosting.confusion() if k else boosting.squared_errors()
            for i, p in enumerate(points):
                if p.get("iterations", 100) == rounds:
                    at = rates.index(p.get("rate", 0.1)) * len(fits)
                    out[i] = [fold_score(c, k) for c in counts[at : at + len(fits)]]
                    if models is not None:
                        models.update({(i, j): boosted_model(boosting, at + j, rounds) for j, f in enumerate(fits) if f.held is None})
        boosting.release()
    else:
        raise ValueError(f"no model named {name!r}")
    return out


def fitted_models(blocks: Blocks, name: str, params: dict, fits: list[Fit], seed: int) -> list[FittedModel]:
    """The model of one grid point for every fit."""
    k = blocks.n_classes
    if name == "linear_regression":
        return [FittedModel("linear", 0, {"beta": b[None]}) for b in linear_fits(blocks, fits)[0]]
    if name == "logistic_regression":
        return [FittedModel("logistic", k, {"beta": b}) for b in Logistic(blocks, [(f, params.get("C", 1.0)) for f in fits]).beta]
    if name == "random_forest":
        spec = forest_spec([params], blocks, seed)
        return [FittedModel("forest", k, together(Forest(blocks, [f], spec).trees())) for f in fits]
    if name == "gradient_boosting":
        boosting = Boosting(blocks, fits, [params.get("rate", 0.1)] * len(fits))
        boosting.grow(params.get("iterations", 100))
        boosting.release()
        return [boosted_model(boosting, m, params.get("iterations", 100)) for m in range(len(fits))]
    raise ValueError(f"no model named {name!r}")


def boosted_model(boosting: Boosting, fit: int, rounds: int) -> FittedModel:
    """The first trees of a fit, with thresholds in place of bins."""
    trees, blocks, mine = boosting.trees, boosting.blocks, slice(fit * boosting.outputs, (fit + 1) * boosting.outputs)
    feature, cut, value = (np.stack([t[mine] for t in x[:rounds]]) for x in (trees.feature, trees.cut, trees.value))
    edges = np.full((max(blocks.features, 1), 256), np.inf)
    for j, e in enumerate(blocks.edges):
        edges[j, : len(e)] = e
    return FittedModel("boosting", blocks.n_classes, {"feature": feature, "threshold": edges[feature, cut], "value": value, "base": trees.base[mine]})


def together(trees: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The nodes of all trees in one table; ``roots`` are the places of the first ones."""
    starts = np.cumsum([0, *[len(t["feature"]) for t in trees]])
    out = {n: np.concatenate([t[n] + (start if n in ("left", "right") else 0) for t, start in zip(trees, starts, strict=False)]) for n in ("feature", "threshold", "left", "right", "value")}
    return {**out, "roots": starts[:-1]}


def fit_on(p: Prepared, name: str, params: dict, frame: DataFrame, seed: int) -> FittedModel:
    """Fit one point of a grid on all rows of ``frame`` (features, label); class weights come from these rows."""
    blocks = make_blocks(frame, p.id_col, [], p.n_classes)
    model = fitted_models(blocks, name, params, [Fit()], seed)[0]
    blocks.release()
    return model


def best_point(scores: np.ndarray) -> int:
    """The point with the highest mean over its fits; the first of equal ones."""
    means = np.array([np.nanmean(s) if np.isfinite(s).any() else -np.inf for s in scores])
    return int(means.argmax())


def grid_search(p: Prepared, name: str, config: Config) -> tuple[dict, list[float]]:
    """(best parameters, their fold scores); the first of equal points stays."""
    points = grid_points(config.grids.get(name, {}))
    scores = fit_scores(p.blocks, name, points, p.folds(config.folds), config.seed)
    best = best_point(scores)
    return points[best], [s for s in scores[best].tolist() if s == s]


def nested_cv(p: Prepared, name: str, config: Config, outer: int = OUTER_FOLDS) -> tuple[float, float] | None:
    """Score of the winner when its parameters are tuned anew inside each outer fold: (mean, population deviation); None
    where nothing was tuned.  Inner and outer fits of all points are one search."""
    if not config.grids.get(name):
        return None
    points = grid_points(config.grids[name])
    fits = [f for k in range(outer) for f in p.inner(k, config.folds)] + p.outer(outer)
    scores = fit_scores(p.blocks, name, points, fits, config.seed)
    held = [scores[best_point(scores[:, k * config.folds : (k + 1) * config.folds]), outer * config.folds + k] for k in range(outer)]
    return round(float(np.mean(held)), 6), round(float(np.std(held)), 6)


# --- scored frames ----------------------------------------------------------------------------


def score_frame(model: Model, frame: DataFrame, p: Prepared) -> DataFrame:
    """Test rows with actual, label, predicted and, where the model has probabilities, score (of the
    last class of two) and confidence (of the predicted class)."""
    out = model.transform(frame)
    if p.task == split.REGRESSION:
        return out.withColumn("predicted", F.col("prediction"))
    names = F.array(*[F.lit(v) for v in p.labels])
    out = out.withColumn("predicted", F.element_at(names, F.col("prediction").cast("int") + 1))
    if "probability" not in out.columns:
        return out.withColumn("confidence", F.lit(None).cast("double"))
    chance = vector_to_array("probability")
    out = out.withColumn("confidence", F.element_at(chance, F.col("prediction").cast("int") + 1))
    return out.withColumn("score", chance[1]) if len(p.labels) == 2 else out


def test_metrics(scored: DataFrame, p: Prepared) -> dict[str, float]:
    if p.task == split.REGRESSION:
        row = evaluate.regression_metrics(scored, len(p.features)).first().asDict()
        return {k: v for k, v in row.items() if v is not None}
    out = evaluate.macro_scores(scored, "label", "prediction").first().asDict()
    if "score" in scored.columns:
        auc = evaluate.roc_auc(scored, "label", "score")
        if auc is not None:
            out["roc_auc"] = round(auc, 6)
    return out


#: Rows of a range of the seeded order; a range takes values from itself and the next.
RANGE_ROWS = 8192
RANGE = "range long, n int, x binary, y binary"


def row_ranges(frame: DataFrame, p: Prepared, seed: int, size: int) -> DataFrame:
    """``RANGE`` rows: the rows in a seeded order, ``size`` of them together."""
    d = len(p.features)
    rows = placed_rows(frame.select(p.id_col, "label", vector_to_array("features").alias("x")), p.id_col, seed)
    rows = rows.withColumn("range", F.floor(F.col("at") / size)).repartition("range").sortWithinPartitions("range", "at").select("range", "x", "label")

    def pack(batches):
        now, held = None, []
        for batch in batches:
            at = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
            for low, high in zip(cuts, [*cuts[1:], len(at)], strict=True):
                if now is not None and at[low] != now:
                    yield range_batch(now, held, d)
                    held = []
                now = int(at[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield range_batch(now, held, d)

    return rows.mapInArrow(pack, RANGE)


def range_batch(number: int, held: list, d: int):
    import pyarrow as pa

    table = pa.concat_batches(held)
    x = table.column(1).flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, d)
    y = table.column(2).to_numpy(zero_copy_only=False)
    return pa.RecordBatch.from_pydict({"range": pa.array([number], pa.int64()), "n": pa.array([len(y)], pa.int32()), "x": [x.tobytes()], "y": [y.tobytes()]})


def permutation_importance(
    model: FittedModel,
    frame: DataFrame,
    p: Prepared,
    repeats: int = IMPORTANCE_REPEATS,
    top: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Drop of the model's own score (accuracy or R²) when one feature is shuffled.

    All rows take part.  They are sorted in a seeded order over ranges once.  For each feature and repeat a row takes the value of the row
    a seeded distance further on, round the end; distances are shorter than a range, so a range needs the next one only, and rows
    are shuffled once for all features and repeats.  Copies are scored where their rows are, a feature at a time.
    """
    d, classify = len(p.features), bool(p.n_classes)
    spark = frame.sparkSession
    ranges = write_stage(row_ranges(frame, p, seed, RANGE_ROWS), "importance").persist(StorageLevel.MEMORY_AND_DISK)
    count, n = ranges.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not count:
        return facts.importance_summary(spark.createDataFrame([], "feature string, drop double"), top)
    reach = min(n, RANGE_ROWS)
    copy = F.col("id").cast("int")
    copies = spark.range(d * repeats).select((1 + F.pmod(F.xxhash64(F.lit(seed), copy), F.lit(max(reach - 1, 1)))).alias("a"), "id").orderBy("id")
    ahead = np.array([r["a"] for r in copies.collect()]).reshape(d, repeats)  # one a feature and repeat
    following = lambda c: F.pmod(F.col(c) - 1, F.lit(count))
    after = ranges.select(following("range").alias("range"), F.col("x").alias("x1"))
    more = ranges.select(F.pmod(F.col("range") - 2, F.lit(count)).alias("range"), F.col("x").alias("x2"))  # behind a short last range
    near = ranges.join(after, "range").join(more, "range").select("x", "y", "x1", "x2")
    kind, n_classes, known = model.kind, p.n_classes, model.shared(spark)

    def measured(x: np.ndarray, y: np.ndarray) -> float:
        v = values(kind, n_classes, known.value, x)
        return float((v.argmax(axis=1) == y).sum()) if classify else float(((v[:, 0] - y) ** 2).sum())

    def run(batches):
        total = np.zeros(3 + d * repeats)  # the rows' y and y squared, the model's own score, one a copy
        for batch in batches:
            for i in range(batch.num_rows):
                x, y, x1, x2 = (np.frombuffer(batch.column(c)[i].as_buffer()) for c in range(4))
                x = x.reshape(len(y), d)
                chain = x if count == 1 else np.concatenate([x, x1.reshape(-1, d), x2.reshape(-1, d)])  # the values that follow
                total[:3] += y.sum(), (y * y).sum(), measured(x, y)
                for f in range(d):
                    for r in range(repeats):
                        other = x.copy()
                        other[:, f] = chain[(np.arange(len(y)) + ahead[f, r]) % len(chain), f]
                        total[3 + f * repeats + r] += measured(other, y)
        yield keyed([0], [total])

    rows = add_up(near.mapInArrow(run, "key int, sums binary")).collect()  # one row
    total = sum(np.frombuffer(r["sums"]) for r in rows)
    square = total[1] - total[0] ** 2 / n
    score = (lambda s: s / n) if classify else (lambda s: 1 - s / square if square > 0 else float("nan"))
    drops = [(name, float(score(total[2]) - score(total[3 + f * repeats + r]))) for f, name in enumerate(p.features) for r in range(repeats)]
    ranges.unpersist()
    summary = facts.importance_summary(spark.createDataFrame(drops, "feature string, drop double"), top)
    return spark.createDataFrame(summary.collect(), summary.schema)  # a row for each feature


# --- calibration ------------------------------------------------------------------------------


def calibrated_scores(p: Prepared, name: str, params: dict, config: Config = Config(), method: str | None = None) -> DataFrame:
    """Test rows with ``score`` averaged over the folds' calibrated models: each model is fitted without a fold and its calibrator on
    that fold."""
    method = method or calibration_method(p, config)
    fits = p.parts(CALIBRATION_FOLDS)
    test = p.test.select(p.id_col, "actual", "label", "features")
    parts = None
    for fit, model in zip(fits, fitted_models(p.blocks, name, params, fits, config.seed), strict=True):
        chance = lambda df: model.transform(df).withColumn("p", vector_to_array("probability")[1])  # noqa: B023, E731
        held = chance(p.frame.where(F.col(fit.held[0]) == fit.held[1])).select("label", "p")
        # Equal scores are one weighted point, so the calibrator's input is as small as it can be.
        points = held.groupBy("p").agg(F.avg("label").alias("y"), F.count(F.lit(1)).cast("double").alias("n"))
        scored = chance(test).select(p.id_col, "actual", "label", "p")
        part = isotonic.apply(isotonic.fit(points), scored, "p", "score") if method == "isotonic" else sigmoid(points, scored)
        part = part.select(p.id_col, "actual", "label", "score")
        parts = part if parts is None else parts.unionByName(part)
    mean = parts.groupBy(p.id_col).agg(F.first("actual").alias("actual"), F.first("label").alias("label"), F.avg("score").alias("score"))
    return write_stage(mean, "calibrated")


def calibration_method(p: Prepared, config: Config) -> str:
    if config.calibration != "auto":
        return config.calibration
    return "isotonic" if p.n_train >= ISOTONIC_ROWS else "sigmoid"


def sigmoid(points: DataFrame, scored: DataFrame) -> DataFrame:
    """``scored`` with ``score``: a logistic curve over ``p``, by Newton steps over weighted points (p, y, n)."""
    slope, shift = 0.0, 0.0
    for _ in range(30):
        q = 1 / (1 + F.exp(-(F.lit(slope) * F.col("p") + F.lit(shift))))
        gap, second = F.col("n") * (q - F.col("y")), F.col("n") * q * (1 - q)
        terms = [gap * F.col("p"), gap, second * F.col("p") * F.col("p"), second * F.col("p"), second]
        a, b, aa, ab, bb = (float(x or 0.0) for x in points.agg(*[F.sum(t) for t in terms]).first())
        move = np.linalg.lstsq(np.array([[aa + 1e-9, ab], [ab, bb + 1e-9]]), np.array([a, b]), rcond=None)[0]
        slope, shift = slope - float(np.clip(move[0], -10, 10)), shift - float(np.clip(move[1], -10, 10))
        if np.abs(move).max() < 1e-9:
            break
    return scored.withColumn("score", 1 / (1 + F.exp(-(F.lit(slope) * F.col("p") + F.lit(shift)))))


def calibration_row(scored: DataFrame, series: str, method: str | None) -> DataFrame:
    ece = evaluate.calibration_error(evaluate.reliability_bins(scored, "label", "score")).scalar()
    return evaluate.brier_score(scored, "label", "score").select(
        F.lit(series).alias("series"), F.lit(method).cast("string").alias("method"), ece.alias("ece"), "brier_score"
    )


def calibration_comparison(result: Result, config: Config = Config(), limit: float = ECE_LIMIT) -> DataFrame:
    """series, method, ece, brier_score: raw, and calibrated when the raw error is above the limit.

    A diagnosis only: the selected model stays as it is.
    """
    if "score" not in result.scored.columns:
        raise ValueError("calibration needs a binary model with probabilities")
    raw = calibration_row(result.scored, "raw", None)
    if raw.first()["ece"] <= limit:
        return raw
    method = calibration_method(result.prepared, config)
    same = limit == ECE_LIMIT and config == result.config and result.calibrated is not None
    scores = result.calibrated if same else calibrated_scores(result.prepared, result.best, result.params, config, method)
    return raw.unionByName(calibration_row(scores, "calibrated", method))


# --- the whole run ----------------------------------------------------------------------------


def train(
    df: DataFrame,
    target: str,
    id_col: str,
    group_col: str | None = None,
    config: Config = Config(),
    model_path: str | None = None,
) -> Result:
    """Prepare, search every candidate's grid, pick the best, refit it, evaluate it on held-out rows."""
    result = train_prepared([prepare(df, target, id_col, group_col, config)], config)[0]
    if model_path:
        result.model.write().overwrite().save(model_path)
    return result


def train_prepared(some: list[Prepared], config: Config) -> list[Result]:
    """Runs over the same blocks, one for each seed: each candidate's fits of all of them are one search, and so are the refits."""
    spark, blocks = some[0].frame.sparkSession, some[0].blocks
    rows: list[list] = [[] for _ in some]
    found: list[dict] = [{} for _ in some]
    fits = [f for p in some for f in p.folds(config.folds)]
    come: dict[str, dict] = {}
    for name in candidates(some[0].task):
        if name not in config.grids:
            continue
        points = grid_points(config.grids[name])
        # The refits on all training rows are more fits of a boosted search.
        whole = [p.whole for p in some] if name == "gradient_boosting" else []
        scores = fit_scores(blocks, name, points, fits + whole, config.seed, come.setdefault(name, {}))
        for i in range(len(some)):
            mine = scores[:, i * config.folds : (i + 1) * config.folds]
            best = best_point(mine)
            found[i][name] = best
            rows[i] += [(name, len(found[i]), k, s) for k, s in enumerate(mine[best].tolist()) if s == s]
            log.info("%s %s: %s", name, points[best], mine[best])
    winners = []
    for i in range(len(some)):
        means = {name: float(np.mean([r[3] for r in rows[i] if r[0] == name] or [-np.inf])) for name in found[i]}
        best = max(found[i], key=lambda n: round(means[n], 6))  # the first of equal candidates stays
        winners.append((best, found[i][best]))
    models: dict[int, FittedModel] = {}
    for name, point in set(winners):
        mine, params = [i for i, w in enumerate(winners) if w == (name, point)], grid_points(config.grids[name])[point]
        if come[name]:
            models.update({i: come[name][point, len(fits) + i] for i in mine})
        else:
            models.update(zip(mine, fitted_models(blocks, name, params, [some[i].whole for i in mine], config.seed), strict=True))
    out = []
    for i, p in enumerate(some):
        per_fold = spark.createDataFrame(rows[i], "model string, candidate int, fold int, score double")
        name, point = winners[i]
        out.append(Result(p, name, grid_points(config.grids[name])[point], models[i], per_fold, replace(config, seed=p.seed)))
    return out


# --- robustness over seeds --------------------------------------------------------------------


class Robustness:
    """What the seeds gave.  ``models`` and ``failed`` say which seeds have a result and which have none; a summary over fewer seeds than were
    asked for is no result, so ``metrics`` and ``features`` raise where a seed failed."""

    def __init__(self, models: DataFrame, metrics: DataFrame, features: DataFrame, failed: DataFrame, reasons: dict[int, str]) -> None:
        self.models, self.failed = models, failed  # seed, model; seed, reason
        self._metrics, self._features, self._reasons = metrics, features, reasons

    def _whole(self, found: DataFrame) -> DataFrame:
        if self._reasons:
            raise RuntimeError("no result for " + "; ".join(f"seed {seed}: {reason}" for seed, reason in self._reasons.items()))
        return found

    @property
    def metrics(self) -> DataFrame:
        """seed, metric, value."""
        return self._whole(self._metrics)

    @property
    def features(self) -> DataFrame:
        """seed, place, feature."""
        return self._whole(self._features)


#: What the rows or the columns asked for can cause; a failure of the job itself is not one of a seed and is raised.
ROW_ERRORS = (ValueError, AnalysisException)


def run_seeds(df: DataFrame, target: str, id_col: str, group_col: str | None = None, seeds: Iterable[int] = SEEDS, config: Config = Config(), top: int = 5) -> Robustness:
    """One training run per seed, without saving a model; a seed that fails for its rows is listed, and no figures are given without it.  Runs
    whose rows are filled alike are searched together, and one after the other where that fails."""
    wanted, config = list(dict.fromkeys(seeds)), replace(config, nested=False)
    if not wanted:
        raise ValueError("at least one seed is needed")
    models, metrics, features, failed = [], [], [], {}
    runs: list[list[Prepared]] = []
    try:
        groups: dict[int, list[Prepared]] = {}
        for p in prepare_seeds(df, target, id_col, group_col, config, wanted):
            groups.setdefault(id(p.blocks), []).append(p)
        runs = list(groups.values())
    except ROW_ERRORS as exc:  # what fails for the rows fails for every seed
        log.warning("seeds %s failed: %s", wanted, exc)
        failed = dict.fromkeys(wanted, first_line(exc))
    for some in runs:
        for result in results_of(some, config, failed):
            seed = result.prepared.seed
            models.append((seed, result.best))
            metrics += [(seed, k, float(v)) for k, v in result.metrics.items()]
            ranked = result.importances.orderBy(F.col("importance_mean").desc(), "feature").limit(top).collect()
            features += [(seed, i + 1, r["feature"]) for i, r in enumerate(ranked)]
        some[0].release()
    spark = df.sparkSession
    return Robustness(
        spark.createDataFrame(models, "seed int, model string"),
        spark.createDataFrame(metrics, "seed int, metric string, value double"),
        spark.createDataFrame(features, "seed int, place int, feature string"),
        spark.createDataFrame([*failed.items()], "seed int, reason string"),
        failed,
    )


def results_of(some: list[Prepared], config: Config, failed: dict[int, str]) -> list[Result]:
    """The runs of some seeds; the seeds that fail for their rows are left in ``failed`` with the reason, the others stand."""
    try:
        return train_prepared(some, config)
    except ROW_ERRORS as exc:
        log.warning("seeds %s failed: %s", [p.seed for p in some], exc)
        if len(some) == 1:
            failed[some[0].seed] = first_line(exc)
            return []
    return [result for p in some for result in results_of([p], config, failed)]


def first_line(exc: Exception) -> str:
    return (str(exc).splitlines() or [type(exc).__name__])[0]


def model_agreement(models: DataFrame) -> DataFrame:
    """model, n_seeds, is_winner, unanimous; equal counts go by name."""
    counts = models.groupBy("model").agg(F.count(F.lit(1)).alias("n_seeds"))
    total = models.agg(F.count(F.lit(1))).scalar()
    order = Window.orderBy(F.col("n_seeds").desc(), "model")  # one row per candidate model
    return counts.withColumn("is_winner", F.row_number().over(order) == 1).withColumn("unanimous", F.col("n_seeds") == total)


def metric_stability(metrics: DataFrame) -> DataFrame:
    """metric, mean, std (population), min, max over the seeds."""
    return metrics.groupBy("metric").agg(
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("std"),
        F.round(F.min("value"), 6).alias("min"),
        F.round(F.max("value"), 6).alias("max"),
    )


def feature_stability(features: DataFrame, top: int = 5) -> DataFrame:
    """feature, n_seeds, always_in_top: how many seeds have the feature among their first ``top``."""
    first = features.where(F.col("place") <= top)
    total = features.agg(F.count_distinct("seed")).scalar()
    return first.groupBy("feature").agg(F.count(F.lit(1)).alias("n_seeds")).withColumn("always_in_top", F.col("n_seeds") == total)
