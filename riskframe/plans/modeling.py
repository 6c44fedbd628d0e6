"""Model training, comparison, ablation and attribution on the applicant table.

Ready tables come from :func:`riskframe.operators.prepare.build_ready`, fitted
on the training part of the stratified split (the key is kept, so every
later comparison is a key join). Model sizes are arguments whose defaults are
the original pipeline's; model columns carry safe names.
"""

from __future__ import annotations

import functools
import operator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import blend
from riskframe.operators import attribution as attr
from riskframe.operators import binning, boosting, forest
from riskframe.operators import metrics as met
from riskframe.operators import network
from riskframe.operators import prepare as prep
from riskframe.operators.profile import class_weights, missing_profile
from riskframe.operators import train as tr
from riskframe.operators.naming import safe_name_list
from riskframe.plans import tpch
from riskframe.plans.assemble import join_families
from riskframe.session import cut_lineage
from riskframe.sources.catalog import path_exists

KEY, TARGET = tpch.KEY, tpch.TARGET

# The feature groups each ablation run includes, and the recommended runs.
EXPERIMENTS = {
    "application_only": ["application"],
    "app_plus_bureau_family": ["application", "bureau_family"],
    "app_plus_previous_application": ["application", "previous_application"],
    "app_plus_pos_cash": ["application", "pos_cash"],
    "app_plus_credit_card": ["application", "credit_card"],
    "app_plus_installments": ["application", "installments"],
    "full_features": ["application", "bureau_family", "previous_application", "pos_cash", "credit_card", "installments"],
    "full_minus_bureau_family": ["application", "previous_application", "pos_cash", "credit_card", "installments"],
    "full_minus_previous_application": ["application", "bureau_family", "pos_cash", "credit_card", "installments"],
    "full_minus_pos_cash": ["application", "bureau_family", "previous_application", "credit_card", "installments"],
    "full_minus_credit_card": ["application", "bureau_family", "previous_application", "pos_cash", "installments"],
    "full_minus_installments": ["application", "bureau_family", "previous_application", "pos_cash", "credit_card"],
}
RECOMMENDED_RUNS = ["application_only", "full_features", "full_minus_bureau_family", "full_minus_previous_application",
                    "full_minus_pos_cash", "full_minus_credit_card", "full_minus_installments"]
# The tuning grids.
LOGISTIC_GRID = {"C": [0.1, 1.0, 5.0]}
FOREST_GRID = {"n_estimators": [200, 400], "max_depth": [12, 20, None], "min_samples_leaf": [5, 10], "min_samples_split": [10, 20]}
BOOSTED_GRID = {"n_estimators": [300, 500], "learning_rate": [0.03, 0.05], "num_leaves": [31, 64, 96], "min_child_samples": [20, 50]}
NETWORK_GRID = {"hidden_dims": [(256, 128), (128, 64), (256, 64)], "dropout": [0.2, 0.3], "learning_rate": [0.001, 0.0005], "epochs": [15, 20]}
# The registered queries of single models train smaller ones than the defaults below so that each ends within
# minutes on one machine; the defaults and the grids are the original sizes.
NODE_TREES = 5  # whose nodes are written to the results of a grid at once
QUERY_TREES, QUERY_ROUNDS, QUERY_HIDDEN = 50, 50, (32, 8)

_STORED: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, key: tuple, build) -> DataFrame:
    """``build()`` written once per session to the shared checkpoint folder, then read back."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _STORED:
        _STORED[full] = cut_lineage(build())
    return _STORED[full]


def applicant_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_families(tpch.applicants(spark, sf_dir), {n: b(spark, sf_dir) for n, b in tpch.MERGED_FAMILIES.items()}, KEY)


def split_frames(spark: SparkSession, sf_dir: str):
    """Applicant table, training part, validation part; the table is built once per session."""
    split = stored(spark, ("split", sf_dir), lambda: prep.stratified_split(tpch.applicants(spark, sf_dir).select(KEY, TARGET), KEY, TARGET, 0.2, 42))
    marked = stored(spark, ("features", sf_dir), lambda: prep.mark_parts(applicant_table(spark, sf_dir), split, KEY))
    return tuple(prep.marked_part(marked, part) for part in (None, *prep.PARTS))


@dataclass
class Ready:
    """Stored train and validation vectors, with what their columns are."""

    train: DataFrame
    valid: DataFrame
    names: list[str]  # model features
    origin: list[str]  # the applicant column that each model feature comes from
    raw: list[str]
    dropped: list[str]


_READY: dict[tuple, Ready] = {}
_FITTED: dict[tuple, tuple] = {}


def _fitted(spark: SparkSession, sf_dir: str, train: DataFrame) -> tuple:
    """(spec, dropped columns): what both profiles have in common, fitted once per session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _FITTED:
        _FITTED[at] = prep.build_ready(train, None, KEY, TARGET, scale_numeric=False)[2:]
    return _FITTED[at]


def prepared(spark: SparkSession, sf_dir: str, scale: bool) -> Ready:
    """The ready tables of one profile, fitted on the train part once per session.

    Every statistic of the preparation belongs to one column, so a feature subset's ready table is
    a choice of these columns: no run over fewer columns needs a fit of its own.
    """
    at = (spark.sparkContext.applicationId, sf_dir, scale)
    if at not in _READY:
        _feats, train, valid = split_frames(spark, sf_dir)
        rt, rv, spec, dropped = prep.build_ready(train, valid, KEY, TARGET, scale_numeric=scale, unscaled=_fitted(spark, sf_dir, train))
        keep, names = [KEY, TARGET], safe_name_list(spark, spec.output_columns())
        renamed = [F.col(f"`{old}`").alias(new) for old, new in zip(spec.output_columns(), names)]
        parts = [cut_lineage(tr.assemble(df.select(*keep, *renamed), names, keep)) for df in (rt, rv)]
        origin = spec.numeric + [c for c in spec.categorical for _ in spec.categories[c]]
        _READY[at] = Ready(*parts, names, origin, [c for c in train.columns if c not in keep], dropped)
    return _READY[at]


def ready(spark: SparkSession, sf_dir: str, scale: bool):
    """(train vectors, validation vectors, model feature names, raw columns, dropped constants)."""
    r = prepared(spark, sf_dir, scale)
    return r.train, r.valid, r.names, r.raw, r.dropped


@dataclass
class Binned:
    """The tree profile's ready tables as bin numbers: what all boosted runs read."""

    train: DataFrame
    valid: DataFrame
    n_bins: int
    positive_weight: float


_BINNED: dict[tuple, Binned] = {}


def binned(spark: SparkSession, sf_dir: str) -> Binned:
    """Cut points fitted on the train part and both parts binned, once per session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _BINNED:
        r, x = prepared(spark, sf_dir, scale=False), vector_to_array("features")
        bins = binning.fit_bins(r.train, x, r.names)
        parts = [cut_lineage(binning.bin_table(df, x, bins, [KEY, TARGET])) for df in (r.train, r.valid)]
        _BINNED[at] = Binned(*parts, bins.n_bins, positive_weight(r.train))
    return _BINNED[at]


def evaluate(scores: DataFrame) -> DataFrame:
    return met.binary_metrics(scores.withColumnRenamed(TARGET, "label"), 0.5, ["model"])


def _scores(model, df, name):
    return tr.score_table(model, df, KEY, TARGET, name)


def train_logistic(spark, sf_dir, C: float = 1.0):
    t, v, _names, _, _ = ready(spark, sf_dir, scale=True)
    est = tr.logistic(C, tr.total_weight(t, TARGET, "balanced"), label=TARGET)
    model, scores = tr.fit_and_score(est, t, v, KEY, TARGET, "logistic_regression", "balanced")
    return model, scores, t, v


_FORESTS: dict[tuple, forest.Forest] = {}


def _forest(spark, sf_dir, name: str, n_trees: int, max_depth, min_leaf: int, min_split: int, class_weights: str) -> forest.Forest:
    """A forest on all features, fitted once per session. Weights taken once leave out rows without a label, as the other learners do."""
    at = (spark.sparkContext.applicationId, sf_dir, name, n_trees, max_depth, min_leaf, min_split)
    if at not in _FORESTS:
        data, features = binned(spark, sf_dir), tuple(range(len(prepared(spark, sf_dir, False).names)))
        spec = forest.ForestSpec(name, features, n_trees, max_depth, min_leaf, min_split, class_weights=class_weights)
        train = data.train.where(F.col(TARGET).isNotNull()) if class_weights == "table" else data.train
        _FORESTS[at] = forest.fit(train, data.n_bins, [spec], KEY, TARGET)[0]
    return _FORESTS[at]


def _forest_scores(df: DataFrame, models, at=None) -> DataFrame:
    return forest.score(df, models, KEY, TARGET, at).withColumnRenamed(TARGET, "label")


def train_forest(spark, sf_dir, n_trees: int = 400, max_depth=None, min_leaf: int = 5, min_split: int = 2):
    """(forest, validation scores, binned train rows, binned validation rows): class weights taken once, of the train part."""
    model, data = _forest(spark, sf_dir, "random_forest", n_trees, max_depth, min_leaf, min_split, "table"), binned(spark, sf_dir)
    return model, _forest_scores(data.valid, [model]), data.train, data.valid


def boost_spec(name: str, features, data: Binned, n_iter: int, step: float = 0.05, num_leaves: int = 31, min_child: int = 50) -> boosting.BoostSpec:
    return boosting.BoostSpec(name, tuple(features), n_iter, step, num_leaves, min_child, positive_weight=data.positive_weight)


_BOOSTED: dict[tuple, boosting.BoostedModel] = {}


def boosted_model(spark, sf_dir, n_iter: int = 500) -> boosting.BoostedModel:
    """The leaf-wise model on all features, fitted once per session."""
    at = (spark.sparkContext.applicationId, sf_dir, n_iter)
    if at not in _BOOSTED:
        data = binned(spark, sf_dir)
        spec = boost_spec("boosted_trees", range(len(prepared(spark, sf_dir, False).names)), data, n_iter)
        _BOOSTED[at] = boosting.fit(data.train, data.n_bins, [spec], KEY, TARGET)[0]
    return _BOOSTED[at]


def _boosted_scores(df: DataFrame, models, at=None) -> DataFrame:
    return boosting.score(df, models, KEY, TARGET, at).withColumnRenamed(TARGET, "label")


def train_boosted(spark, sf_dir, n_iter: int = 500):
    """(model, validation scores, binned train rows, binned validation rows)."""
    data, model = binned(spark, sf_dir), boosted_model(spark, sf_dir, n_iter)
    return model, _boosted_scores(data.valid, [model]), data.train, data.valid


_NETWORKS: dict[tuple, network.Network] = {}


def network_spec(name: str, weight: float, hidden=(256, 64), dropout: float = 0.2, learning_rate: float = 0.001, epochs: int = 20) -> network.NetworkSpec:
    return network.NetworkSpec(name, tuple(hidden), dropout, learning_rate, epochs, weight)


def positive_weight(train: DataFrame) -> float:
    return float({w[TARGET]: w.scale_pos_weight for w in class_weights(train, TARGET).collect()}.get(1) or 1.0)


def train_network(spark, sf_dir, hidden=(256, 64), epochs: int = 20):
    """(network, validation scores, train vectors, validation vectors); fitted once per session."""
    r, x = prepared(spark, sf_dir, scale=True), vector_to_array("features")
    at = (spark.sparkContext.applicationId, sf_dir, tuple(hidden), epochs)
    if at not in _NETWORKS:
        spec = network_spec("neural_net", positive_weight(r.train), hidden, epochs=epochs)
        _NETWORKS[at] = network.fit(r.train, x, len(r.names), [spec], KEY, TARGET)[0]
    return _NETWORKS[at], _network_scores(r.valid, [_NETWORKS[at]]), r.train, r.valid


def _network_scores(df: DataFrame, networks) -> DataFrame:
    return network.score(df, vector_to_array("features"), networks, KEY, TARGET).withColumnRenamed(TARGET, "label")


def network_history(model: network.Network) -> list[tuple[int, float]]:
    """(epoch, mean train loss) of a fitted network."""
    return [(i + 1, float(x)) for i, x in enumerate(model.history)]


def logistic_grid(spark, sf_dir, grid=LOGISTIC_GRID, results: str | None = None) -> DataFrame:
    t, v, _names, _, _ = ready(spark, sf_dir, scale=True)
    total = tr.total_weight(t, TARGET, "balanced")
    return tr.grid_search(lambda C: tr.logistic(C, total, label=TARGET), grid, t, v, KEY, TARGET, "balanced", "logistic_regression", results)[0]


def forest_grid(spark, sf_dir, grid=FOREST_GRID, results: str | None = None) -> DataFrame:
    """A node that must hold ``min_samples_split`` rows to split is one whose halves hold half as many. Points that
    differ in their number of trees or depth only are one forest, scored with fewer trees or cut off.

    The metrics of every forest are written to the folder ``results`` when it is ready, so a run
    started again with the same folder skips it; its nodes are written pass by pass, and the driver holds those of one pass. A folder of another grid raises."""
    data, points = binned(spark, sf_dir), tr.expand_grid(grid)
    features, train = tuple(range(len(prepared(spark, sf_dir, False).names))), data.train.where(F.col(TARGET).isNotNull())
    folder = tr.grid_folder(spark, "random_forest", points, results)
    least = [max(p["min_samples_leaf"], p["min_samples_split"] // 2) for p in points]
    fits = list(dict.fromkeys(least))
    for i, min_leaf in enumerate(fits):
        own = [(str(n), 0, p["n_estimators"], p["max_depth"]) for n, p in enumerate(points) if least[n] == min_leaf]
        if path_exists(spark, f"{folder}/fit-{i}/_SUCCESS"):
            continue
        depth = None if any(d is None for *_, d in own) else max(d for *_, d in own)
        spec = forest.ForestSpec("random_forest", features, max(n for _, _, n, _ in own), depth, min_leaf, class_weights="table")
        held = forest.StoredScores(data.valid, [(name, n, d) for name, _, n, d in own], KEY, TARGET)

        def store(_, first, trees):
            for a in range(0, len(trees), NODE_TREES):
                part = forest.Forest(spec, trees[a: a + NODE_TREES], [])
                forest.node_table(spark, part, first + a).write.mode("append" if first + a else "overwrite").parquet(f"{folder}/model-{i}")
            held.add(first, trees)

        forest.fit(train, data.n_bins, [spec], KEY, TARGET, handed=store)
        scores = held.scores().withColumnRenamed(TARGET, "label").withColumn("grid_index", F.col("model").cast("int"))
        met.binary_metrics(scores, 0.5, ["grid_index"]).write.mode("overwrite").parquet(f"{folder}/fit-{i}")
    return tr.best_first(spark.read.parquet(*[f"{folder}/fit-{i}" for i in range(len(fits))]), points)


def boosted_grid(spark, sf_dir, grid=BOOSTED_GRID, progress: str | None = None) -> DataFrame:
    """All points on one binned table in the same passes. Points that differ in their number of
    trees only are one model, scored after fewer rounds. ``progress`` names a folder from which a
    stopped run goes on."""
    data, points = binned(spark, sf_dir), tr.expand_grid(grid)
    features = range(len(prepared(spark, sf_dir, False).names))
    fits = list(dict.fromkeys((p["learning_rate"], p["num_leaves"], p["min_child_samples"]) for p in points))
    specs = [boost_spec(f"fit {i}", features, data, max(p["n_estimators"] for p in points), *f) for i, f in enumerate(fits)]
    models = boosting.fit(data.train, data.n_bins, specs, KEY, TARGET, progress)
    at = [(str(i), fits.index((p["learning_rate"], p["num_leaves"], p["min_child_samples"])), p["n_estimators"]) for i, p in enumerate(points)]
    scores = _boosted_scores(data.valid, models, at).withColumn("grid_index", F.col("model").cast("int"))
    return tr.grid_table(scores, points)


def network_grid(spark, sf_dir, grid=NETWORK_GRID) -> DataFrame:
    """All points trained in the same mini-batch jobs."""
    r, points = prepared(spark, sf_dir, scale=True), tr.expand_grid(grid)
    weight = positive_weight(r.train)
    specs = [network_spec(str(i), weight, p["hidden_dims"], p["dropout"], p["learning_rate"], p["epochs"]) for i, p in enumerate(points)]
    networks = network.fit(r.train, vector_to_array("features"), len(r.names), specs, KEY, TARGET)
    return tr.grid_table(_network_scores(r.valid, networks).withColumn("grid_index", F.col("model").cast("int")), points)


def trained_scores(spark, sf_dir, which: str, n_iter: int = 500) -> DataFrame:
    """Validation scores (model, key, label, score) of a trained model, stored once per session."""
    fit = {"logistic_regression": lambda: train_logistic(spark, sf_dir)[1],
           "boosted_trees": lambda: train_boosted(spark, sf_dir, n_iter)[1]}[which]
    return stored(spark, ("scores", sf_dir, which, n_iter), fit)


def hybrid_sweep(spark, sf_dir, n_iter: int = 500) -> DataFrame:
    """Blend weights over the trained boosted trees and logistic scores, joined by key with the label guard."""
    a, b = trained_scores(spark, sf_dir, "boosted_trees", n_iter), trained_scores(spark, sf_dir, "logistic_regression", n_iter)
    aligned = met.align_scores(a, b, [KEY])
    return met.blend_weight_sweep(aligned, (0.5, 0.6, 0.7, 0.8, 0.9), [KEY], primary_name="boosted_trees", secondary_name="logistic_regression")


def trained_leaderboard(spark, sf_dir, n_iter: int = 500, weight: float = 0.8) -> DataFrame:
    """Default and tuned boards of the trained models and their blend."""
    a, b = trained_scores(spark, sf_dir, "boosted_trees", n_iter), trained_scores(spark, sf_dir, "logistic_regression", n_iter)
    blended = met.align_scores(a, b, [KEY]).select(F.lit("hybrid").alias("model"), KEY, "label", blend("score_a", "score_b", weight).alias("score"))
    return met.leaderboard(a.unionByName(b).unionByName(blended))


def stacked(spark, sf_dir, n_trees: int = 400, n_iter: int = 500, hidden=(256, 64)) -> DataFrame:
    """Four base models' in-sample train probabilities as features of a balanced
    logistic stacker; evaluated on the validation part (key joins only)."""
    fits = {"lr": lambda: train_logistic(spark, sf_dir), "rf": lambda: train_forest(spark, sf_dir, n_trees),
            "gbt": lambda: train_boosted(spark, sf_dir, n_iter), "mlp": lambda: train_network(spark, sf_dir, hidden)}
    # No base needs another, and many of their jobs have a few tasks only: they run side by side on the
    # inputs, which are stored first.
    prepared(spark, sf_dir, scale=False)
    with ThreadPoolExecutor(len(fits)) as pool:
        run = inheritable_thread_target(spark)(lambda fit: fit())
        list(pool.map(run, [lambda: prepared(spark, sf_dir, scale=True), lambda: binned(spark, sf_dir)]))
        bases = dict(zip(fits, pool.map(run, fits.values())))

    def layer(part_index):
        out = None
        for name, (model, _s, t, v) in bases.items():
            df = (t, v)[part_index]
            scored = _scores(model, df, name) if name == "lr" else {"rf": _forest_scores, "gbt": _boosted_scores, "mlp": _network_scores}[name](df, [model])
            s = scored.select(KEY, F.col("label").alias(TARGET), F.col("score").alias(f"{name}_prob"))
            out = s if out is None else out.join(s.drop(TARGET), KEY)
        return out

    cols = [f"{n}_prob" for n in bases]
    train_meta = cut_lineage(tr.assemble(layer(0), cols, [KEY, TARGET]))
    valid_meta = tr.assemble(layer(1), cols, [KEY, TARGET])
    est = tr.logistic(1.0, tr.total_weight(train_meta, TARGET, "balanced"), label=TARGET)
    _m, scores = tr.fit_and_score(est, train_meta, valid_meta, KEY, TARGET, "stacked_ensemble", "balanced")
    return evaluate(scores)


def experiment_features(columns: list[str]) -> dict[str, list[str]]:
    """Experiment -> the applicant columns it uses, in table order (names only)."""
    groups = {("bureau_family" if n == "bureau" else n): set(spec().feature_names()) for n, spec in tpch.FAMILY_SPECS.items()}
    raw = [c for c in columns if c not in (KEY, TARGET)]
    groups["application"] = set(raw).difference(*groups.values())
    return {exp: [c for c in raw if any(c in groups[g] for g in names)] for exp, names in EXPERIMENTS.items()}


def experiment_columns(spark, sf_dir) -> DataFrame:
    """(experiment, feature, ordinal, null_count): the raw columns each ablation run uses, in table
    order, with their nulls in the applicant table."""
    feats = split_frames(spark, sf_dir)[0]
    rows = [(exp, c, i) for exp, cols in experiment_features(feats.columns).items() for i, c in enumerate(cols)]
    spec = spark.createDataFrame(rows, "experiment string, feature string, ordinal int")
    nulls = missing_profile(feats).select(F.col("column").alias("feature"), "null_count")
    return spec.join(nulls, "feature").select("experiment", "feature", "ordinal", "null_count")


def ablation(spark, sf_dir, n_iter: int = 500, runs=RECOMMENDED_RUNS, progress: str | None = None) -> DataFrame:
    """One leaf-wise model per run, all trained in the same passes over the one binned table: a run is
    the choice of the bins that come from its columns. Stored once per session."""
    def fit():
        r, data = prepared(spark, sf_dir, scale=False), binned(spark, sf_dir)
        per_exp = experiment_features([KEY, TARGET, *r.raw])
        of_run = {exp: [i for i, c in enumerate(r.origin) if c in set(per_exp[exp])] for exp in runs}
        models = boosting.fit(data.train, data.n_bins, [boost_spec(exp, f, data, n_iter) for exp, f in of_run.items()], KEY, TARGET, progress)
        scores = cut_lineage(_boosted_scores(data.valid, models))
        counts = scores.groupBy("model").agg(F.count(F.lit(1)).alias("validation_rows"), F.sum("label").alias("validation_positives"))
        sizes = [(exp, len(per_exp[exp]), len(set(r.dropped) & set(per_exp[exp])), len(of_run[exp])) for exp in runs]
        held = spark.createDataFrame(sizes, "experiment string, raw_feature_count int, dropped_constant_count int, model_feature_count int")
        metrics = met.binary_metrics(scores, 0.5, ["model"]).join(counts, "model").withColumnRenamed("model", "experiment")
        return held.join(metrics, "experiment").select(*held.columns, "validation_rows", "validation_positives", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")
    return stored(spark, ("ablation", sf_dir, n_iter, tuple(runs)), fit).orderBy(F.desc("roc_auc"))


def ablation_invariants(results: DataFrame) -> DataFrame:
    """What must hold in an ablation table whatever the learner found: columns of every run, rows and
    positives, metrics within their ranges, and the removal drop equal to the full run's value less its own."""
    inside = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")]
    full = results.where("experiment = 'full_features'").select(F.col("roc_auc").alias("full_auc"))
    drops = removal_impact(results).select("experiment", "roc_auc_drop_vs_full")
    out = results.join(drops, "experiment", "left").crossJoin(F.broadcast(full))  # one-row side
    fits = F.col("roc_auc_drop_vs_full").isNull() | (F.abs(F.col("full_auc") - F.col("roc_auc") - F.col("roc_auc_drop_vs_full")) < 1e-12)
    return out.select("experiment", "raw_feature_count", "validation_rows", "validation_positives", F.expr("roc_auc_drop_vs_full is not null").alias("has_drop"),
                      (functools.reduce(operator.and_, inside) & fits & (F.col("model_feature_count") > 0)).alias("holds"))


def boosted_invariants(spark, sf_dir, n_iter: int = 500) -> DataFrame:
    """One row: validation rows scored, trees, and what breaks their rules: scores outside 0 to 1, trees of
    more leaves than allowed, leaves of too few rows, trees whose leaves don't hold all train rows."""
    model, scores, train, _ = train_boosted(spark, sf_dir, n_iter)
    n = train.count()
    leaves = [t.cover[t.feature < 0] for t in model.trees]
    broken = [("leaf_counts", sum(len(x) > model.spec.num_leaves for x in leaves)), ("leaf_rows", sum(bool((x < model.spec.min_child).any()) for x in leaves if len(x) > 1)),
              ("tree_rows", sum(int(x.sum()) != n for x in leaves))]
    out = scores.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("score").between(0, 1)).alias("bad_scores"))
    return out.withColumns({"trees": F.lit(len(model.trees)).cast("long"), **{f"bad_{k}": F.lit(int(v)).cast("long") for k, v in broken}})


def train_balanced_forest(spark, sf_dir, n_trees: int = 400, max_depth=None, min_leaf: int = 5, min_split: int = 10):
    """(forest, validation scores, binned train rows): classes weigh the same in every tree's bootstrap."""
    model, data = _forest(spark, sf_dir, "balanced_forest", n_trees, max_depth, min_leaf, min_split, "draw"), binned(spark, sf_dir)
    return model, _forest_scores(data.valid, [model]), data.train


def balanced_forest_scores(spark, sf_dir, n_trees: int = 400, max_depth=None, min_leaf: int = 5, min_split: int = 10) -> DataFrame:
    """Validation scores of :func:`train_balanced_forest`, whose trees are not kept; stored once per session."""
    def fit():
        data, features = binned(spark, sf_dir), tuple(range(len(prepared(spark, sf_dir, False).names)))
        held = forest.StoredScores(data.valid, [("balanced_forest", n_trees, None)], KEY, TARGET)
        spec = forest.ForestSpec("balanced_forest", features, n_trees, max_depth, min_leaf, min_split, class_weights="draw")
        forest.fit(data.train, data.n_bins, [spec], KEY, TARGET, handed=lambda _, first, trees: held.add(first, trees))
        return held.scores()
    return stored(spark, ("scores", sf_dir, "balanced_forest", n_trees, max_depth, min_leaf, min_split), fit)


def forest_invariants(spark, sf_dir, n_trees: int = 400) -> DataFrame:
    """One row: validation rows scored, trees, and what breaks their rules: scores outside 0 to 1, leaves of
    too few rows, trees whose leaves don't hold their whole draw, draws whose classes don't weigh the same."""
    model, scores, train = train_balanced_forest(spark, sf_dir, n_trees)
    spec = model.spec
    draws = [(spec.seed, t) for t in range(spec.n_trees)]
    masses = forest.draw_masses(train, KEY, TARGET, draws)
    uneven = sum(abs(masses[d][0] * w[0] - masses[d][1] * w[1]) > 1e-6 for d, w in zip(draws, model.class_weights))
    drawn = forest.draw_rows(train, KEY, draws)
    leaves = [t.cover[t.feature < 0] for t in model.trees]
    broken = [("leaf_rows", sum(bool((x < spec.min_leaf).any()) for x in leaves if len(x) > 1)),
              ("tree_rows", sum(int(x.sum()) != drawn[d] for x, d in zip(leaves, draws))), ("class_mass", uneven)]
    out = scores.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("score").between(0, 1)).alias("bad_scores"))
    return out.withColumns({"trees": F.lit(len(model.trees)).cast("long"), **{f"bad_{k}": F.lit(int(v)).cast("long") for k, v in broken}})


def experiment_counts(spark, sf_dir) -> DataFrame:
    """What an ablation run holds whatever its learner: columns, validation rows and positives, in
    the recommended order."""
    feats = applicant_table(spark, sf_dir)  # read for its keys and labels only, so none of the families' columns is built
    split = prep.stratified_split(feats.select(KEY, TARGET), KEY, TARGET, 0.2, 42)
    valid = prep.select_part(feats, split, KEY, "validation")
    chosen = experiment_features(feats.columns)
    counts = spark.createDataFrame([(exp, len(cols)) for exp, cols in chosen.items()], "experiment string, raw_feature_count int")
    rows = valid.agg(F.count(F.lit(1)).alias("validation_rows"), F.sum(TARGET).alias("validation_positives"))
    return reorder(counts.crossJoin(rows), RECOMMENDED_RUNS)  # one-row side


def reorder(results: DataFrame, names: list[str], column: str = "experiment") -> DataFrame:
    """Rows in the order of ``names`` (join to their ordinals; names without a row give nulls)."""
    order = results.sparkSession.createDataFrame(list(enumerate(names)), f"ordinal int, {column} string")
    return order.join(results, column, "left").orderBy("ordinal")


def removal_impact(results: DataFrame) -> DataFrame:
    """Each full_minus run against full_features (one-row reference, broadcast)."""
    full = results.where(F.col("experiment") == "full_features").select(
        F.col("roc_auc").alias("__auc"), F.col("average_precision").alias("__ap"))
    return (results.where(F.col("experiment").startswith("full_minus"))
            .crossJoin(F.broadcast(full))
            .withColumn("roc_auc_drop_vs_full", F.col("__auc") - F.col("roc_auc"))
            .withColumn("average_precision_drop_vs_full", F.col("__ap") - F.col("average_precision"))
            .drop("__auc", "__ap").orderBy(F.desc("roc_auc_drop_vs_full")))


def attributions(spark, sf_dir, sample: int | None = 2000, n_iter: int = 500) -> DataFrame:
    """Long (key, feature, contribution, base, margin) of a seeded sample of validation rows, stored once per session;
    without a sample of all validation rows, not stored."""
    def fit():
        valid = binned(spark, sf_dir).valid
        rows = valid if sample is None else prep.sample_n(valid, KEY, sample, seed=42)
        return attr.attribute_binned(boosted_model(spark, sf_dir, n_iter), rows, KEY, prepared(spark, sf_dir, False).names)
    return fit() if sample is None else stored(spark, ("attribution", sf_dir, sample, n_iter), fit)
