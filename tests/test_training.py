"""Features, ranks, splits, metrics, conformal calibration, scoring."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import FeatureError, TrainingError
from domus.operators import conformal
from domus.operators.features import ListingImputer, column_medians, impute
from domus.operators.metrics import evaluate
from domus.operators.rank import global_rank, segment_by_rank, value_at_ranks
from domus.operators.split import exact_split, kfold_assign, kfold_sizes
from domus.plans.training import FittedModel, batch_score, fit, train_flow
from domus.sources.panel import panel

SF = "/root/testdata/sf0.001"


def test_median_is_midpoint(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, 612345.7)], "square_meters double")
    assert column_medians(df, ("square_meters",))["square_meters"] == 2.0
    ranked = column_medians(df, ("square_meters",), method="ranked")
    assert ranked["square_meters"] == 2.0


def test_impute_invariants(spark):
    p = panel(spark, SF)
    model = ListingImputer(keepCols=[]).fit(p)
    out = model.transform(p)
    assert out.columns == list(C.FEATURE_COLUMNS)
    assert C.TARGET not in out.columns
    nulls = out.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).first()
    assert all(v == 0 for v in nulls)
    assert out.filter(F.col("property_type") == C.MISSING_CATEGORY).count() > 0
    with pytest.raises(FeatureError):
        impute(p, None)
    with pytest.raises(FeatureError):
        ListingImputer(targetCol="nope").fit(p)


def test_global_rank_matches_single_partition(spark):
    p = panel(spark, SF).select("uid", "price_pln")
    ours = global_rank(p, ["price_pln", "uid"], "rank")
    ref = p.withColumn("rank_ref", F.row_number().over(Window.orderBy("price_pln", "uid")))
    j = ours.join(ref, "uid")
    assert j.filter(F.col("rank") != F.col("rank_ref")).count() == 0
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_segments_and_order_statistics(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(1000)], "k long, v double")
    seg = segment_by_rank(df, ["v", "k"], [100, 600], "s")
    sizes = {r["s"]: r["count"] for r in seg.groupBy("s").count().collect()}
    assert sizes == {0: 100, 1: 500, 2: 400}
    vals = sorted(float(i % 7) for i in range(1000))
    got = value_at_ranks(df, "v", [1, 500, 1000])
    assert got == {1: vals[0], 500: vals[499], 1000: vals[999]}


def test_exact_split_sizes_and_determinism(spark):
    p = panel(spark, SF)
    n = p.count()
    s1 = exact_split(p)
    sizes = {r["part"]: r["count"] for r in s1.groupBy("part").count().collect()}
    assert sizes["test"] == round(n * 0.2) and sizes["cal"] == round(n * 0.2)
    s2 = exact_split(p.repartition(3))
    assert s1.join(s2.withColumnRenamed("part", "p2"), "uid").filter("part != p2").count() == 0
    with pytest.raises(TrainingError):
        exact_split(p.limit(2))
    with pytest.raises(TrainingError):
        exact_split(p.unionByName(p))


def test_kfold(spark):
    assert kfold_sizes(12, 5) == [3, 3, 2, 2, 2]
    df = spark.createDataFrame([(str(i),) for i in range(12)], "uid string")
    sizes = sorted(r["count"] for r in kfold_assign(df, "uid", 5).groupBy("fold").count().collect())
    assert sizes == [2, 2, 2, 3, 3]


def test_metrics_closed_form(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 310.0), (400.0, 390.0)], "y double, prediction double")
    m = evaluate(df)
    assert m["mae"] == 10.0 and m["rmse"] == 10.0 and m["n_samples"] == 4
    assert math.isclose(m["r2"], 1 - 400 / 50000)
    assert math.isclose(m["mape"], np.mean([10 / 100, 10 / 200, 10 / 300, 10 / 400]))
    const = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0), (5.0, 4.0)], "y double, prediction double")
    assert evaluate(const)["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, prediction double")
    assert evaluate(zero)["mape"] == 0.0
    with pytest.raises(TrainingError):
        evaluate(df.limit(0))


def test_conformal_rank_matches_numpy():
    for n in (1, 2, 5, 49, 75, 150, 999):
        for a in (0.05, 0.1, 0.3):
            k = math.ceil((n + 1) * (1 - a))
            idx = int(np.quantile(np.arange(n, dtype=float), min(k / n, 1.0), method="higher"))
            assert conformal.conformal_rank(n, a) == idx + 1
    with pytest.raises(TrainingError):
        conformal.conformal_rank(10, 1.0)
    with pytest.raises(TrainingError):
        conformal.conformal_rank(0, 0.1)


def test_conformal_coverage(spark):
    rng = random.Random(0)
    rows = [(float(x), 2.0 * x + rng.gauss(0, 1)) for x in (rng.uniform(0, 10) for _ in range(300))]
    df = spark.createDataFrame(rows, "x double, y double").withColumn("prediction", 2.0 * F.col("x"))
    cal, test = df.limit(150), df.subtract(df.limit(150))
    q = conformal.calibrate(cal, "y", "prediction", 0.1)
    res = sorted(abs(r["y"] - r["prediction"]) for r in cal.collect())
    assert q == float(np.quantile(res, min(math.ceil(151 * 0.9) / 150, 1), method="higher"))
    out = conformal.interval(test, q)
    cov = out.agg(F.avg(F.col("y").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0]
    assert cov >= 0.85
    with pytest.raises(TrainingError):
        conformal.interval(test, None)


def test_batch_score_rounding(spark):
    m = FittedModel("simple_linear", {c: 0.0 for c in C.NUMERIC_FEATURES}, slope=0.0,
                    intercept=612345.6789, q=25000.0)
    req = spark.createDataFrame([(50.0,)], "square_meters double")
    for c in C.FEATURE_COLUMNS:
        if c not in req.columns:
            req = req.withColumn(c, F.lit(None))
    r = batch_score(m, req, "m", "1").first()
    assert r["predicted_price"] == 612346 and r["interval_low"] == 587346 and r["interval_high"] == 637346
    m.q = None
    r = batch_score(m, req, "m", "1").first()
    assert r["interval_low"] is None and r["interval_high"] is None
    m2 = FittedModel("simple_linear", m.medians, slope=0.0, intercept=2.5, q=10.0)
    r = batch_score(m2, req, "m", "1").first()
    assert r["predicted_price"] == 2 and r["interval_low"] == 0


def test_train_flow_quality(spark):
    run = train_flow(panel(spark, SF))
    assert run.metrics["r2"] > 0.5 and run.model.q > 0
    gbt = train_flow(panel(spark, SF), estimator="gbt", params={"n_estimators": 10, "max_depth": 4})
    assert gbt.metrics["r2"] > 0.5
    with pytest.raises(TrainingError):
        fit(panel(spark, SF), "unknown")


def test_tune_is_deterministic(spark):
    from domus.plans.training import tune

    train = exact_split(panel(spark, SF)).filter(F.col("part") == "train")
    best1, t1 = tune(train, n_trials=2, cv_folds=2, trees=(3, 5))
    best2, t2 = tune(train, n_trials=2, cv_folds=2, trees=(3, 5))
    assert best1 == best2 and t1.count() == 2
    assert t1.collect() == t2.collect()


def test_request_json_round_trip(spark):
    from domus.sources.listings import request_json
    from domus.streaming.scoring import request_schema

    p = panel(spark, SF).limit(5)
    js = p.select("uid", *C.REQUEST_COLUMNS).withColumn("request", request_json())
    schema = request_schema()
    back = js.select("uid", F.from_json("request", schema).alias("r")).select("uid", "r.*")
    orig = p.select("uid", *C.REQUEST_COLUMNS)
    assert back.drop("request_id").subtract(orig).count() == 0


def test_one_hot_unseen_category_is_all_zeros(spark):
    from pyspark.ml import Pipeline

    from domus.operators.features import one_hot_stages

    base = {c: "x" for c in C.CATEGORICAL_FEATURES}
    num = {c: 1.0 for c in C.NUMERIC_FEATURES}
    boo = {c: 0 for c in C.BOOL_FEATURES}
    rows = [{**base, **num, **boo, "city": c} for c in ("a", "b", "c")]
    train = spark.createDataFrame(rows)
    model = Pipeline(stages=one_hot_stages()).fit(train)
    test = spark.createDataFrame([{**base, **num, **boo, "city": "zzz"}, {**base, **num, **boo, "city": "b"}])
    out = {r["city"]: r["city__ohe"].toArray().tolist() for r in model.transform(test).collect()}
    assert out["zzz"] == [0.0, 0.0, 0.0]
    assert out["b"] == [0.0, 1.0, 0.0]


def test_flows_run_on_listings_without_uid(spark, tmpdir_path):
    """From rows keyed by (id, snapshot_month) to registered version and advice, and to a drift verdict."""
    from domus.operators.registry import Registry
    from domus.plans.drift_job import drift_job
    from domus.plans.training import train_flow
    from domus.sources.panel import panel

    listings = panel(spark, "/root/testdata/sf0.001").drop("uid").dropDuplicates(["id", "snapshot_month"]).cache()
    reg = Registry(spark, tmpdir_path)
    first = train_flow(listings, registry=reg)
    assert first.version["version"] == "1" and first.recommendation["should_promote"]
    assert sum(first.sizes.values()) == listings.count()
    reg.transition_stage("price", 1, "production")
    second = train_flow(listings, registry=reg)
    assert second.version["version"] == "2" and not second.recommendation["should_promote"]
    with pytest.raises(Exception, match="not unique"):
        train_flow(listings.unionByName(listings.limit(5)))
    month = listings.filter(F.col("snapshot_month") == listings.agg(F.max("snapshot_month")).first()[0])
    _, verdict = drift_job(month, cols=["square_meters", "city"])
    assert verdict.first().n_features == 2


def test_unknown_parameters_are_refused():
    from domus.errors import TrainingError
    from domus.operators.model import build_estimator

    with pytest.raises(TrainingError, match="num_leaves"):
        build_estimator("gbt", {"num_leaves": 3})


def test_tune_query_searches_the_default_space(spark, monkeypatch):
    """Bounded by the number of trials only."""
    from domus.plans import q_training

    asked = {}
    monkeypatch.setattr(q_training, "panel", lambda *_: None)
    monkeypatch.setattr(q_training, "exact_split", lambda _: spark.createDataFrame([("train",)], "part string"))
    monkeypatch.setattr(q_training, "tune", lambda _, **options: (None, asked.update(options)))
    q_training.q_tune(spark, "")
    assert asked == {"n_trials": 3, "timeout_seconds": float("inf"), "estimator": "gbt"}


def test_rungs_and_proposals():
    from domus.plans import tuning as U

    assert U.rungs(U.TREES) == [50, 100, 200, 400] and U.rungs((3, 5)) == [3, 5] and U.rungs((7,)) == [7]
    rng = random.Random(0)
    for k in range(200):
        p = U.propose(rng, slot=(k % 4, 4))
        assert p["max_depth"] in U.DEPTHS and U.RATES[0] <= p["learning_rate"] <= U.RATES[1]
        assert (math.log(p["learning_rate"] / 1e-3) / math.log(300)) // 0.25 == k % 4
        q = U.propose(rng, around=p)
        assert abs(q["max_depth"] - p["max_depth"]) <= 1 and q["learning_rate"] <= 2 * p["learning_rate"] + 1e-12


def test_a_fit_scores_all_its_beginnings(spark):
    """The errors of one fit's prefixes are those of the ensemble cut there, and the search keeps the best count."""
    from domus.operators.model import build_estimator
    from domus.plans import tuning as U

    train = exact_split(panel(spark, SF)).filter(F.col("part") == "train")
    fold = U.fold_vectors(train, "uid", 3, train.count(), 42)[0]
    params = {"max_depth": 3, "learning_rate": 0.3}
    errors = U.prefix_errors(fold, "gbt", params, 6, 42)
    small = build_estimator("gbt", {**params, "n_estimators": 4, "seed": 42}).fit(fold[0])
    assert len(errors) == 6 and errors[3] == pytest.approx(evaluate(small.transform(fold[1]), "label", "prediction")["mae"])
    best, trials = U.tune(train, n_trials=3, cv_folds=2, trees=(2, 4, 8), depths=(2, 3), min_gain=0.0)
    rows = {r.trial: r for r in trials.collect()}
    assert len(rows) == 3 and all(r.n_estimators in (2, 4, 8) for r in rows.values())
    top = min(rows.values(), key=lambda r: r.cv_mae)
    assert best == {"n_estimators": top.n_estimators, "max_depth": top.max_depth, "learning_rate": top.learning_rate}
    assert max(r.n_estimators for r in rows.values()) == 8  # one trial climbed to the top
    one, spent = U.tune(train, n_trials=4, cv_folds=2, trees=(2, 4), timeout_seconds=0.0)
    assert spent.count() == 1 and one["n_estimators"] == 2
    with pytest.raises(TrainingError):
        U.tune(train.limit(0))


def test_coded_fits_are_those_of_spark_ml(spark, monkeypatch):
    """A search fits in one job a rung and goes on from its trees; errors are those of Spark ML's learner."""
    from domus.plans import tuning as U
    from domus.session import materialize

    train = materialize(exact_split(panel(spark, SF)).filter(F.col("part") == "train"))
    folds, codes = U.fold_vectors(train, "uid", 2, train.count(), 42), U.fold_codes(train, "uid", 2, 42)
    params, grown = {"max_depth": 3, "learning_rate": 0.3}, {}
    first = U.code_errors(codes, 2, [params], [0], 2, grown)
    assert {p: len(t) for p, t in grown.items()} == {(0, 0): 2, (0, 1): 2}
    errors = U.code_errors(codes, 2, [params], [0], 5, grown)
    for f in (0, 1):
        assert errors[0, f][:2] == first[0, f]
        assert errors[0, f] == pytest.approx(U.prefix_errors(folds[f], "gbt", params, 5, 42), rel=2e-3)
    monkeypatch.setattr(U, "prefix_errors", None)
    options = dict(n_trials=2, cv_folds=2, trees=(2, 4), depths=(2, 3), timeout_seconds=float("inf"))
    _, trials = U.tune(train, **options)
    assert trials.count() == 2
    for name, what in (("forest", "no estimator"), ("random_forest", "learning_rate")):
        with pytest.raises(TrainingError, match=what):
            U.tune(train, estimator=name, **options)


def test_trees_of_codes_against_plain_search():
    import numpy as np
    from domus.operators import boosting as B

    r = np.random.default_rng(3)
    codes = np.stack([r.integers(0, 5, 400), r.integers(0, 7, 400), r.integers(0, 2, 400)]).astype(np.uint8)
    layout = B.Layout(np.array([6, 7, 2]), np.array([True, False, False]))
    target = r.normal(size=400) + (codes[0] == 3) * 4 + (codes[1] > 2) * (codes[2] == 1) * 3

    def plain(rows, depth):
        cuts = [(f, c, codes[f][rows] == c if hot else codes[f][rows] > c)
                for f, (w, hot) in enumerate(zip((6, 7, 2), (True, False, False), strict=True)) for c in range(w - 1)]
        loss = lambda x: ((x - x.mean()) ** 2).sum()
        y = target[rows]
        gains = [loss(y) - loss(y[g]) - loss(y[~g]) if 0 < g.sum() < len(g) else -1 for _, _, g in cuts]
        if not depth or max(gains) <= 1e-9:
            return np.full(len(rows), y.mean())
        right, out = cuts[int(np.argmax(gains))][2], np.zeros(len(rows))
        out[right], out[~right] = plain(rows[right], depth - 1), plain(rows[~right], depth - 1)
        return out

    tree, leaf = B.grow(codes, B.packed(codes, layout), layout, target, 3)
    assert tree.value[leaf] == pytest.approx(plain(np.arange(400), 3))
    assert (B.leaves(tree, layout, codes) == leaf).all()
    assert B.thresholds(np.array([1.0, 2.0, 2.0, 5.0])).tolist() == [1.5, 3.5]
    assert len(B.thresholds(np.arange(1000.0))) == 31 and B.thresholds(np.ones(9)).tolist() == []


def test_encoder_slots_and_guards(spark):
    from domus.operators.features import encoded_slots
    from domus.operators.guards import require_rows, row_count_guards

    base = {c: "x" for c in C.CATEGORICAL_FEATURES} | {c: 1.0 for c in C.NUMERIC_FEATURES} | {c: 0 for c in C.BOOL_FEATURES}
    rows = spark.createDataFrame([{**base, "city": c} for c in "bbaca"])
    got = {(r.column, r.category): (r.idx, r.n) for r in encoded_slots(rows).collect()}
    assert [got["city", c] for c in "abc"] == [(0, 2), (1, 2), (2, 1)] and got["ownership", "x"] == (0, 5)
    sized = {r.g: r for r in row_count_guards(spark.createDataFrame([(g,) for g in "aaaaabbc"], "g string"), ["g"]).collect()}
    assert (sized["a"].n_train, sized["a"].n_cal, sized["a"].n_test, sized["a"].can_split) == (3, 1, 1, True)
    assert sized["b"].can_compare and not sized["b"].can_split and sized["c"].can_fit and not sized["c"].can_compare
    assert require_rows(2, 2, "it", TrainingError) == 2
    with pytest.raises(TrainingError, match="needs 2 rows"):
        require_rows(1, 2, "it", TrainingError)


def test_trees_are_fitted_in_bounded_tasks(spark, monkeypatch):
    """the vectors that trees keep lay in as few tasks as the files had splits."""
    from domus.plans import training, tuning
    from domus.session import materialize

    monkeypatch.setattr(tuning, "ROWS_PER_TASK", 100)
    seen = []
    real = training.build_estimator

    def build(*args, **options):
        learner = real(*args, **options)
        fit_rows = type(learner).fit
        monkeypatch.setattr(type(learner), "fit", lambda self, df, params=None: (
            seen.append(df.rdd.getNumPartitions()), fit_rows(self, df, params))[1])
        return learner

    monkeypatch.setattr(training, "build_estimator", build)
    rows = materialize(panel(spark, SF).limit(1000).coalesce(1))
    model = training.fit(rows, "random_forest", {"n_estimators": 2, "max_depth": 2, "seed": 1})
    assert seen == [10] and model.predict(rows).count() == 1000


def test_a_split_reads_its_frame_once_for_the_keys(spark):
    """The check and the cuts worked the frame out again each time."""
    read = spark.sparkContext.accumulator(0)

    def count(x):
        read.add(1)
        return x

    df = spark.range(200).select(F.udf(count)(F.col("id").cast("string")).alias("uid"))
    labelled = exact_split(df)
    assert read.value == 200
    sizes = {r["part"]: r["count"] for r in labelled.groupBy("part").count().collect()}
    assert sum(sizes.values()) == 200 and len(sizes) == 3


def test_versions_are_worked_out_once(spark):
    """F8: each use of the version table scored the panel again."""
    from domus.plans.q_registry import versions

    v = versions(spark, SF)
    assert "Window" not in v._jdf.queryExecution().optimizedPlan().toString() and v.count() > 0
