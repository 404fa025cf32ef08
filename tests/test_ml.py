import random

import pytest
from pyspark.sql import functions as F

from punctua import config
from punctua.ml import evaluate, features, models, score
from punctua.plans import modelling
from punctua.sources import tables as io

SIZES = [10**6, 0]
SMALL = models.Sizes(lr_iterations=5, trees=3, forest_depth=3, boosting_rounds=2, boosting_depth=2)


def scored(spark, rows):
    return spark.createDataFrame(rows, "is_delayed int, prediction int, score double")


def training_trips(spark, n=400):
    dice = random.Random(8)
    rows = []
    for i in range(n):
        values = [float(dice.randrange(5)) for _ in config.FEATURES]
        rows.append((f"T{i:04d}", *values, int(values[0] + dice.random() > 2.5)))
    kinds = ", ".join(f"{name} double" for name in config.FEATURES)
    return spark.createDataFrame(rows, f"trip_id string, {kinds}, is_delayed int")


MIXED = [(1, 1, 0.9), (0, 1, 0.8), (1, 1, 0.8), (0, 0, 0.3), (1, 0, 0.3), (0, 0, 0.1)]


def test_metrics_of_a_mixed_sample(spark):
    row = evaluate.binary_metrics(scored(spark, MIXED)).first()
    assert row.accuracy == pytest.approx(4 / 6) and row.precision == pytest.approx(2 / 3)
    assert row.recall == pytest.approx(2 / 3) and row.f1 == pytest.approx(2 / 3)
    wins = [(p > n) + 0.5 * (p == n) for p in (0.9, 0.8, 0.3) for n in (0.8, 0.3, 0.1)]
    assert row.roc_auc == pytest.approx(sum(wins) / 9)


def test_metrics_without_positive_predictions_or_second_class(spark):
    row = evaluate.binary_metrics(scored(spark, [(1, 0, 0.2), (0, 0, 0.1)])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)
    assert evaluate.roc_auc(scored(spark, [(1, 1, 0.5)])).first().roc_auc is None


@pytest.mark.parametrize("small_rows", SIZES)
def test_roc_points(spark, small_rows):
    points = {r.threshold: (r.fpr, r.tpr)
              for r in evaluate.roc_points(scored(spark, MIXED), small_rows=small_rows).collect()}
    third = 1 / 3
    assert points[float("inf")] == (0.0, 0.0) and points[0.1] == (1.0, 1.0)
    assert points[0.9] == pytest.approx((0, third)) and points[0.8] == pytest.approx((third, 2 * third))
    assert points[0.3] == pytest.approx((2 * third, 1.0))


@pytest.mark.parametrize("small_rows", SIZES)
def test_area_equals_mllib(spark, small_rows):
    dice = random.Random(5)
    rows = [(dice.randrange(2), 0, dice.randrange(50) / 50) for _ in range(500)]
    frame = scored(spark, rows)
    evaluator = models.auc_evaluator().setRawPredictionCol("score").setNumBins(0)
    area = evaluate.roc_auc(frame, small_rows=small_rows).first().roc_auc
    assert area == pytest.approx(evaluator.evaluate(frame))


def test_confusion_lists_empty_cells(spark):
    found = evaluate.confusion_matrix(scored(spark, [(1, 1, 0.9), (1, 1, 0.8)])).collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]


def test_class_report(spark):
    found = {r["class"]: r for r in evaluate.class_report(scored(spark, MIXED)).collect()}
    assert list(found) == ["On-Time", "Delayed", "accuracy", "macro avg", "weighted avg"]
    assert found["Delayed"].support == 3 and found["accuracy"].precision is None
    assert found["weighted avg"].f1 == pytest.approx(2 / 3)


def test_class_weights(spark):
    frame = spark.createDataFrame([(0,)] * 2 + [(1,)] * 6, "is_delayed int")
    found = {r.is_delayed: r.weight for r in features.class_weights(frame).collect()}
    assert found == {0: 2.0, 1: pytest.approx(8 / 12)}


@pytest.mark.parametrize("small_rows", SIZES)
def test_stratified_split_is_exact_and_repeatable(spark, small_rows):
    rows = [(f"T{i}", int(i % 4 == 0)) for i in range(200)]
    frame = spark.createDataFrame(rows, "trip_id string, is_delayed int")
    split = features.stratified_split(frame, small_rows=small_rows)
    sizes = {(r.is_delayed, r.is_test): r.n
             for r in split.groupBy("is_delayed", "is_test").agg(F.count("*").alias("n")).collect()}
    assert sizes == {(0, True): 30, (0, False): 120, (1, True): 10, (1, False): 40}
    again = features.stratified_split(frame.repartition(7), small_rows=small_rows)
    assert sorted(split.collect()) == sorted(again.select(*split.columns).collect())


@pytest.mark.parametrize("small_rows", SIZES)
def test_stratified_folds_cover_everything_once(spark, small_rows):
    rows = [(f"T{i}", int(i % 5 == 0)) for i in range(100)]
    frame = spark.createDataFrame(rows, "trip_id string, is_delayed int")
    found = features.stratified_folds(frame, 5, small_rows=small_rows).collect()
    assert sorted(r.trip_id for r in found) == sorted(row[0] for row in rows)
    for fold in range(5):
        labels = [r.is_delayed for r in found if r.fold == fold]
        assert (labels.count(0), labels.count(1)) == (16, 4)


def test_unknown_weather_leaves_the_training_set(spark):
    trips = training_trips(spark, 10).withColumn(
        "weather_code", F.when(F.col("trip_id") != "T0003", F.col("weather_code"))
    )
    kept = features.training_set(trips, keep=["trip_id"])
    assert kept.count() == 9 and kept.where("trip_id = 'T0003'").isEmpty()


def test_comparison_has_all_models_and_repeats(spark):
    trips = training_trips(spark)
    first = modelling.compare_models(trips, SMALL, folds=2)
    rows = {r.model: r for r in first.table.collect()}
    assert set(rows) == {"Logistic Regression", "Random Forest", "Gradient Boosting"}
    for row in rows.values():
        assert 0.6 < row.f1 <= 1 and 0.6 < row.cv_f1 <= 1 and row.roc_auc > 0.6
    forest = modelling.compare_models(trips, SMALL, names=["Random Forest"], cross_validation=False)
    again = forest.table.first()
    assert again.f1 == rows["Random Forest"].f1 and again.roc_auc == rows["Random Forest"].roc_auc
    assert again.cv_f1 is None


def test_saved_model_scores_alike(spark, tmp_path):
    trips = training_trips(spark)
    fitted = modelling.compare_models(trips, SMALL, names=["Random Forest"], cross_validation=False)
    model = fitted.fitted["Random Forest"].model
    path = str(tmp_path / "forest")
    assert io.load_model(spark, path) is None
    io.save_model(model, path)
    before = score.score_trips(model, trips).orderBy("trip_id").collect()
    after = score.score_trips(io.load_model(spark, path), trips).orderBy("trip_id").collect()
    assert before == after and {r.verdict for r in after} == set(config.CLASS_NAMES)
    importance = evaluate.feature_importance(trips, model).collect()
    assert importance[-1].feature == "weather_code"
    assert sum(r.importance for r in importance) == pytest.approx(1)


def test_selected_logistic_names_its_parameters(spark):
    row = modelling.select_logistic(training_trips(spark), iterations=5, folds=2).first()
    assert row.reg_param in (0.01, 0.1) and row.elastic_net_param in (0.0, 0.5)
    assert row.roc_auc > 0.8 and 0 <= row.weighted_f1 <= 1


def folded_rows(spark, n=300):
    dice = random.Random(3)
    rows = []
    for i in range(n):
        values = [dice.gauss(5, 2 + k) for k in range(len(config.FEATURES))]
        values[1] = 4.0  # a constant
        rows.append((f"T{i:04d}", *values, float(values[0] + dice.random() > 5.5), i % 3))
    kinds = ", ".join(f"{name} double" for name in config.FEATURES)
    return spark.createDataFrame(rows, f"trip_id string, {kinds}, is_delayed double, fold int")


def test_fold_totals_by_subtraction(spark):
    folded = folded_rows(spark).cache()
    totals = features.fold_totals(folded)
    for fold in range(3):
        train = folded.where(F.col("fold") != fold)
        sizes = {r.is_delayed: r["count"] for r in train.groupBy("is_delayed").count().collect()}
        assert totals.train_classes(fold) == sizes
        wanted = {r.is_delayed: r.weight for r in features.class_weights(train).collect()}
        weighed = train.withColumn("weight", features.weight_of(totals.train_classes(fold)))
        found = {r.is_delayed: r.weight for r in weighed.select("is_delayed", "weight").distinct().collect()}
        assert found == pytest.approx(wanted)
        moments = totals.train_moments(fold)
        model = features.scaler(True).fit(features.assembler("raw_features").transform(train))
        assert list(moments.means) == pytest.approx(list(model.mean))
        assert list(moments.deviations()) == pytest.approx(list(model.std), abs=1e-9)
        scaled = features.scaled(train, moments).agg(*[F.avg(c) for c in config.FEATURES]).first()
        assert list(scaled) == pytest.approx([0.0] * len(config.FEATURES), abs=1e-9)
    assert totals.train_classes(9) == totals.whole_classes


@pytest.mark.parametrize("name", ["Logistic Regression", "Random Forest", "Gradient Boosting"])
def test_fold_scores_equal_fits_one_by_one(spark, name):
    folded = folded_rows(spark).coalesce(1).cache()
    found = modelling.fold_scores(name, folded, SMALL, folds=3)
    for fold in range(3):
        train = features.add_class_weights(folded.where(F.col("fold") != fold))
        rows = train.count()
        model = models.model_zoo(rows, SMALL)[name].fit(modelling.arranged(name, train, rows))
        alone = evaluate.threshold_metrics(model.transform(folded.where(F.col("fold") == fold)))
        assert found[fold] == pytest.approx(alone.first().f1, abs=0.02)
    assert modelling.fold_f1(name, folded, SMALL, 3) == pytest.approx(sum(found) / 3)


def test_cross_validation_means_the_scores_of_its_folds(spark):
    rows = folded_rows(spark).coalesce(1).cache()
    pipeline, grid = models.logistic_grid(5)
    tuned = models.cross_validate(rows, pipeline, grid, folds=3)
    evaluator = models.auc_evaluator()
    parts = tuned_folds(rows, 3)
    for cell, mean in zip(grid, tuned.avgMetrics):
        scores = [evaluator.evaluate(pipeline.fit(train, cell).transform(test)) for train, test in parts]
        assert mean == pytest.approx(sum(scores) / 3)
    table = models.grid_scores(spark, tuned).collect()
    assert [r.cv_auc for r in table] == tuned.avgMetrics and len(table) == 4
    best, = [r for r in table if r.chosen]
    chosen = models.best_parameters(spark, tuned).first()
    assert (best.reg_param, best.elastic_net_param) == (chosen.reg_param, chosen.elastic_net_param)
    assert best.cv_auc == chosen.cv_auc == max(tuned.avgMetrics)


def tuned_folds(rows, folds):
    """The parts that the cross-validator makes: by one uniform number for each row."""
    drawn = rows.select("*", F.rand(config.SEED).alias("_draw")).cache()
    inside = [(F.col("_draw") >= k / folds) & (F.col("_draw") < (k + 1) / folds) for k in range(folds)]
    return [(drawn.where(~part), drawn.where(part)) for part in inside]


def test_comparison_table_holds_the_scores_of_stored_predictions(spark):
    made = modelling.compare_models(training_trips(spark), SMALL, cross_validation=False)
    rows = {r.model: r for r in made.table.collect()}
    for name, fitted in made.fitted.items():
        wanted = evaluate.binary_metrics(fitted.predictions).first()
        assert [rows[name][c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc")] == [
            wanted[c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc")]
        assert rows[name].model_efficiency == pytest.approx(
            rows[name].f1 / fitted.seconds, abs=1e-3)


def test_held_frames_are_released(spark):
    frame = spark.range(10)
    with modelling.held(frame) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not frame.storageLevel.useMemory
    with pytest.raises(ValueError), modelling.held(frame):
        raise ValueError
    assert not frame.storageLevel.useMemory


@pytest.mark.parametrize("small_rows", SIZES)
def test_reduced_curve_drops_middle_points_only(spark, small_rows):
    dice = random.Random(4)
    rows = [(int(dice.random() < s / 40), 0, s / 40) for s in range(40) for _ in range(dice.choice([1, 1, 2]))]
    frame = scored(spark, rows)
    whole = sorted(((r.threshold, r.fpr, r.tpr) for r in evaluate.roc_points(frame).collect()), reverse=True)
    kept = sorted(((r.threshold, r.fpr, r.tpr) for r in
                   evaluate.roc_points_reduced(frame, small_rows=small_rows).collect()), reverse=True)
    steps = [(round((b[1] - a[1]) * 1e6), round((b[2] - a[2]) * 1e6)) for a, b in zip(whole, whole[1:])]
    wanted = [whole[0], whole[1]] + [
        whole[i] for i in range(2, len(whole)) if i == len(whole) - 1 or steps[i - 1] != steps[i]]
    assert len(kept) == len(wanted) < len(whole)
    assert all(a == pytest.approx(b) for a, b in zip(kept, wanted))


def test_a_forest_gets_few_tasks(spark):
    few = features.FEW_HEAVY_TASKS
    many = training_trips(spark).repartition(4 * few).cache()
    dealt = modelling.arranged("Random Forest", many, 400)
    assert dealt.rdd.getNumPartitions() == few
    assert sorted(dealt.collect()) == sorted(many.collect())
    again = modelling.arranged("Random Forest", many.repartition(5 * few), 400)
    assert dealt.rdd.glom().collect() == again.rdd.glom().collect()
    small = many.coalesce(few)
    assert modelling.arranged("Random Forest", small, 400) is small
    large = modelling.arranged("Random Forest", many, 3 * few * features.ROWS_PER_HEAVY_TASK)
    assert large.rdd.getNumPartitions() == 3 * few
