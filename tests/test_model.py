"""Training, scoring, and the harmless burst, on whole test tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from emberlog.operators import evaluate, rollup as ru, whatif
from emberlog.plans import model as ml
from emberlog.plans import trees, view
from emberlog.session import pinned
from emberlog.sources import contract, events

ROUNDS = 20


@pytest.fixture(scope="module")
def logs(spark):
    return events.logs(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def trained(logs):
    rolled = pinned(ru.buckets(logs, "hour"))
    full = pinned(view.training_events(logs, rolled, "hour", keep=("event_id",)))
    train, test = ml.split(full, ["event_id"])
    return ml.train(train, rounds=ROUNDS), train, test, rolled


def test_f1_on_the_holdout(trained):
    fitted, _, test, _ = trained
    scored = ml.score(test, fitted)
    f1 = evaluate.precision_recall_f1(evaluate.confusion(scored, 0.0)).first()["f1"]
    assert f1 >= 0.90


def test_score_is_the_log_odds_of_the_probability(trained):
    fitted, _, test, _ = trained
    both = ml.probability(ml.score(test, fitted), fitted)
    row = both.agg(F.max(F.abs(1 / (1 + F.exp(-F.col("anomaly_score"))) - F.col("anomaly_probability")))).first()
    assert row[0] < 1e-9


def test_split_does_not_depend_on_layout(logs):
    one, other = ml.split(logs, ["event_id"])[0], ml.split(logs.repartition(7), ["event_id"])[0]
    assert one.select("event_id").exceptAll(other.select("event_id")).isEmpty()
    assert 0.75 < one.count() / logs.count() < 0.85
    assert ml.split(logs, ["event_id"], seed=7)[0].select("event_id").exceptAll(one.select("event_id")).count() > 0


def test_save_and_load(trained, tmp_path):
    fitted, _, test, _ = trained
    path = str(tmp_path / "model")
    ml.save(fitted, path)
    again = ml.load(fitted.codes.sparkSession, path)
    assert ml.features_of(again) == contract.FEATURES_V2
    assert ml.score(test, again).exceptAll(ml.score(test, fitted)).isEmpty()
    with pytest.raises(contract.ContractError):
        ml.load(fitted.codes.sparkSession, path, contract.FEATURES_V1)


def test_model_record(spark, trained, tmp_path):
    path = str(tmp_path / "models")
    ml.record_model(spark, path, "v2", trained[0], {"f1": 0.95})
    ml.record_model(spark, path, "v3", trained[0], {"f1": 0.96})
    rows = {r.version: r for r in spark.read.parquet(path).collect()}
    assert rows["v2"].rounds == ROUNDS and rows["v3"].metrics == {"f1": 0.96}
    assert rows["v2"].features == ",".join(contract.FEATURES_V2)


def test_unseen_and_null_categories_are_scored(spark, trained):
    fitted, _, test, _ = trained
    odd = test.withColumn("endpoint", F.lit("/never/seen")).withColumn("log_signature", F.lit(None).cast("string"))
    assert evaluate.score_stats(ml.score(odd, fitted)).first()["null_scores"] == 0


def test_every_category_counts_however_many_there_are(spark):
    """Four hundred endpoints, the label depends on the endpoint alone: rare ones are told apart as well."""
    rows = [("s", f"/u/{i % 400}", 200, i // 400, int(i % 400 % 2)) for i in range(16000)]
    df = spark.createDataFrame(rows, "service_id string, endpoint string, status_code int, response_time_ms int, is_anomaly int")
    fitted = ml.train(df, contract.NUMERIC_V1, ["service_id", "endpoint"], rounds=2, max_bins=16)
    wrong = ml.score(df, fitted).where((F.col("anomaly_score") > 0) != (F.col("is_anomaly") == 1))
    assert wrong.isEmpty() and fitted.codes.where("feature = 'endpoint'").count() == 400


def test_missing_numbers_are_scored_and_unlabelled_rows_not_learnt(spark):
    rows = [("s", "/e", None if i % 3 == 0 else 200, 5, None if i % 4 == 0 else int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "service_id string, endpoint string, status_code int, response_time_ms int, is_anomaly int")
    scored = ml.score(df, ml.train(df, contract.NUMERIC_V1, ["service_id"], rounds=2))
    assert scored.where("(anomaly_score > 0) != (status_code IS NULL)").isEmpty() and scored.count() == 600


def test_views_have_the_contract_columns_and_all_rows(spark, logs, trained):
    fitted, _, _, rolled = trained
    v2 = view.score_v2(logs, rolled, fitted, bucket="hour")
    assert v2.columns == view.VIEW_V2_COLUMNS + ["anomaly_score"]
    assert evaluate.count_parity(logs, v2).first()["equal"]
    v1 = ml.train(logs, contract.NUMERIC_V1, contract.CATEGORICAL_V1, rounds=2)
    assert view.score_v1(logs, v1).columns == view.VIEW_V1_COLUMNS + ["anomaly_score"]
    view.anomaly_view(v2)
    assert spark.sql("SELECT count(*) FROM anomalous_events_v2 WHERE anomaly_score IS NULL").first()[0] == 0


def test_a_harmless_burst_does_not_alert(logs, trained):
    """Ten times the traffic, all of it normal: no score above 0.5."""
    fitted = trained[0]
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02 12:00:00", "2024-01-03 12:00:00"))
    burst = whatif.amplify(logs, start, end)
    scored = view.score_v2(burst, ru.buckets(burst, "hour"), fitted, bucket="hour")
    row = evaluate.max_score(scored, start, end).first()
    assert row["n"] > 100 and row["max_score"] <= 0.5


def test_far_rows_score_high_without_labels(spark):
    dense = [(i, 200 if i % 2 else 500, 100 + i % 3) for i in range(200)]
    df = spark.createDataFrame(dense + [(-1, 350, 101)], "event_id int, status_code int, response_time_ms int")
    scored = ml.cluster_distance(df, ["status_code"], k=2)
    assert scored.count() == 201 and scored.orderBy(F.desc("anomaly_score")).first().event_id == -1


def test_codes_in_the_plan_give_what_the_join_gives(spark, trained, monkeypatch):
    fitted, _, test, _ = trained
    odd = test.limit(3).withColumns({"endpoint": F.lit(None).cast("string"), "service_id": F.lit("never seen"), "response_time_ms": F.lit(None).cast("bigint")})
    rows = test.unionByName(odd)
    assert fitted.lookup is not None and set(fitted.lookup) == set(contract.CATEGORICAL_V2)
    joined = replace(fitted, lookup=None)
    assert ml.score(rows, fitted).exceptAll(ml.score(rows, joined)).isEmpty()
    monkeypatch.setattr(ml, "LOOKUP_VALUES", 3)
    assert ml._lookup(fitted.codes) is None


def test_the_scorer_for_small_batches_gives_the_scores_of_the_model(spark, trained, monkeypatch):
    fitted, _, test, _ = trained
    odd = test.limit(3).withColumns({"endpoint": F.lit(None).cast("string"), "response_time_ms": F.lit(None).cast("bigint")})
    rows = test.unionByName(odd).withColumn("anomaly_score", F.lit("replaced"))
    monkeypatch.setattr(trees, "WALK", 50)
    scorer = trees.BatchScorer(fitted)
    assert len(scorer.trees.value.roots) == ROUNDS
    for model in (scorer, trees.BatchScorer(replace(fitted, lookup=None))):
        got = model.score(rows)
        assert got.columns == [*test.columns, "anomaly_score"] and got.count() == rows.count()
        both = ml.score(model.score(rows, "batch_score").drop("anomaly_score"), fitted)
        assert both.where(F.abs(F.col("batch_score") - F.col("anomaly_score")) < 1e-9).count() == rows.count()
    assert scorer.score(rows.limit(0)).collect() == []
