import pytest
from pyspark.sql import functions as F

from emberlog.sources import contract, tables
from tests.helpers import BASE, log, logs


def test_column_order_of_the_log_tables():
    assert contract.V1_SCHEMA.fieldNames() == [
        "timestamp", "service_id", "endpoint", "status_code", "response_time_ms", "user_agent", "is_anomaly"]
    assert len(contract.V2_SCHEMA) == 14 and contract.V2_SCHEMA.fieldNames()[-1] == "is_anomaly"
    assert contract.FEATURES_V2[:5] == contract.NUMERIC_V2 and contract.FEATURES_V2[5:] == contract.CATEGORICAL_V2


def test_check_contract_names_what_is_wrong(spark):
    df = logs(spark, [log()])
    assert contract.check_contract(df, contract.V2_SCHEMA) is df
    with pytest.raises(contract.ContractError, match="missing.*status_code"):
        contract.check_contract(df.withColumn("status_code", F.col("status_code").cast("string")), contract.V2_SCHEMA)
    with pytest.raises(contract.ContractError, match="order"):
        contract.check_contract(df.select(*reversed(df.columns)), contract.V2_SCHEMA)
    with pytest.raises(contract.ContractError, match="unexpected"):
        contract.check_contract(df.withColumn("more", F.lit(1)), contract.V2_SCHEMA)


def test_conform_fills_defaults(spark):
    row = contract.conform(logs(spark, [log()]).select(*contract.V1_SCHEMA.fieldNames()), contract.ENVELOPE_SCHEMA).first()
    assert (row.throughput_velocity, row.error_acceleration, row.is_surge, row.schema_version) == (1.0, 0.0, 0, 2)
    assert row.log_signature is None and row.error_kind is None


def test_range_violations(spark):
    bad = logs(spark, [log(status=70000), log(ms=-1), log(label=2), log()])
    assert contract.range_violations(bad).first().asDict() == {
        "status_code": 1, "response_time_ms": 1, "hour_of_day": 0, "is_weekend": 0, "is_surge": 0, "is_anomaly": 1}


def test_training_frame_limit_and_versions(spark):
    df = logs(spark, [log(), log(), log()])
    assert contract.training_frame(df).columns == contract.FEATURES_V2 + ["is_anomaly"]
    assert contract.training_frame(df, version=1).columns == contract.FEATURES_V1 + ["is_anomaly"]
    assert contract.training_frame(df, limit=2).count() == 2


def test_table_life(spark):
    name = "contract_test_logs"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not tables.exists(spark, name)
    tables.ensure_table(spark, name, contract.V2_SCHEMA, "timestamp")
    tables.ensure_table(spark, name, contract.V2_SCHEMA, "timestamp")
    assert tables.exists(spark, name)
    assert not tables.exists(spark, name, "no_such_table")
    early = log(ts=BASE.replace(day=2))
    tables.append_table(logs(spark, [log(), log(), early]), name, contract.V2_SCHEMA, "timestamp")
    df = tables.read_table(spark, name, contract.V2_SCHEMA)
    assert contract.columns_of(df) == [(f.name, f.dataType.simpleString()) for f in contract.V2_SCHEMA.fields]
    assert df.count() == 3
    tables.drop_days_before(spark, name, "2025-03-02")
    assert tables.read_table(spark, name, contract.V2_SCHEMA).count() == 1
    with pytest.raises(contract.ContractError):
        tables.append_table(logs(spark, [log()]).drop("is_anomaly"), name, contract.V2_SCHEMA, "timestamp")
    tables.truncate(spark, name)
    assert tables.read_table(spark, name, contract.V2_SCHEMA).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_log_tables_are_created_once(spark):
    names = (contract.LOGS_V1, contract.LOGS_V2, contract.ROLLUP_TABLE)
    tables.ensure_log_tables(spark)
    tables.ensure_log_tables(spark)
    assert tables.exists(spark, *names)
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    assert not tables.exists(spark, contract.LOGS_V1)


def test_append_reads_back_whole_and_prunes_days(spark, tmp_path):
    path = str(tmp_path / "logs")
    rows = [log(ts=BASE.replace(day=1 + i % 3), service=f"s{i}") for i in range(30)]
    assert tables.append(logs(spark, rows), path) == 30
    assert tables.append(logs(spark, rows[:5]), path) == 5
    assert tables.read_logs(spark, path).count() == 35
    day = tables.read_logs(spark, path, start="2025-03-02 00:00:00", end="2025-03-03 00:00:00")
    assert {r.timestamp.day for r in day.collect()} == {2}
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_export_keeps_only_high_scores(spark, tmp_path):
    df = logs(spark, [log(ms=2), log(ms=1)]).withColumn("anomaly_score", F.col("response_time_ms").cast("double"))
    path = str(tmp_path / "out")
    assert tables.export_anomalies(df, path, 1.0) == 1
    assert [r.anomaly_score for r in spark.read.parquet(path).collect()] == [2.0]
