import pytest
from pyspark.sql import functions as F

from emberlog.functions import signature as sig, text
from emberlog.functions.score import ratio, sigmoid
from emberlog.sources import adapters


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value,ok", [("[A]:[B]:[C]", True), ("[ORDER]:[/orders/*]:[5xx]", True), ("[A]:[B]", False),
                                      ("[A]:[]:[C]", False), ("x[A]:[B]:[C]", False), ("[A]:[B]:[C]x", False)])
def test_valid_signature(spark, value, ok):
    assert one(spark, sig.valid_signature, value) is ok


def test_split_of_a_raw_line(spark):
    line = "[AUTH]:[LOGIN]:[FAIL] bad password for 12"
    assert one(spark, sig.signature_prefix, line) == "[AUTH]:[LOGIN]:[FAIL]"
    assert one(spark, sig.payload_rest, line) == "bad password for 12"
    assert one(spark, sig.signature_prefix, "plain") == "" and one(spark, sig.payload_rest, "plain") == "plain"


def test_masks(spark):
    raw = "user a.b@c.example.org id 123e4567-e89b-12d3-a456-426614174000 at 0xDEAD took 42ms"
    assert one(spark, sig.mask_tokens, raw) == "user <email> id <guid> at <hex> took <num>ms"
    assert one(spark, sig.mask_tokens, "@ - 0x") == "@ - <num>x"


@pytest.mark.parametrize("url,want", [
    ("/orders/123", "/orders/*"), ("/orders/123/items/9", "/orders/*/items/*"), ("/1/2/3/4", "/*/*/*/*"),
    ("https://h.example/a/12?x=1#y", "/a/*"), ("https://h.example", "/"), ("/v2/users", "/v2/users"), ("/a/7.html", "/a/*.html")])
def test_endpoint_template(spark, url, want):
    assert one(spark, sig.endpoint_template, url) == want


def test_status_class_and_outcome(spark):
    assert one(spark, sig.status_class, 502, "int") == "5xx"
    assert [one(spark, sig.outcome, s, "int") for s in (200, 404, 429, 499, 500, 503)] == [
        "SUCCESS", "FAIL", "FAIL", "CANCELLED", "FAIL", "FAIL"]


def test_top_frame(spark):
    assert one(spark, sig.top_frame, "X: y\n\tat a.B.c(B.java:1)\n\tat d.E.f(E.java:2)") == "a.B.c"
    assert one(spark, sig.top_frame, "look at (this)") is None


def test_derived_signatures_carry_no_ids(spark):
    rows = [("orders", f"/orders/{i}", 500, m, op) for i in range(50)
            for m, op in (("ok", None), ("BadError: 7\n\tat x.Y.z(Y.py:3)", None), ("timed out", "pay"), ("AnError", None))]
    df = spark.createDataFrame(rows, "service_id string, endpoint string, status_code int, log_payload string, operation string")
    got = adapters.derived(df.withColumn("timestamp", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")))
    assert {r.log_signature for r in got.select("log_signature").distinct().collect()} == {
        "[ORDERS]:[/orders/*]:[5xx]", "[ORDERS]:[BadError]:[x.Y.z]", "[ORDERS]:[pay]:[TIMEOUT]", "[ORDERS]:[AnError]:[UNEXPECTED]"}


@pytest.mark.parametrize("service,endpoint,status,message,want", [
    ("orders-api", "/orders/123", 502, "GET /orders/123 failed with status 502 upstream timeout", "[ORDERS]:[/orders/*]:[5xx]"),
    ("payments", None, None, "Call to PaymentGateway.charge failed: TimeoutException after 2000ms", "[PAYMENTS]:[PaymentGateway.charge]:[TIMEOUT]"),
    ("checkout", "/c", 400, "OrderValidationException: missing field 'shippingAddress'", "[CHECKOUT]:[OrderValidationException]:[VALIDATION]"),
    (None, None, 200, None, "[UNKNOWN]:[UNKNOWN]:[2xx]"), ("a", "/x", None, "ok", "[A]:[/x]:[UNKNOWN]")])
def test_signatures_of_raw_messages(spark, service, endpoint, status, message, want):
    df = spark.createDataFrame([(service, endpoint, status, message)], "service_id string, endpoint string, status_code int, log_payload string")
    assert adapters.derived(df.withColumn("timestamp", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))).first()["log_signature"] == want


def test_the_separator_in_a_line_shifts_nothing(spark):
    lines = spark.createDataFrame([("1 a\u0001b c",), ("1 a b\u0001c",), ("1 a b",)], "value string")
    got = adapters.from_text_logs(lines, "^([0-9]+) ([^ ]+) (.*)$", ["n", "x", "y"], {"n": "n", "x": "x", "y": "y"}, {"n": "int"})
    assert [(r.n, r.x, r.y, r.parse_error) for r in got.collect()] == [(None, None, None, "malformed")] * 2 + [(1, "a", "b", None)]


def test_values_that_do_not_fit_are_null_and_named(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("status_code", IntegerType()), StructField("endpoint", StringType())])
    a = spark.createDataFrame([("200", "/x"), ("oops", "/y")], "status_code string, endpoint string")
    b = spark.createDataFrame([(500, "earlier")], "status_code int, parse_error string")
    got = adapters.union_sources(a, b, schema=schema, errors="parse_error").collect()
    assert [tuple(r) for r in got] == [(200, "/x", None), (None, "/y", "bad value: status_code"), (500, None, "earlier")]
    assert adapters.union_sources(a, b, schema=schema).columns == ["status_code", "endpoint"]


def test_every_line_gives_a_row(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    lines = spark.createDataFrame([('{"a":"1","b":"x"}',), ('{"a":"q","b":"y"}',), ("{broken",), ("[1]",), (None,), ("",)], "value string")
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    got = adapters.from_json_logs(lines, schema, {"n": "a", "s": "b"}, {"n": "int"})
    assert got.count() == 6 and adapters.rejected(got).count() == 5
    assert [tuple(r) for r in adapters.accepted(got).collect()] == [(1, "x")]
    assert [(r.n, r.s, r.parse_error) for r in got.where("s = 'y'").collect()] == [(None, "y", "bad value: n")]
    text = spark.createDataFrame([("1 x",), ("q y",), ("z",), (None,)], "value string")
    got = adapters.from_text_logs(text, "^([a-z0-9]+) (.*)$", ["a", "b"], {"n": "a", "s": "b"}, {"n": "int"})
    assert sorted((str(r.raw_line), r.n, r.parse_error) for r in got.collect()) == [
        ("1 x", 1, None), ("None", None, "malformed"), ("q y", None, "bad value: n"), ("z", None, "malformed")]


@pytest.mark.parametrize("message,status,want", [
    ("Call failed: TimeoutException after 2000ms", 200, "TIMEOUT"), ("Connection reset by peer", 200, "CONNECTION"),
    ("OrderValidationException: missing field", 200, "VALIDATION"), ("502 upstream timeout", 502, "TIMEOUT"),
    ("boom", 503, "DEPENDENCY_FAILURE"), ("boom", 500, "UNEXPECTED"), ("KeyError", 200, "UNEXPECTED"),
    ("too many requests", 429, "THROTTLED"), ("x", 401, "AUTH"), ("x", 404, "NOT_FOUND"), ("ok", 200, None), (None, 200, None)])
def test_error_kind(spark, message, status, want):
    df = spark.createDataFrame([(message, status)], "m string, s int").withColumn("e", sig.exception_class("m"))
    assert df.select(sig.error_kind("m", "e", "s").alias("k")).first()["k"] == want


def test_listed_exceptions_come_first(spark):
    df = spark.createDataFrame([("PaymentError: timeout",)], "m string").withColumn("e", sig.exception_class("m"))
    assert df.select(sig.error_kind("m", "e", exceptions={"PaymentError": "AUTH"}).alias("k")).first()["k"] == "AUTH"


def test_text_features(spark):
    msg = "Timeout after timeout\nconnection reset\n  at a.b(C.java:1)\n\tat d(E.java)\nlook at it (now)"
    df = spark.createDataFrame([(msg,)], "t string")
    row = df.select(*[c.alias(n) for n, c in text.text_features("t").items()]).first().asDict()
    assert row == {"n_timeout": 2, "n_connection_reset": 1, "n_validation_error": 0, "n_length": len(msg), "n_lines": 5,
                   "n_stack_frames": 2}


def test_payload_values(spark):
    def read(payload, key):
        return one(spark, lambda c: text.payload_value(c, key), payload)

    assert read("rid=ab12 msg=ok", "rid") == "ab12" and read("rid=ab12 msg=ok", "msg") == "ok"
    assert read("grid=1", "rid") is None and read("rid= x", "rid") == "" and read("rid=1 rid=2", "rid") == "1"


def test_score_arithmetic(spark):
    row = spark.createDataFrame([(6, 4, 0)], "a int, b int, z int").select(
        ratio("a", "b").alias("r"), ratio("a", "z").alias("n"), sigmoid(F.lit(0.0)).alias("s")).first()
    assert row[:] == (1.5, None, 0.5)


def test_vector_columns(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0],)], "v array<float>").select(*text.vector_columns("v", 2))
    assert [r[:] for r in df.collect()] == [(1.0, 2.0), (3.0, None)]
