"""F2/P1/P2 on the literal value table."""


from tunelake.functions.text import has_prefix, is_plain_number, to_count, to_feature

VALUES = ["1", "1.5", "12345678", "12345678.9", "1e3", "-5", " 7", "7 ", "7\n", "",
          "abc", "1.", "0.0005", "٣", None]
PLAIN = {"1": True, "1.5": True, "12345678": True, "12345678.9": True, "1e3": False,
         "-5": False, " 7": False, "7 ": False, "7\n": True, "": False, "abc": False,
         "1.": False, "0.0005": True, "٣": False, None: None}


def _frame(spark):
    return spark.createDataFrame([(v,) for v in VALUES], "s string")


def test_plain_number_java_semantics(spark):
    got = {r.s: r.ok for r in _frame(spark).select("s", is_plain_number("s").alias("ok")).collect()}
    assert got == PLAIN


def test_count_cast_truncates_and_never_fails(spark):
    rows = {r.s: r.n for r in _frame(spark).select("s", to_count("s").alias("n")).collect()}
    assert rows["1.5"] == 1
    assert rows["12345678.9"] == 12345678
    assert rows["-5"] == -5
    assert rows["abc"] is None and rows[""] is None and rows[None] is None
    assert rows["1e3"] == 1000          # casts accept what the regex rejects
    assert rows["0.0005"] == 0


def test_feature_cast(spark):
    rows = {r.s: r.x for r in _frame(spark).select("s", to_feature("s").alias("x")).collect()}
    assert rows["0.0005"] == 0.0005
    assert rows["abc"] is None


def test_prefix_is_pushed_to_parquet(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/part.parquet").filter(has_prefix("p_type", "EC"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan
