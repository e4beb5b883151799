import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from emberline.config import LABELS, Settings
from emberline.functions import moments, scoring, text
from tests.conftest import AS_OF, common, hours_before, values


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text_clean_keeps_runs_of_spaces(spark):
    df = spark.createDataFrame([("Été: A--b", None)], "title string, selftext string")
    row = text.text_features(df).first()
    assert row["text_combined"] == "t   a  b"
    assert (row["text_length"], row["title_length"]) == (8, 9)


def test_text_clean_null_title_and_line_breaks(spark):
    df = spark.createDataFrame([(None, "One\nTwo\tK")], "title string, selftext string")
    row = text.text_features(df).first()
    assert row["text_combined"] == "one two k"
    assert row["title_length"] is None


def test_clip(spark):
    assert one(spark, text.clip(F.lit("abcdef"), 3)) == "abc"
    assert one(spark, text.clip(F.lit("abcdef"), None)) == "abcdef"


@pytest.mark.parametrize(
    "written, expected",
    [("a  b a", ["a", "", "b", "a"]), ("", [""]), ("A b ", ["a", "b"]), (" a", ["", "a"]), ("  ", []), ("a\tb", ["a", "b"])],
)
def test_tokens_equal_the_tokenizer(spark, written, expected):
    from pyspark.ml.feature import Tokenizer

    df = spark.createDataFrame([(written,)], "t string")
    row = Tokenizer(inputCol="t", outputCol="w").transform(df).select("w", text.tokens(F.col("t")).alias("ours")).first()
    assert row["ours"] == row["w"] == expected


def test_embedding_text_skips_null_keeps_empty(spark):
    df = spark.createDataFrame([("t", None), ("t", ""), ("t", "b")], "title string, selftext string")
    assert values(df.select(text.embedding_text().alias("e")), "e") == ["t", "t | ", "t | b"]


@pytest.mark.parametrize("day, expected", [("2024-01-06", (7, 1)), ("2024-01-07", (1, 1)), ("2024-01-08", (2, 0)), (None, (None, 0))])
def test_weekend(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("timestamp").alias("created_ts"))
    row = moments.time_features(df).first()
    assert (row["day_of_week"], row["is_weekend"]) == expected


@pytest.mark.parametrize(
    "hours, bucket", [(5 + 59 / 60, "0-6h"), (6, "6-12h"), (12, "12-24h"), (23.9, "12-24h"), (24, ">24h"), (None, ">24h")]
)
def test_age_bucket(spark, hours, bucket):
    ts = None if hours is None else hours_before(hours)
    df = spark.createDataFrame([(ts,)], "processed_ts timestamp")
    assert df.select(moments.age_bucket(moments.hours_ago(AS_OF)).alias("b")).first()["b"] == bucket


def test_instant_forms_agree(spark):
    forms = ["2024-01-31 00:00:00", AS_OF, AS_OF.replace(tzinfo=dt.timezone.utc), F.lit("2024-01-31").cast("timestamp")]
    assert {one(spark, F.unix_timestamp(moments.instant(form))) for form in forms} == {1706659200}


def test_iso_and_epoch(spark):
    assert one(spark, moments.from_iso(F.lit("not a time"))) is None
    fraction = one(spark, F.date_format(moments.from_epoch(F.lit(1706659200.25)), "ss.SSS"))
    assert fraction == "00.250"


def test_engagement_and_ratio(spark):
    df = common(
        spark,
        dict(id="a", score=100, num_comments=10, num_awards=5),
        dict(id="b", score=100, num_comments=10, num_awards=None),
        dict(id="c", score=0, num_comments=5),
        dict(id="d", score=2, num_comments=5),
    )
    rows = {r["id"]: r for r in scoring.engagement_features(df).collect()}
    assert rows["a"]["engagement_score"] == pytest.approx(54.0)
    assert rows["b"]["engagement_score"] is None
    assert rows["c"]["comment_to_score_ratio"] == 0.0
    assert rows["d"]["comment_to_score_ratio"] == 2.5


def test_content_type(spark):
    rows = [(True, True), (False, True), (False, False), (None, None)]
    df = spark.createDataFrame(rows, "is_video boolean, is_self boolean")
    assert [r["t"] for r in df.select(scoring.content_type().alias("t")).collect()] == ["video", "text", "link", "link"]


def test_labels(spark):
    df = spark.createDataFrame(
        [(100, 0.1), (None, 0.75), (5, 0.7), (5, 0.4), (5, 0.39)], "score long, viral_similarity_score double"
    ).withColumn("is_already_viral", scoring.already_viral())
    rows = [(r["viral_potential_label"], r["is_viral"]) for r in scoring.label_columns(df).collect()]
    assert rows == [("ALREADY_VIRAL", True), ("HIGH", True), ("HIGH", True), ("MEDIUM", False), ("LOW", False)]


def test_label_order(spark):
    df = spark.createDataFrame([(label,) for label in sorted(LABELS)], "viral_potential_label string")
    assert [r[0] for r in df.orderBy(scoring.label_order()).collect()] == list(LABELS)


def test_weights_sum_to_one():
    cfg = Settings()
    for weights in (cfg.engagement_weights, cfg.viral_weights, cfg.similarity_weights):
        assert math.isclose(sum(weights), 1.0)


def test_cleaning_looks_single_characters_up(spark):
    """The class is spelled out, which is one table lookup a character, and means ASCII letters, digits and space."""
    from emberline.functions.text import NOT_PLAIN

    assert "-" not in NOT_PLAIN and "\\" not in NOT_PLAIN
    chars = spark.range(1, 0x3000).selectExpr("char(id) as c").unionByName(spark.sql("SELECT '\U0001F600' as c"))
    odd = chars.filter(F.regexp_replace("c", NOT_PLAIN, " ") != F.regexp_replace("c", r"[^\p{Alnum} ]", " "))
    assert odd.isEmpty()
