import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.operators import audits, dedup, normalise, ranking, reports, selection, similarity
from emberline.schemas import ARCHETYPE, COMMON, EVENT, PREDICTION, mismatches
from emberline.sources.tables import NoRows, require_rows
from tests.conftest import AS_OF, common, hours_before, listing, silver, values


# --- normalisation -------------------------------------------------------------------------


def raw_submission(spark, fields=None, media='{"a": 1}'):
    helpers = ("is_self", "is_original_content", "fetch_source", "fetch_timestamp")
    return listing(spark, fields or {}).drop(*helpers).withColumn("media", F.lit(media).cast("string"))


def test_event_from_submission(spark):
    events = normalise.event_from_submission(raw_submission(spark), AS_OF)
    assert events.columns == EVENT.names and mismatches(events.schema, EVENT) == []
    row = events.first()
    assert row["has_media"] is True and row["ingestion_timestamp"] == "2024-01-31T00:00:00.000000"
    for nothing in (None, "", "{}"):
        assert normalise.event_from_submission(raw_submission(spark, media=nothing), AS_OF).first()["has_media"] is False


def test_normalise_event_fills_and_cuts(spark):
    fields = dict(title="t" * 600, selftext=None, author=None, link_flair_text="")
    row = normalise.normalise_event(normalise.event_from_submission(raw_submission(spark, fields=fields), AS_OF)).first()
    assert len(row["title"]) == 500
    assert (row["selftext"], row["author"], row["link_flair_text"]) == ("", "[deleted]", "unknown")
    long = dict(selftext="b" * 2001)
    events = normalise.event_from_submission(raw_submission(spark, fields=long), AS_OF)
    assert len(normalise.normalise_event(events).first()["selftext"]) == 2000
    whole = Settings(title_limit=None, body_limit=None)
    assert len(normalise.normalise_event(events, whole).first()["selftext"]) == 2001


def test_normalise_listing_defaults(spark):
    raw = listing(spark, dict(author=None, selftext=None, total_awards_received=None, is_original_content=None))
    row = normalise.normalise_listing(raw, AS_OF).first()
    assert (row["author"], row["selftext"], row["total_awards_received"], row["is_original_content"]) == ("None", "", 0, False)
    assert (row["fetch_timestamp"], row["fetch_source"]) == ("2024-01-31T00:00:00.000000", "hot")


def bronze(spark, *rows):
    return normalise.add_bronze_derived(listing(spark, *rows), AS_OF)


def test_bronze_derived(spark):
    row = bronze(spark, dict(created_utc=1706600000.5, fetch_timestamp="oops", is_video=None)).first()
    assert row["created_ts"] == dt.datetime(2024, 1, 30, 7, 33, 20, 500000)
    assert (row["fetch_ts"], row["fetch_date"], row["fetch_hour"], row["has_media"]) == (None, dt.date(2024, 1, 31), 0, False)


def test_harmonise_hot(spark):
    hot = normalise.harmonise_hot(bronze(spark, dict(is_video=None, author="None")))
    assert hot.columns == COMMON.names and mismatches(hot.schema, COMMON) == []
    row = hot.first()
    assert (row["has_media"], row["author"], row["data_source"], row["content_type"]) == (None, "None", "hot_api", "text")
    folded = normalise.harmonise_hot(bronze(spark, dict(author="None")), Settings(fold_missing_author=True))
    assert folded.first()["author"] == "[deleted]"


def test_to_common_refuses_other_types(spark):
    with pytest.raises(TypeError, match="processing_date"):
        normalise.to_common(common(spark, {}).withColumn("processing_date", F.lit("2024-01-30")))


# --- dedup and merge ---------------------------------------------------------------------------


def test_latest_fetch_wins(spark):
    rows = [dict(fetch_timestamp=f"2024-01-30T0{h}:00:00", score=s) for h, s in ((1, 90), (3, 10), (2, 50))]
    assert values(dedup.latest_hot(bronze(spark, *rows)), "id", "score") == [("a", 10)]


def test_columns_made_of_texts_cross_the_exchange_in_their_place(spark):
    """Whole texts decide between copies that agree in all else, and their digests are all that is sent."""
    rows = [dict(id=f"i{n % 9}", selftext=f"body {n * 7919 % 100}") for n in range(60)]
    copies = bronze(spark, *rows)
    wanted = values(dedup.latest_hot(copies).select("id", F.md5("selftext").alias("body")), "id", "body")
    found = dedup.latest_hot(copies, body=F.md5("selftext")).select("id", "body")
    assert values(found, "id", "body") == wanted and len(wanted) == 9
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("md5(") == 1 and plan.index("md5(") > plan.index("Exchange hashpartitioning(id")
    with pytest.raises(ValueError, match="selftext"):
        dedup.latest_hot(copies, selftext=F.md5("selftext"))


def test_rows_of_a_written_table_are_chosen_in_place(spark, tmp_path):
    """Several files, more rows in one than a bitmap has bits; none, some and all rows chosen; null keys included."""
    path = str(tmp_path / "rows")
    rows = spark.range(0, 150_000, 1, 3).selectExpr("if(id % 4 = 0, null, id div 2) as key", "id as at", "concat('text ', id) as text")
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    for n in (0, 1, 200_000):
        wanted = values(dedup.first_n(stored, n, ["key"], ["at desc"]), *stored.columns)
        found = dedup.chosen_in_place(stored, ["key", "at"], lambda narrow: dedup.first_n(narrow, n, ["key"], ["at desc"]))
        assert found.columns == stored.columns and values(found, *stored.columns) == wanted
        assert len(wanted) == {0: 0, 1: 75_001, 200_000: 150_000}[n]
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_tie_goes_to_the_later_row(spark):
    df = common(spark, dict(processed_ts=hours_before(5), title="old"), dict(processed_ts=hours_before(1), title="new"))
    assert values(dedup.dedup(df), "title") == ["new"]


def test_only_rows_of_keys_above_the_limit_are_ranked(spark):
    """The same rows as a ranking of all, null keys included; the rest of the rows stays where it is."""
    rows = [(k, at, f"{k}{at}") for k, n in (("a", 1), ("b", 3), (None, 2), ("c", 2), ("d", 1)) for at in range(n)]
    df = spark.createDataFrame(rows, "id string, at int, text string")
    for n in (1, 2, 5):
        wanted = values(dedup.first_n(df, n, ["id"], ["at asc"]), *df.columns)
        for few in (0, 1, 100):
            assert values(dedup.first_n_in_place(df, n, "id", ["at asc"], few), *df.columns) == wanted
    plan = dedup.first_n_in_place(df, 5, "id", ["at asc"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = dedup.first_n_in_place(df, 1, "id", ["at asc"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 2


def test_first_seen(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 9), ("b", 3, 2)], "id string, source_pos int, listing_pos int")
    assert values(dedup.first_seen(df), "id", "source_pos") == [("a", 1), ("b", 3)]


def test_pinned_rows_use_up_the_limit(spark):
    df = spark.createDataFrame(
        [("a", "l", 0, True), ("b", "l", 1, None), ("c", "l", 2, False)], "id string, listing string, listing_pos int, stickied boolean"
    )
    assert values(dedup.drop_stickied(dedup.top_n_listing(df, 2)), "id") == ["b"]


def test_old_best_copy_hides_the_recent_one(spark):
    stream = silver(
        spark,
        dict(id="a", score=95, processed_ts=hours_before(30)),
        dict(id="b", score=95, processed_ts=hours_before(30)),
        dict(id="b", score=96, processed_ts=hours_before(2)),
    )
    hot = bronze(spark, dict(id="a", score=90, fetch_timestamp="2024-01-30T22:00:00"))
    merged = dedup.merge_sources(stream, hot)
    assert values(selection.recent(merged, AS_OF), "id") == ["b"]
    history = dedup.merge_history(stream, hot, AS_OF, 24)
    assert values(selection.recent(history, AS_OF), "id") == ["b"]


def test_texts_cross_the_merge_once(spark):
    """Hot copies take the texts of their stream copy if these are the same, and bring their own otherwise; a stored
    cleaned text that is not what cleaning gives is kept. All ways to ship them give the same rows."""
    stream = silver(
        spark, dict(id="a", score=1, text_combined="stored otherwise"), dict(id="b", score=9, text_combined="stored otherwise"),
        dict(id="c", score=1, title=None, selftext="x"), dict(id="d", score=1), dict(id="d", score=0, title="Another"),
        dict(id="e", score=9, text_combined="a long enough title body"), dict(id=None, score=1), dict(id="g", score=9, text_combined=None),
    )
    at = "2024-01-30T22:00:00"
    hot = bronze(
        spark, *[dict(id=i, score=5, fetch_timestamp=at) for i in ("a", "b", "d", "e", "f", "g")],
        dict(id="c", score=5, title="x", selftext=None, fetch_timestamp=at), dict(id=None, score=5, title="T", fetch_timestamp=at),
    )
    slim = normalise.mark_stream(stream), normalise.harmonise_hot(hot, Settings(), False)
    assert values(dedup.texts_apart(*slim), "_key") == sorted(["c", "d", "f", None], key=str)
    whole = "A long enough title", "body", "a long enough title body"
    wanted = [("a", *whole), ("b", *whole[:2], "stored otherwise"), ("c", "x", None, "x"), ("d", *whole), ("e", *whole),
              ("f", *whole), ("g", *whole[:2], None), (None, "T", "body", "t body")]
    for few in (0, 3, 100):
        merged = dedup.merge_sources(stream, hot, few=few)
        assert values(merged, "id", "title", "selftext", "text_combined") == sorted(wanted, key=lambda r: str(r))
        lengths = [(r[0], len(r[1] or ""), len(r[3] or "")) for r in wanted if r[0] not in ("b", "e", "g")]
        hot_rows = merged.filter("data_source = 'hot_api'").select("id", F.coalesce("title_length", F.lit(0)), "text_length")
        assert values(hot_rows, *hot_rows.columns) == sorted(lengths, key=str)


def test_columns_made_of_texts_cross_the_merge_in_their_place(spark):
    """Rows as made of the whole merge, equal copies that the hash of all columns tells apart included; no text is sent."""
    stream = silver(
        spark, *[dict(id=f"i{n % 9}", selftext=f"body {n * 7919 % 100}", text_combined="stored otherwise") for n in range(60)],
        dict(id="s", score=61), dict(id="t", score=9, selftext=None, text_combined=None), dict(id=None, score=1),
    )
    at = "2024-01-30T22:00:00"
    hot = bronze(
        spark, *[dict(id=f"i{n % 9}", score=60 + n % 2, selftext=f"hot {n * 31 % 100}", fetch_timestamp=at) for n in range(60)],
        dict(id="s", score=5), dict(id="t", score=10, selftext=None), dict(id="h", title="T!"), dict(id=None, title=None),
    )
    digests = {name: F.md5(name) for name in ("selftext", "text_combined")}
    wanted = values(dedup.merge_sources(stream, hot).withColumns(digests), *COMMON.names)
    found = dedup.merge_sources(stream, hot, made=digests)
    assert found.columns == COMMON.names and values(found, *COMMON.names) == wanted and len(wanted) == 13
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    behind, ahead = plan.split("Exchange hashpartitioning(id")
    assert "md5(" in ahead and "md5(" not in behind and "regexp_replace" in ahead and "regexp_replace" not in behind
    some = dedup.merge_sources(stream, hot, columns=["id", "selftext"], made={"text_combined": F.md5("text_combined")})
    assert some.columns == ["id", "selftext", "text_combined"]
    assert values(some.withColumn("selftext", F.md5("selftext")), *some.columns) == values(found, *some.columns)
    with pytest.raises(ValueError, match="score"):
        dedup.merge_sources(stream, hot, made={"score": F.col("score") + 1})


def test_history_merge_equals_full_merge(spark):
    """Random copies: the slim history gives the same recent rows and the same number of winners."""
    copies = spark.range(4000).selectExpr(
        "cast(pmod(hash(id), 500) as string) as id",
        "cast(pmod(hash(id, 1), 40) as bigint) as score",
        "pmod(hash(id, 2), 90) as age",
        "pmod(hash(id, 3), 2) = 0 as hot",
    )
    ts = F.expr("timestamp '2024-01-31 00:00:00' - make_dt_interval(0, age)")
    base = silver(spark, {}).drop("id", "score", "processed_ts")
    stream = (
        copies.filter("not hot").withColumn("processed_ts", ts).drop("age", "hot").crossJoin(base).select(*COMMON.names[:-1])
    )
    hot = (
        copies.filter("hot")
        .withColumn("fetch_timestamp", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .drop("age", "hot")
        .crossJoin(listing(spark, {}).drop("id", "score", "fetch_timestamp"))
    )
    hot = normalise.add_bronze_derived(hot, AS_OF)
    full, slim = dedup.merge_sources(stream, hot), dedup.merge_history(stream, hot, AS_OF, 24)
    assert full.count() == slim.count() == copies.select("id").distinct().count()
    kept = [c for c in COMMON.names]
    assert values(selection.recent(full, AS_OF), *kept) == values(selection.recent(slim, AS_OF), *kept)


def test_null_ids_form_one_group(spark):
    df = common(spark, dict(id=None, score=1), dict(id=None, score=2))
    assert values(dedup.dedup(df), "score") == [2]


# --- selection -----------------------------------------------------------------------------------


def test_window_widens_only_when_empty(spark):
    old = [dict(id="a", processed_ts=hours_before(30)), dict(id="b", processed_ts=hours_before(47))]
    far = dict(id="d", processed_ts=hours_before(49))
    assert values(selection.recent_or_widen(common(spark, *old, far), AS_OF), "id") == ["a", "b"]
    fresh = dict(id="c", processed_ts=hours_before(24))
    assert values(selection.recent_or_widen(common(spark, *old, far, fresh), AS_OF), "id") == ["c"]
    assert values(selection.recent_or_widen(common(spark, far), AS_OF), "id") == []


def test_criteria_bounds_and_nulls(spark):
    df = common(
        spark,
        dict(id="ok", score=50, num_comments=5, text_length=11),
        dict(id="score", score=49),
        dict(id="comments", num_comments=4),
        dict(id="short", text_length=10),
        dict(id="deleted", author="[deleted]"),
        dict(id="removed", author="[removed]"),
        dict(id="nobody", author=None),
        dict(id="null", score=None),
    )
    assert values(selection.viral(df), "id") == ["ok"]
    assert values(selection.viral_tiered(df), "id") == ["ok"]


def test_relaxed_tier_only_when_no_strict_row(spark):
    relaxed = dict(id="r", score=20, num_comments=2, text_length=8)
    assert values(selection.viral_tiered(common(spark, relaxed)), "id") == ["r"]
    assert values(selection.viral_tiered(common(spark, relaxed, dict(id="s"))), "id") == ["s"]
    assert values(selection.viral_tiered(common(spark, dict(score=1))), "id") == []


def test_anti_join_drops_null_ids(spark):
    posts = common(spark, dict(id="a"), dict(id="b"), dict(id=None))
    assert values(selection.exclude_ids(posts, common(spark, dict(id="a"))), "id") == ["b"]
    assert values(selection.exclude_ids(posts, common(spark, dict(id="a")).limit(0)), "id") == ["a", "b"]
    assert values(selection.exclude_ids(posts, common(spark, dict(id=None))), "id") == ["a", "b"]


# --- ranking ---------------------------------------------------------------------------------------


def scored(spark, *rows):
    df = common(spark, *rows)
    return ranking.viral_scores(df, ranking.viral_maxima(df))


def test_viral_score(spark):
    df = scored(
        spark,
        dict(id="a", score=100, num_comments=10, num_awards=0, ratio=0.9),
        dict(id="b", score=50, num_comments=20, num_awards=0, ratio=0.5),
    )
    result = dict(values(df, "id", "viral_score"))
    assert result == {"a": pytest.approx(0.64), "b": pytest.approx(0.55)}
    assert values(df, "awards_norm") == [0.0, 0.0]


def test_zero_maxima_do_not_divide(spark):
    row = scored(spark, dict(score=0, num_comments=0)).first()
    assert (row["score_norm"], row["comments_norm"]) == (0.0, 0.0)


def test_ranks_are_dense_and_deterministic(spark):
    rows = [dict(id=f"p{i:02d}", score=60 + i % 3, num_comments=10) for i in range(50)]
    results = []
    for partitions in (1, 7):
        df = scored(spark, *rows).repartition(partitions)
        top = ranking.stamp(ranking.top_archetypes(df), AS_OF, "extraction")
        assert mismatches(top.schema, ARCHETYPE) == [] and set(top.columns) == set(ARCHETYPE.names)
        results.append([(r["archetype_rank"], r["id"]) for r in top.orderBy("archetype_rank").collect()])
    assert results[0] == results[1]
    assert [rank for rank, _ in results[0]] == list(range(1, 41))
    assert results[0][0][1] == "p02"


# --- similarity ---------------------------------------------------------------------------------------


def profile(spark, eng=100.0, length=200.0, ratio=0.8):
    return spark.createDataFrame(
        [(eng, length, ratio)], "avg_engagement double, avg_text_length double, avg_ratio double"
    )


def frequencies(spark, col, pairs):
    return spark.createDataFrame([(k, n, n / 40) for k, n in pairs], f"{col} string, n long, share double")


def similar(spark, post, prof=None, subreddits=(("a", 20),)):
    df = common(spark, post)
    types = frequencies(spark, "content_type", [("text", 10)])
    subs = frequencies(spark, "subreddit", subreddits)
    return similarity.similarity(df, prof or profile(spark), subs, types).first()["viral_similarity_score"]


@pytest.mark.parametrize(
    "post, expected",
    [
        (dict(subreddit="a", content_type="text", engagement_score=50.0, text_length=100, ratio=0.9), 0.5),
        (dict(subreddit="z", content_type="link", engagement_score=0.0, text_length=500, ratio=0.4), 0.05),
        (dict(subreddit="a", content_type="text", engagement_score=60.0, text_length=100, ratio=None), 0.425),
        (dict(subreddit="z", content_type="link", engagement_score=-100.0, text_length=None, ratio=0.0), -0.25),
        (dict(subreddit="z", content_type="link", engagement_score=None, text_length=200, ratio=0.8), 0.25),
    ],
)
def test_similarity(spark, post, expected):
    assert similar(spark, post) == pytest.approx(expected)


def test_similarity_without_positive_means(spark):
    post = dict(subreddit="a", content_type="text", engagement_score=50.0, text_length=100, ratio=0.9)
    assert similar(spark, post, profile(spark, 0.0, None, -1.0)) == pytest.approx(0.2)


def test_similarity_is_capped_and_null_keys_match(spark):
    post = dict(subreddit=None, content_type="text", engagement_score=500.0, text_length=200, ratio=1.0)
    assert similar(spark, post, subreddits=((None, 400),)) == 1.0


def test_frequencies_divide_by_the_constant(spark):
    df = common(spark, dict(id="a"), dict(id="b"), dict(id="c", subreddit="t"))
    assert values(similarity.archetype_frequencies(df, "subreddit"), "subreddit", "n", "share") == [("s", 2, 0.05), ("t", 1, 0.025)]


def test_predictions_partition_the_candidates(spark):
    posts = silver(spark, *[dict(id=f"p{i}", score=i * 3, processed_ts=hours_before(i)) for i in range(40)])
    archetypes = common(spark, dict(id="p1"), dict(id="p2"))
    from emberline.plans.prediction import predict

    predicted = similarity.prediction_rows(predict(posts, archetypes, AS_OF), AS_OF)
    assert predicted.columns == PREDICTION.names and mismatches(predicted.schema, PREDICTION) == []
    assert sorted(values(predicted, "id")) == sorted(f"p{i}" for i in range(25) if i not in (1, 2))
    totals = reports.prediction_totals(predicted).first()
    parts = ("already_viral", "high_potential", "medium_potential", "low_potential")
    assert totals["total_posts"] == 23 == sum(totals[p] for p in parts)
    assert totals["max_similarity"] <= 1.0


# --- audits and reports ----------------------------------------------------------------------------------


def test_duplicate_audit_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    assert tuple(audits.duplicate_audit(df).first()) == (5, 3, 2)
    assert tuple(audits.duplicate_audit(df.limit(0)).first()) == (0, 0, 0)


def test_source_counts_keep_silent_sources(spark):
    posts = spark.createDataFrame([("x",), ("x",), ("y",)], "listing string")
    sources = spark.createDataFrame([("y",), ("z",), ("x",)], "listing string")
    assert [tuple(r) for r in audits.source_counts(posts, sources).collect()] == [("x", 2), ("y", 1), ("z", 0)]


def test_split_and_totals_on_empty_input(spark):
    empty = common(spark, {}).limit(0)
    assert tuple(audits.viral_split(similarity.viral_flag(empty)).first()) == (0, 0)
    labelled = empty.selectExpr("'LOW' as viral_potential_label", "ratio as viral_similarity_score")
    assert tuple(reports.prediction_totals(labelled).first()) == (0, 0, 0, 0, 0, None, None)


def test_observed_counts_without_a_job(spark):
    df, seen = audits.observed(spark.range(7), "seven", F.max("id").alias("top"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "top": 6}


def test_reports_order(spark):
    df = spark.createDataFrame(
        [("LOW", 1, 0.1, "a"), ("HIGH", 5, 0.9, "a"), ("LOW", 3, 0.3, "b"), ("ALREADY_VIRAL", 200, 0.2, "b")],
        "viral_potential_label string, score long, viral_similarity_score double, content_type string",
    )
    assert [r[:3] for r in map(tuple, reports.label_distribution(df).collect())] == [
        ("ALREADY_VIRAL", 1, 200.0), ("HIGH", 1, 5.0), ("LOW", 2, 2.0)
    ]
    assert [tuple(r) for r in reports.type_by_label(df).collect()] == [
        ("a", "HIGH", 1), ("a", "LOW", 1), ("b", "ALREADY_VIRAL", 1), ("b", "LOW", 1)
    ]


def test_require_rows(spark):
    with pytest.raises(NoRows, match="nothing"):
        require_rows(spark.range(0), "nothing")
    assert require_rows(spark.range(2), "x").count() == 2
