"""Whole runs on files, and the physical plans they rest on."""

import datetime as dt
import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.operators import dedup, normalise, reports, selection
from emberline.operators.similarity import candidates
from emberline.plans import extraction, intake, prediction, queries
from emberline.plans.extraction import run_extraction
from emberline.schemas import ARCHETYPE, PREDICTION, SILVER, mismatches
from emberline.sinks.tables import write_bronze
from emberline.sources import testbed
from emberline.sources.tables import NoRows, read_batches, read_table
from tests.conftest import AS_OF, common, hours_before, listing, silver, values

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summary_of(folder) -> dict:
    (file,) = Path(folder).glob("part-*.json")
    return json.loads(file.read_text())


@pytest.fixture
def lake(spark, tmp_path):
    """A small lake on disk: silver posts and two hot fetches."""
    rows = [
        dict(id=f"p{i:02d}", subreddit="ab"[i % 2], score=30 + i, num_comments=i, num_awards=i % 3,
             processed_ts=hours_before(i % 30), text_length=20 + i)
        for i in range(60)
    ]
    silver(spark, *rows).write.parquet(str(tmp_path / "silver"))
    listings = (
        listing(spark, *[dict(id=f"p{i:02d}", score=200 + i, subreddit="c") for i in range(0, 60, 6)], dict(id="pin"))
        .withColumns({"listing": F.lit("c"), "source_pos": F.lit(0), "listing_pos": F.monotonically_increasing_id(),
                      "stickied": F.col("id") == "pin", "fetch_timestamp": F.lit("2024-01-30T23:00:00")})
    )
    sources = spark.createDataFrame([("c",), ("empty",)], "listing string")
    for hours in (7, 1):
        summary = intake.run_hot_fetch(listings, sources, str(tmp_path / "bronze"), hours_before(hours))
    assert summary.first()["total_posts"] == 10
    return tmp_path


def extract(spark, lake, as_of=AS_OF, cfg=Settings()):
    return run_extraction(spark, str(lake / "silver"), str(lake / "bronze"), str(lake / "arch"), str(lake / "emb"), as_of, cfg)


def test_fetch_writes_batches_and_summary(spark, lake):
    rows = read_batches(spark, str(lake / "bronze"))
    assert values(rows.groupBy("batch").count(), "batch", "count") == [("2024-01-30_17-00", 10), ("2024-01-30_23-00", 10)]
    meta = summary_of(lake / "bronze" / "2024-01-30_23-00" / "_summary")
    assert meta["fetch_stats"] == {"c": 10, "empty": 0}
    assert (meta["unique_posts"], meta["duplicates_removed"], meta["subreddits_fetched"]) == (10, 0, 2)
    assert meta["fetch_datetime"] == "2024-01-30T23:00:00"


def test_extraction_run(spark, lake):
    summary = extract(spark, lake, cfg=Settings(top_n=5)).first()
    assert summary["total_posts_analyzed"] == 60
    assert summary["archetypes_extracted"] == 5
    assert summary["content_types"] == {"text": 5}
    arch = spark.read.parquet(str(lake / "arch"))
    assert mismatches(arch.schema, ARCHETYPE) == []
    assert values(arch, "archetype_rank") == [1, 2, 3, 4, 5]
    assert spark.read.parquet(str(lake / "emb_prep")).count() == 5
    assert spark.read.parquet(str(lake / "emb")).schema["tfidf_features"].dataType.typeName() == "vectorudt"
    meta = summary_of(lake / "arch" / "_summary")
    assert meta["top_subreddits"] == summary["top_subreddits"] and meta["lookback_hours"] == 24


def test_extraction_without_posts_keeps_the_last_archetypes(spark, lake):
    extract(spark, lake)
    before = values(spark.read.parquet(str(lake / "arch")), "id")
    with pytest.raises(NoRows):
        extract(spark, lake, as_of=AS_OF + dt.timedelta(days=30))
    assert values(spark.read.parquet(str(lake / "arch")), "id") == before


def test_prediction_run(spark, lake):
    extract(spark, lake, cfg=Settings(top_n=5))
    args = (spark, str(lake / "silver"), str(lake / "arch"), str(lake / "pred"), AS_OF)
    summary = prediction.run_prediction(*args, run_id="r", embeddings_path=str(lake / "emb")).first()
    prediction.run_prediction(*args, run_id="r", embeddings_path=str(lake / "none"))
    stored = spark.read.parquet(str(lake / "pred"))
    assert stored.count() == summary["posts_scored"] == sum(summary["predictions"])
    archetypes = set(values(spark.read.parquet(str(lake / "arch")), "id"))
    assert not archetypes & set(values(stored, "id"))
    assert set(PREDICTION.names) <= set(stored.columns)
    meta = summary_of(lake / "pred" / "_summary_20240131_0000")
    assert meta["thresholds"] == {"high": 0.7, "medium": 0.4} and meta["archetypes_used"] == 5


def test_prediction_without_candidates(spark, lake):
    extract(spark, lake)
    later = AS_OF + dt.timedelta(days=30)
    summary = prediction.run_prediction(spark, str(lake / "silver"), str(lake / "arch"), str(lake / "pred"), later).first()
    assert summary["posts_scored"] == 0 and summary["predictions"]["high_potential"] == 0


def test_damaged_batch_fails_the_run_unless_it_is_tolerant(spark, lake):
    broken = lake / "bronze" / "2024-02-01_00-00" / "fetch_date=2024-02-01" / "subreddit=s"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception, match="CANNOT_READ|Parquet|parquet"):
        extract(spark, lake)
    args = (str(lake / n) for n in ("silver", "bronze", "arch", "emb"))
    summary = run_extraction(spark, *args, AS_OF, tolerant=True).first()
    assert (summary["skipped_files"], summary["lost_rows"]) == (1, 0)


def test_stream_written_silver_passes_extraction_and_prediction(spark, lake):
    """Partitioned by day, as the stream writes it."""
    silver_rows = spark.read.parquet(str(lake / "silver")).withColumn("processing_date", F.to_date("processed_ts"))
    silver_rows.write.partitionBy("processing_date").parquet(str(lake / "by_day"))
    args = (spark, str(lake / "by_day"))
    found = run_extraction(*args, str(lake / "bronze"), str(lake / "arch"), str(lake / "emb"), AS_OF, Settings(top_n=5))
    assert found.first()["archetypes_extracted"] == 5
    summary = prediction.run_prediction(*args, str(lake / "arch"), str(lake / "pred"), AS_OF).first()
    assert summary["posts_scored"] > 0
    stored = read_table(spark, str(lake / "by_day"), SILVER)
    arch = read_table(spark, str(lake / "arch"), ARCHETYPE)
    for df in (
        prediction.predict(stored, arch, AS_OF),
        dedup.box_history(stored, "processed_ts", F.lit(AS_OF), ["id", "processed_ts"]),
    ):
        assert "PartitionFilters: [isnotnull(processing_date" in plan(df)


def test_fetch_from_a_landing_folder(spark, tmp_path):
    rows = listing(spark, dict(id="a"), dict(id="b"), dict(id="pin")).withColumns(
        {"listing": F.lit("c"), "source_pos": F.lit(0), "listing_pos": F.monotonically_increasing_id(), "stickied": F.col("id") == "pin"}
    )
    rows.write.json(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.json").write_text("{broken\n")
    sources = spark.createDataFrame([("c",)], "listing string")
    summary = intake.run_hot_fetch(str(tmp_path / "in"), sources, str(tmp_path / "bronze"), AS_OF).first()
    assert (summary["total_posts"], summary["malformed_lines"]) == (2, 1)
    assert values(read_batches(spark, str(tmp_path / "bronze")), "id") == ["a", "b"]


def test_a_fetch_leaves_no_staged_rows_and_a_summary_that_can_be_read(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {n for n in os.listdir(shared) if n.startswith("fetched-")}
    rows = listing(spark, dict(id="a"), dict(id="a"), dict(id="b")).selectExpr(
        "*", "'s' as listing", "0 as source_pos", "monotonically_increasing_id() as listing_pos", "false as stickied"
    )
    summary = intake.run_hot_fetch(rows, spark.createDataFrame([("s",), ("t",)], "listing string"), str(tmp_path), AS_OF)
    assert {n for n in os.listdir(shared) if n.startswith("fetched-")} == before
    row = summary.first()
    assert (row["total_posts"], row["duplicates_removed"], row["fetch_stats"]) == (3, 1, {"s": 3, "t": 0})


def test_texts_of_a_fetched_frame_go_straight_to_the_batch(spark, tmp_path, monkeypatch):
    """What is counted is staged alone; batch and summary are those of the same rows landed as lines and staged whole."""
    wide = [dict(id=f"i{n % 9}" if n % 4 else None, title=f"title {n}", subreddit="ab"[n % 2]) for n in range(24)]
    rows = listing(spark, *wide, dict(id="pin")).withColumns(
        {"listing": F.when(F.col("id") == "i3", "all").otherwise(F.col("subreddit")), "source_pos": F.lit(0), "stickied": F.col("id") == "pin",
         "listing_pos": F.xxhash64("title")}
    ).filter("id IS NOT NULL")
    rows.coalesce(1).write.json(str(tmp_path / "in"))
    sources, names, made = spark.createDataFrame([("a",), ("b",), ("all",)], "listing string"), [], []
    kept = intake.staged
    monkeypatch.setattr(intake, "staged", lambda df, name: names.append(df.columns) or kept(df, name))
    for listings in (rows, str(tmp_path / "in")):
        root = str(tmp_path / f"bronze{len(made)}")
        summary = intake.run_hot_fetch(listings, sources, root, AS_OF, Settings(listing_limit=7)).first()
        batch = read_batches(spark, root)
        made.append((summary["total_posts"], summary["unique_posts"], summary["fetch_stats"], values(batch, *batch.columns)))
    assert made[0] == made[1] and len(made[0][3]) == made[0][1] < made[0][0]
    assert names[0] == ["id", "listing"] and "selftext" in names[1]


def test_equal_keys_have_one_winner_in_any_layout(spark):
    rows = [dict(id=f"i{n % 20}", title=f"title {n}", url=f"u{n * 7919 % 100}") for n in range(100)]
    kept = [values(dedup.dedup(common(spark, *rows).repartition(n)), "id", "title") for n in (1, 7)]
    assert kept[0] == kept[1] and len(kept[0]) == 20


# --- plans ---------------------------------------------------------------------------------------


def test_dedup_limits_ranks_before_the_shuffle(spark):
    text = plan(dedup.dedup(common(spark, {})))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_merge_crosses_one_exchange(spark, tmp_path):
    """Both sources meet by id once, and a task sends a copy of each source an id at most."""
    silver(spark, {}).write.parquet(str(tmp_path / "s"))
    normalise.add_bronze_derived(listing(spark, {}), AS_OF).write.parquet(str(tmp_path / "b"))
    posts, hot = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "b"))
    for merged in (dedup.merge_sources(posts, hot), dedup.merge_history(posts, hot, AS_OF, 48)):
        text = plan(merged)
        assert text.count("Exchange hashpartitioning(id") == text.count("Exchange ") == 1
        before, after = text.split("Exchange hashpartitioning(id")
        assert "partial_max_by" in after and "partial_max_by" not in before


def test_merge_takes_the_last_fetch_against_the_best_stream_copy(spark):
    def hot(id, score, at, **more):
        return dict(id=id, score=score, fetch_timestamp=at, **more)

    bronze = normalise.add_bronze_derived(
        listing(
            spark, hot("a", 90, "2024-01-30T10:00:00"), hot("a", 10, "2024-01-30T12:00:00"), hot("b", 5, "2024-01-30T10:00:00"),
            hot("c", 7, "2024-01-30T22:00:00"), hot("d", 8, "2024-01-30T10:00:00"), hot("e", None, "2024-01-30T10:00:00"),
            hot(None, 3, "2024-01-30T10:00:00"), hot("g", None, "2024-01-30T10:00:00"),
        ),
        AS_OF,
    )
    stream = silver(
        spark, dict(id="a", score=11), dict(id="b", score=5, processed_ts=dt.datetime(2024, 1, 30, 10)), dict(id="c", score=7),
        dict(id="d", score=9), dict(id="d", score=4), dict(id="e", score=None), dict(id="f", score=1), dict(id=None, score=4),
    )
    wanted = [("a", 11, "stream"), ("b", 5, "hot_api"), ("c", 7, "hot_api" if hours_before(2).hour == 22 else "stream"),
              ("d", 9, "stream"), ("e", None, "stream"), ("f", 1, "stream"), ("g", None, "hot_api"), (None, 4, "stream")]
    for merged in (dedup.merge_sources(stream, bronze), dedup.merge_history(stream, bronze, AS_OF, 48)):
        assert values(merged, "id", "score", "data_source") == sorted(wanted, key=str)


def test_history_scan_reads_narrow_columns_and_pushes_the_window(spark, tmp_path):
    silver(spark, {}).write.parquet(str(tmp_path / "s"))
    bronze = normalise.add_bronze_derived(listing(spark, {}), AS_OF)
    bronze.write.parquet(str(tmp_path / "b"))
    merged = dedup.merge_history(
        spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "b")), AS_OF, 48
    )
    scans = [line for line in plan(selection.recent(merged, AS_OF, 48)).splitlines() if "FileScan" in line]
    assert len(scans) == 4
    narrow = [line for line in scans if "selftext" not in line]
    assert len(narrow) == 2
    recent = [line for line in scans if "selftext" in line]
    assert all("GreaterThanOrEqual" in line.split("PushedFilters")[1] for line in recent)


def test_prediction_plan_has_no_python_and_no_shuffle_of_posts(spark, tmp_path):
    silver(spark, *[dict(id=str(i)) for i in range(5)]).write.parquet(str(tmp_path / "s"))
    common(spark, {}).write.parquet(str(tmp_path / "a"))
    posts, arch = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "a"))
    text = plan(prediction.predict(posts, arch, AS_OF))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("BroadcastHashJoin") == 3
    scan = next(line for line in text.splitlines() if "FileScan" in line and "processed_ts" in line)
    assert "GreaterThanOrEqual(processed_ts" in scan
    assert "Window" not in text


def test_large_id_list_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        posts = common(spark, *[dict(id=str(i)) for i in range(50)])
        ids = spark.range(5000).select(F.col("id").cast("string"))
        assert "BroadcastHashJoin" not in plan(selection.exclude_ids(posts, ids))
        assert selection.exclude_ids(posts, ids).count() == 0
        arch = common(spark, *[dict(id=str(i)) for i in range(10)])
        assert candidates(posts.drop("data_source"), arch, AS_OF).count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_archetypes_never_sort_globally(spark):
    df = common(spark, {}).withColumn("viral_score", F.lit(0.1))
    from emberline.operators.ranking import top_archetypes

    text = plan(top_archetypes(df))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


# --- skew: one id, one subreddit, one listing with a third of the rows --------------------------------


def test_hot_keys_keep_results_whole(spark):
    n = 6000
    rows = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as id", "id as score", "id as listing_pos",
        "if(id % 3 = 0, 'hot', concat('l', id % 5)) as listing",
        "timestamp'2024-01-30 12:00:00' as processed_ts", "'stream' as data_source", "1L as num_comments",
    ).repartition(8)
    kept = dedup.dedup(rows)
    assert kept.count() == n - n // 3 + 1
    assert kept.filter("id = 'hot'").first()["score"] == n - 3
    heads = dedup.top_n_listing(rows, 50).groupBy("listing").agg(F.count("*").alias("n"), F.max("listing_pos").alias("last"))
    assert {r["n"] for r in heads.collect()} == {50}
    assert heads.filter("listing = 'hot'").first()["last"] == 147
    # What reaches the shuffle: at most one row per id and task, at most fifty per listing and task.
    before = rows.rdd.getNumPartitions()
    partial = plan(dedup.top_n_listing(rows, 50))
    assert before == 8 and "row_number(), 50, Partial" in partial


def test_results_do_not_depend_on_partitions(spark):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        return (
            values(queries.registered()["archetypes_top40"](spark, SMALL), "id", "archetype_rank", "viral_score"),
            values(queries.registered()["label_distribution"](spark, SMALL), "viral_potential_label", "count"),
        )

    try:
        assert run("1") == run("7")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_testbed_covers_whole_tables(spark):
    posts = testbed.submissions(spark, SMALL)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    assert posts.count() == events.count()
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    lengths = posts.selectExpr("length(concat(title, coalesce(selftext, ''))) as n").agg(F.max("n")).first()[0]
    assert lengths == documents.agg(F.max(F.length("text"))).first()[0]


def test_preview_reports(spark):
    arch = common(spark, *[dict(id=str(i)) for i in range(20)]).selectExpr(
        "*", "cast(id as int) + 1 as archetype_rank", "0.5d as viral_score")
    assert [r["id"] for r in reports.archetype_preview(arch).collect()] == [str(i) for i in range(10)]
    assert reports.archetype_leaders(arch).count() == 5
    assert extraction.recent_window(arch, AS_OF).count() == 20


def test_the_stored_extraction_reads_its_winners_where_they_lie(spark, tmp_path):
    """Same posts as the merge of whole rows, in place, and no text is staged but those of the archetypes."""
    rng = random.Random(8)

    def text():
        return " ".join(f"{rng.getrandbits(60):x}" for _ in range(400))

    posts = [
        dict(id=rng.choice([None, *(f"p{i}" for i in range(40))]), title=text()[:90], selftext=text(), text_combined=text(),
             score=50 + n, processed_ts=rng.choice([None, *map(hours_before, (1, 20, 40, 60, 200))]))
        for n in range(90)
    ]
    for p in posts:
        p["processing_date"] = p["processed_ts"] and p["processed_ts"].date()
    silver(spark, *posts).repartition(3).write.partitionBy("processing_date").parquet(str(tmp_path / "silver"))
    for at in (hours_before(60), hours_before(2)):
        rows = listing(spark, *[dict(id=f"p{i}", selftext=text(), score=100 + rng.randint(0, 60)) for i in range(0, 50, 2)])
        rows = rows.withColumn("fetch_timestamp", F.lit(f"{at:%Y-%m-%dT%H:%M:%S}"))
        write_bronze(normalise.add_bronze_derived(rows, at), str(tmp_path / "bronze"), at)
    stored = read_table(spark, str(tmp_path / "silver"), SILVER)
    batches = read_batches(spark, str(tmp_path / "bronze"), places=True)
    whole, counted = extraction.stage_recent(stored, batches.drop(*dedup.PLACE), AS_OF)
    narrow, merged, completed = extraction.stage_recent_in_place(dedup.placed(stored), batches, AS_OF)
    assert values(completed(narrow), *whole.columns) == values(whole, *whole.columns) and whole.count() > 20
    assert merged.get["rows"] == counted.get["rows"] > whole.count()
    assert not set(extraction.LONG) & set(narrow.columns)
    # The run itself: what it leaves in the shared folder holds no texts but those of the archetypes.
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    summary = run_extraction(spark, *(str(tmp_path / n) for n in ("silver", "bronze", "arch", "emb")), AS_OF, Settings(top_n=3))
    assert summary.first()["archetypes_extracted"] == 3
    left = [f.stat().st_size for d in set(shared.iterdir()) - before for f in d.rglob("*.parquet")]
    assert 0 < sum(left) < 60_000 < sum(Path(f.removeprefix("file://")).stat().st_size for f in whole.inputFiles())
