import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberline import schemas, session
from emberline.operators import normalise
from emberline.plans import views
from emberline.plans.prediction import latest_predictions, update_latest
from emberline.sinks import tables as sinks
from emberline.sources import tables as sources
from tests.conftest import AS_OF, common, listing, values


def bronze(spark, *rows, at=AS_OF):
    return normalise.add_bronze_derived(listing(spark, *rows), at)


def test_batches_round_trip(spark, tmp_path):
    root = str(tmp_path)
    names = ["2024", "a+b c/d%", None]
    first = bronze(spark, *[dict(id=str(i), subreddit=s) for i, s in enumerate(names)])
    second = bronze(spark, dict(id="9", subreddit="x"))
    assert sinks.write_bronze(first, root, AS_OF) == f"{root}/2024-01-31_00-00"
    sinks.write_bronze(second, root, AS_OF + dt.timedelta(hours=6))
    (tmp_path / "_junk").mkdir()
    (tmp_path / "_junk" / "x.parquet").write_text("not parquet")
    back = sources.read_batches(spark, root)
    assert back.columns == [*schemas.BRONZE.names, "batch"]
    assert schemas.mismatches(back.schema, schemas.BRONZE) == []
    assert values(back, "id", "subreddit", "batch") == sorted(
        [("0", "2024", "2024-01-31_00-00"), ("1", "a+b c/d%", "2024-01-31_00-00"), ("2", None, "2024-01-31_00-00"),
         ("9", "x", "2024-01-31_06-00")], key=str)
    wanted = first.unionByName(second)
    assert values(back, *schemas.BRONZE.names) == values(wanted, *schemas.BRONZE.names)
    assert values(sources.list_batches(spark, root), "batch", "posts") == [("2024-01-31_00-00", 3), ("2024-01-31_06-00", 1)]
    assert values(sources.read_batches(spark, root, "2024-01-31_06*"), "id") == ["9"]


def test_batch_overwrite_replaces_the_batch(spark, tmp_path):
    for ids in ("ab", "c"):
        sinks.write_bronze(bronze(spark, *[dict(id=i) for i in ids]), str(tmp_path), AS_OF)
    assert values(sources.read_batches(spark, str(tmp_path)), "id") == ["c"]


def test_unreadable_file_is_an_error_or_named(spark, tmp_path):
    sinks.write_bronze(bronze(spark, {}), str(tmp_path), AS_OF)
    broken = tmp_path / "2024-02-01_00-00" / "fetch_date=2024-02-01" / "subreddit=s"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception, match="CANNOT_READ|Parquet|parquet"):
        sources.read_batches(spark, str(tmp_path)).collect()
    assert values(sources.read_batches(spark, str(tmp_path), tolerant=True), "id") == ["a"]
    assert values(sources.skipped_files(spark, str(tmp_path)), "file", "batch") == [("part-0.parquet", "2024-02-01_00-00")]


def flip(file, at, n):
    """Other bytes in a file; its checksum file goes, as object stores have none."""
    data = bytearray(file.read_bytes())
    data[at : at + n] = bytes(b ^ 0x5A for b in data[at : at + n])
    file.write_bytes(data)
    (file.parent / f".{file.name}.crc").unlink()


def test_rows_behind_a_damaged_page_are_counted(spark, tmp_path):
    """The footer promises all rows, a tolerant read delivers those before the damage."""
    root = str(tmp_path)
    body = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(3)])
    rows = bronze(spark, {}).drop("id", "selftext").crossJoin(spark.range(20_000).withColumn("selftext", body).withColumn("id", F.col("id").cast("string")))
    sinks.write_bronze(rows.select(*schemas.BRONZE.names).coalesce(1), root, AS_OF)
    sinks.write_bronze(bronze(spark, dict(id="x"), dict(id="y")), root, AS_OF + dt.timedelta(hours=6))
    (file,) = (tmp_path / "2024-01-31_00-00").rglob("*.parquet")
    flip(file, file.stat().st_size // 2, 4000)
    with pytest.raises(Exception, match="CANNOT_READ|Parquet|parquet"):
        sources.read_batches(spark, root).agg(F.max("selftext")).collect()
    delivered = sources.read_batches(spark, root, tolerant=True).filter("selftext is not null and batch = '2024-01-31_00-00'").select("id", "selftext").collect()
    found = sources.skipped_files(spark, root).collect()
    assert [(r["file"], r["batch"], r["promised"], r["subreddit"]) for r in found] == [(file.name, "2024-01-31_00-00", 20_000, "s")]
    assert found[0]["delivered"] == len(delivered) < 20_000 and found[0]["lost"] == 20_000 - len(delivered)
    sound = sources.file_audit(spark, root, "2024-01-31_06*").collect()
    assert [(r["promised"], r["delivered"], r["lost"]) for r in sound] == [(2, 2, 0)] and sound[0]["checksum"] is not None


def test_one_flipped_bit_is_damage(spark, tmp_path):
    """Without compression a wrong byte decodes to a wrong text; the page's checksum finds it."""
    spark.conf.set("spark.sql.parquet.compression.codec", "uncompressed")
    try:
        sinks.write_bronze(bronze(spark, dict(id="a", title="an unmistakable title")), str(tmp_path), AS_OF)
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    (file,) = tmp_path.rglob("*.parquet")
    at = file.read_bytes().index(b"an unmistakable title")
    flip(file, at + 3, 1)
    with pytest.raises(Exception, match="(?i)checksum|CANNOT_READ"):
        sources.read_batches(spark, str(tmp_path)).select("title").collect()
    assert [r["lost"] for r in sources.skipped_files(spark, str(tmp_path)).collect()] == [1]


def test_missing_root_and_optional_table(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sources.read_batches(spark, str(tmp_path / "none"))
    numbers = spark.range(2)
    assert sources.read_optional(spark, str(tmp_path / "none"), numbers.schema) is None
    numbers.write.parquet(str(tmp_path / "some"))
    assert sources.read_optional(spark, str(tmp_path / "some"), numbers.schema).count() == 2


def test_hot_folder_is_split_and_small_ones_are_not(spark, tmp_path):
    """A subreddit with most rows must not end in one task; the others get one file each."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(40000).selectExpr(
            "id", "if(id % 10 < 6, 'hot', concat('s', id % 10)) as subreddit", "date'2024-01-31' as fetch_date",
            "sha2(cast(id as string), 512) as text")
        sinks.write_partitioned(rows, str(tmp_path / "t"), schemas.BRONZE_PARTITIONS, "overwrite")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {}
    for file in (tmp_path / "t").rglob("*.parquet"):
        files[file.parent.name] = files.get(file.parent.name, 0) + 1
    assert files["subreddit=hot"] > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40000


def test_rows_of_a_written_table_stay_in_their_tasks_if_files_come_out_fair(spark, tmp_path, monkeypatch):
    """Two tasks read 40 rows of one folder and 4 of each of two others: all, the first one's or none stay."""
    rows = spark.range(0, 48, 1, 2).selectExpr("id", "case id % 12 when 0 then 'b' when 1 then null else 'a' end as folder")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "rows"))
    assert stored.rdd.getNumPartitions() == 2
    for fair, files in ((2, 6), (3, 4), (100, 3)):
        monkeypatch.setattr(sinks, "FAIR_FILE", fair)
        place = str(tmp_path / f"t{fair}")
        seen = sinks.write_partitioned(stored, place, ["folder"], "overwrite", metrics=[F.count(F.lit(1)).alias("n")], as_read=True)
        assert seen["n"] == 48 and len(list((tmp_path / f"t{fair}").glob("*/*.parquet"))) == files
        assert values(spark.read.schema(rows.schema).parquet(place), "id", "folder") == values(rows, "id", "folder")


def test_large_folders_are_written_where_their_rows_are(spark, tmp_path):
    """No row of a large folder crosses an exchange; the others are rebalanced, null folders included."""
    rows = spark.range(4000).selectExpr(
        "id", "case when id % 10 < 6 then 'hot' when id % 10 < 9 then concat('s', id % 10) end as subreddit",
        "date'2024-01-31' as fetch_date", "sha2(cast(id as string), 512) as text")
    spread = sinks._spread(rows, schemas.BRONZE_PARTITIONS, 1000)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1 and "Union" in plan
    every = sinks._spread(rows.filter("subreddit = 'hot'"), schemas.BRONZE_PARTITIONS, 1000)
    assert values(every, "id") == values(rows.filter("subreddit = 'hot'"), "id")
    for large in (1, 1000, 5000):
        place = str(tmp_path / f"t{large}")
        seen = sinks.write_partitioned(
            rows, place, schemas.BRONZE_PARTITIONS, "overwrite", metrics=[F.count(F.lit(1)).alias("n")], large=large)
        assert seen == {"n": 4000}
        assert values(spark.read.schema(rows.schema).parquet(place), *rows.columns) == values(rows, *rows.columns)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert all(".zstd." in f.name for f in tmp_path.rglob("part-*.parquet"))


def test_landing_files(spark, tmp_path):
    rows = listing(spark, dict(id="a"), dict(id="b", author=None)).withColumn("listing", F.lit("s"))
    rows.write.json(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.json").write_text('{"id": "c\n\nnot json\n{"title": "no id"}\n')
    back, bad = sources.read_landing(spark, str(tmp_path / "in"))
    assert schemas.mismatches(back.schema, schemas.LANDING) == []
    assert values(back, "id", "author", "listing") == [("a", "someone", "s"), ("b", None, "s")]
    assert values(bad, "value") == ["not json", '{"id": "c', '{"title": "no id"}']


def predictions(spark, *ids, at=AS_OF):
    df = common(spark, *[dict(id=i) for i in ids]).withColumns(
        {
            "viral_similarity_score": F.lit(0.5),
            "viral_potential_label": F.when(F.col("id") == "a", "HIGH").otherwise("LOW"),
            "is_viral": F.col("id") == "a",
            "is_already_viral": F.lit(False),
            "prediction_timestamp": F.lit(at),
            "prediction_date": F.to_date(F.lit(at)),
        }
    )
    return df.select(*schemas.PREDICTION.names)


def test_appended_predictions_repeat_and_latest_is_one_per_id(spark, tmp_path):
    path = str(tmp_path / "p")
    for at in (AS_OF, AS_OF + dt.timedelta(hours=1)):
        sinks.write_predictions(predictions(spark, "a", "b", at=at), path, at)
    assert (Path(path) / "prediction_date=2024-01-31" / "run_id=20240131_010000" / "viral_potential_label=HIGH").is_dir()
    back = sources.read_table(spark, path, schemas.STORED_PREDICTION)
    assert back.count() == 4 and schemas.mismatches(back.schema, schemas.PREDICTION) == []
    latest = values(latest_predictions(back), "id", "prediction_timestamp")
    assert latest == [(i, AS_OF + dt.timedelta(hours=1)) for i in "ab"]


def test_run_with_an_id_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "p")
    read = lambda: values(sources.read_table(spark, path, schemas.STORED_PREDICTION), "id", "run_id")
    sinks.write_predictions(predictions(spark, "a", "b"), path, AS_OF, "r1")
    sinks.write_predictions(predictions(spark, "c"), path, AS_OF, "r2")
    sinks.write_predictions(predictions(spark, "b", "d"), path, AS_OF, "r1")
    assert read() == [("b", "r1"), ("c", "r2"), ("d", "r1")]  # the label of `a` is gone with it
    sinks.write_predictions(predictions(spark, "a").limit(0), path, AS_OF, "r1")
    sinks.write_predictions(predictions(spark, "a"), path, str(AS_OF))
    assert read() == [("a", "20240131_000000"), ("c", "r2")]
    with pytest.raises(ValueError, match="run id"):
        sinks.write_predictions(predictions(spark, "a"), path, AS_OF, "a/b")


def test_views_and_example_sql(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_predictions(predictions(spark, "a", "b", "c"), path, AS_OF)
    sinks.register_views(spark, path, "some_predictions", database="emberline_test")
    for view in ("some_predictions", "emberline_test.some_predictions"):
        counts = spark.sql(views.LABEL_COUNTS.format(view=view))
        assert values(counts, "viral_potential_label", "count") == [("HIGH", 1), ("LOW", 2)]
    assert values(spark.sql(views.HIGH_POSTS.format(view="some_predictions")), "id") == ["a"]
    today = views.SUMMARY_OF_DAY.format(view="some_predictions", day="2024-01-31")
    assert spark.sql(today).count() == 2
    assert spark.sql(views.SUMMARY_OF_DAY.format(view="some_predictions", day="2024-02-01")).count() == 0
    top = spark.sql(views.TOP_SIMILARITY.format(view="some_predictions"))
    assert [r["id"] for r in top.collect()] == ["a", "b", "c"]


def test_later_runs_are_published_without_a_listing(spark, tmp_path, monkeypatch):
    path, database = str(tmp_path / "p"), "emberline_published"
    sinks.write_predictions(predictions(spark, "a", "b"), path, AS_OF, "r1")
    sinks.register_views(spark, path, "published", database=database)
    later = AS_OF + dt.timedelta(hours=30)
    sinks.write_predictions(predictions(spark, "c", at=later), path, later, "r2")
    table = lambda: values(spark.table(f"{database}.published"), "id", "run_id", "viral_potential_label")
    asked = []
    plain = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: asked.append(text) or plain(text, *a, **b))
    for _ in range(2):  # a repeated run finds its partitions there
        sinks.publish_run(spark, path, later, "r2", database, "published")
        assert table() == [("a", "r1", "HIGH"), ("b", "r1", "LOW"), ("c", "r2", "LOW")]
    sinks.register_views(spark, path, "published", database=database)
    assert not any("MSCK" in text for text in asked)


def test_snapshot_reads_one_run_and_the_snapshot_before(spark, tmp_path):
    path, root, before = str(tmp_path / "p"), str(tmp_path / "latest"), None
    runs = [("r1", AS_OF, "abc"), ("r2", AS_OF + dt.timedelta(hours=1), "bd"), ("r3", AS_OF + dt.timedelta(hours=30), "ae")]
    for run, at, ids in runs:
        sinks.write_predictions(predictions(spark, *ids, at=at), path, at, run)
        for _ in range(2):
            place = update_latest(spark, path, root, at, run, before)
        before = run
    stored = sources.read_table(spark, place, schemas.STORED_PREDICTION)
    assert values(stored, "id", "run_id") == [("a", "r3"), ("b", "r2"), ("c", "r1"), ("d", "r2"), ("e", "r3")]
    every = latest_predictions(sources.read_table(spark, path, schemas.STORED_PREDICTION))
    assert values(stored, *schemas.STORED_PREDICTION.names) == values(every, *schemas.STORED_PREDICTION.names)
    at = runs[1][1]
    assert len(sinks.read_run(spark, path, at, "r2").inputFiles()) == 1
    assert schemas.mismatches(sinks.read_run(spark, path, at, "r2").schema, schemas.STORED_PREDICTION) == []


def test_days_are_counted_in_the_footers(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.range(100).selectExpr("cast(id as string) as id", "date_add(date'2024-01-01', cast(id % 3 as int)) as processing_date")
    rows.repartition(4).write.partitionBy("processing_date").parquet(path)
    found = sources.stored_days(spark, path, rows.schema)
    assert [n for _, n in values(found, "processing_date", "posts")] == [34, 33, 33]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [processing_date]" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_summary_is_json_and_hidden_from_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    sinks.write_summary(spark.range(1).selectExpr("struct(1 as a) as s", "map('x', 2) as m"), f"{path}/_summary")
    assert spark.read.parquet(path).count() == 3
    (file,) = (Path(path) / "_summary").glob("part-*.json")
    assert json.loads(file.read_text()) == {"s": {"a": 1}, "m": {"x": 2}}


def test_stage_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = session.stage(spark.range(5).withColumn("x", F.lit("y")), "five")
    assert staged.count() == 5
    assert staged.inputFiles()[0].replace("file://", "").startswith(folder)


def test_gold_overwrite(spark, tmp_path):
    path = str(tmp_path / "g")
    for n in (3, 2):
        sinks.write_gold(spark.range(n), path)
    assert sources.read_table(spark, path, spark.range(1).schema).count() == 2


def test_days_are_written_without_a_sort(tmp_path):
    """In a session whose sorts spill beyond 50 rows nothing is spilled, and every row is in the folder of its day."""
    code = f"""
from emberline.session import build_session
from emberline.sinks.tables import write_days
spark = build_session("days", **{{
    "spark.master": "local[1]", "spark.shuffle.spill.numElementsForceSpillThreshold": "50",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "{tmp_path}", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.driver.host": "127.0.0.1",
}})
day = "if(id % 7 = 0, null, date_add(date'2024-01-01', cast(id % 7 as int))) as processing_date"
write_days(spark.range(0, 3000, 1, 1).selectExpr("concat('p', id) as id", "repeat('text ', 50) as selftext", day), "{tmp_path}/days")
print("ROWS", sorted((str(r[0]), r[1]) for r in spark.read.parquet("{tmp_path}/days").groupBy("processing_date").count().collect()))
print("SETTING", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=True)
    days = sorted([("None", 429), *((f"2024-01-0{d + 1}", 429 if d < 4 else 428) for d in range(1, 7))])
    assert f"ROWS {days}" in done.stdout and "SETTING 0" in done.stdout
    (log,) = [f for f in tmp_path.iterdir() if f.is_file() and not f.name.startswith(".")]
    ended = [json.loads(line) for line in log.read_text().splitlines() if '"SparkListenerTaskEnd"' in line]
    assert ended and sum(e["Task Metrics"]["Disk Bytes Spilled"] for e in ended) == 0
    assert len([f for f in (tmp_path / "days").rglob("part-*.zstd.parquet")]) == 7
