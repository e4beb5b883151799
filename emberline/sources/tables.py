"""Readers. The table format is a parameter: Parquet by default, any other that the session has a jar for."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberline.operators.dedup import PLACE, placed
from emberline.schemas import BRONZE, BRONZE_PARTITIONS, LANDING
from emberline.session import stage

FORMAT = "parquet"
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


class NoRows(RuntimeError):
    """A step that cannot go on without rows found none."""


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = FORMAT) -> DataFrame:
    """The table in its declared layout: partition columns come back with their types, not as text.

    Formats that keep their own schema refuse a second one; their columns are checked by the steps that use them.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if fmt in FILE_FORMATS else reader).load(path)


def read_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = FORMAT) -> DataFrame | None:
    """The table, or None if there is none. Other failures are raised."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_MISSING_DELTA_TABLE"):
            return None
        raise


def read_landing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Listing rows landed as JSON lines, and the lines that are none: not JSON, or without an id (as `value`)."""
    lines = spark.read.text(path)
    parsed = F.from_json("value", LANDING)
    # `inline` parses a line once: a filter on plain struct fields would be pushed down as a second parse.
    rows = lines.select(F.inline(F.array(parsed))).filter(F.col("id").isNotNull())
    return rows, lines.filter(F.trim("value") != "").filter(F.from_json("value", LANDING)["id"].isNull())


def _from_path(name: str, path: str = "_metadata.file_path") -> Column:
    """Value of a `name=value` folder of the row's file, unescaped; null for the null folder.

    The path is percent-encoded once by the partition writer and once as a URI. A plus sign is literal in
    both and would be decoded to a blank, so it is protected.
    """
    value = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)


def _batch_name(path: str = "_metadata.file_path") -> Column:
    return F.regexp_extract(path, f"([^/]+)/{BRONZE_PARTITIONS[0]}=", 1)


def file_audit(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Per Bronze file: file, batch, fetch_date, subreddit, promised, delivered, lost, checksum.

    `promised` are the rows that its footer states; it is null where no footer can be read, or the file holds no row.
    `delivered` are the rows that a tolerant read of all columns gives, up to the first damaged page, and `checksum`
    their hash. `lost` is the difference, null where nothing is known of the file. Footers and columns are read in one
    pass each. The result is a written table: counts of a lazy read would shrink with the columns asked of it.
    """
    path = F.col("_metadata.file_path").alias("path")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{root}/{pattern}" if pattern else root)
        .select(path)
    )
    rows = _batch_files(spark, root, pattern, tolerant=True)
    promised = rows.select(path).groupBy("path").agg(F.count("*").alias("promised"))
    hashed = rows.select(path, F.xxhash64(*rows.columns).alias("hash"))
    delivered = hashed.groupBy("path").agg(F.count("*").alias("delivered"), F.bit_xor("hash").alias("checksum"))
    found = listed.join(promised, "path", "left").join(delivered, "path", "left")
    return stage(
        found.select(
            F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
            _batch_name("path").alias("batch"),
            _from_path("fetch_date", "path").cast("date").alias("fetch_date"),
            _from_path("subreddit", "path").alias("subreddit"),
            "promised",
            F.coalesce("delivered", F.lit(0)).cast("long").alias("delivered"),
            (F.col("promised") - F.coalesce("delivered", F.lit(0))).alias("lost"),
            "checksum",
        ),
        "file-audit",
    )


def skipped_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Bronze files of which a tolerant read loses rows: those of `file_audit` that lack a footer or some rows."""
    return file_audit(spark, root, pattern).filter("promised IS NULL OR lost > 0")


def _batch_files(spark: SparkSession, root: str, pattern: str | None, tolerant: bool) -> DataFrame:
    stored = StructType([f for f in BRONZE.fields if f.name not in BRONZE_PARTITIONS])
    return (
        spark.read.schema(stored)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", str(tolerant).lower())
        # A page with flipped bits may still decode; its checksum says that it is damaged.
        .option("parquet.page.verify-checksum.enabled", "true")
        .parquet(f"{root}/{pattern}" if pattern else root)
    )


def read_batches(
    spark: SparkSession, root: str, pattern: str | None = None, tolerant: bool = False, places: bool = False
) -> DataFrame:
    """All Bronze batches under `root` in one scan, with the folder name as `batch`.

    `pattern` narrows the folders read, e.g. `2024-01-3*`. Folders that start with `_` are skipped. A file that
    cannot be read is an error, and so is a page whose checksum is wrong. `tolerant` leaves out what cannot be read: a
    whole file without a footer, and the rows of a file from its first damaged page on. `skipped_files` names such
    files and counts the rows. Partition values come from the path, with their declared types. `places` adds the place of
    each row, as `placed` does.
    """
    files = _batch_files(spark, root, pattern, tolerant)
    rows = (placed(files) if places else files).withColumns(
        {
            "batch": _batch_name(),
            "fetch_date": _from_path("fetch_date").cast("date"),
            "subreddit": _from_path("subreddit"),
        }
    )
    return rows.select(*BRONZE.names, "batch", *(PLACE if places else ()))


def list_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batch folders that hold rows, with their number. No column is read."""
    return read_batches(spark, root).groupBy("batch").agg(F.count("*").alias("posts")).orderBy("batch")


def stored_days(spark: SparkSession, path: str, schema: StructType, day: str = "processing_date") -> DataFrame:
    """Rows of each day of a Parquet table that is partitioned by day, from the footers of its files alone.

    The second generation of the Parquet source counts in the footers; a session of its own has it switched on, so the
    reads of `spark` stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema).parquet(path).groupBy(day).agg(F.count("*").alias("posts"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise NoRows(message)
    return df
