"""Queue messages as a stream."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.schemas import EVENT

# Bounds a micro-batch, and with it what is staged and parsed at once.
FILES_PER_TRIGGER = "1000"
# Names that Spark reads in a folder: not hidden, and no upload that is still under way (`._COPYING_`).
FINISHED = "{[!._],[!._]*[!_]}"


def read_post_stream(spark: SparkSession, path: str = "", fmt: str = "text", **options: str) -> DataFrame:
    """Messages as `value` (JSON text) and `timestamp` (arrival).

    `text` follows a landing folder, one message per line; `kafka` follows a topic given by `options`. Files of one
    moment are taken in the order of their names.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string"), "timestamp")
    if "maxFilesPerTrigger" not in options:
        reader = reader.option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    # A pattern is expanded in order, a folder is listed in any.
    listed = path
    if not set(path) & set("*?[{"):
        spark.read.text(path)  # a folder that is not there is an error, a pattern without files is none
        listed = f"{path.rstrip('/')}/{FINISHED}"
    return reader.load(listed).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def post_id(message: str = "value") -> Column:
    """Id of the post in a message; null if the message is no JSON or has none. Only the id is parsed."""
    return F.from_json(message, EVENT)["id"]
