import re

import pytest
from pyspark.sql import functions as F

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text, fold=False):
    return BLANK.findall((text or "").translate(FOLD if fold else {}))


def plain_words(text):
    return PLAIN.findall((text or "").translate(FOLD))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clash(spark):
    """Two unrelated texts whose 32-bit hashes are equal."""
    rows = spark.range(400_000).selectExpr("concat_ws(' ', 'a' || id, 'b' || id, 'c' || id, 'd' || id, 'e' || id) AS text")
    pair = rows.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a != b").first()
    return pair["a"], pair["b"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
