import pytest
from pyspark.sql import functions as F

from docquarry.functions import error_category, error_severity, exit_code, format_bytes, mask_credentials, valid_uri
from docquarry.operators import classify_messages, docs_per_second, error_stats, export_stats


@pytest.mark.parametrize(
    "message, category, severity, retryable, delay, code",
    [
        ("Connection refused", "Network", "Error", True, 5, 4),
        ("operation TIMEOUT", "Network", "Error", True, 5, 1),
        ("auth failed", "Authentication", "Critical", False, None, 1),
        ("permission denied on output", "Database", "Critical", False, None, 6),
        ("disk full", "File System", "Error", True, 10, 1),
        ("bad json query", "Serialization", "Warning", True, 1, 5),
        ("oom", "Resource", "Error", True, 30, 1),
        ("value is required", "Unknown", "Error", True, 5, 2),
        ("invalid uri", "Unknown", "Error", True, 5, 4),
        ("connection auth timeout", "Network", "Error", True, 5, 4),
    ],
)
def test_first_matching_rule_decides(spark, message, category, severity, retryable, delay, code):
    df = spark.createDataFrame([(message,)], "message string")
    row = classify_messages(df, "message").withColumn("code", exit_code(F.col("message"))).first()
    assert tuple(row)[1:] == (category, severity, retryable, delay, code)


def test_null_message_stays_null(spark):
    df = spark.createDataFrame([(None,)], "m string")
    assert tuple(df.select(error_category(F.col("m")), error_severity(F.col("m"))).first()) == (None, None)


def test_error_stats(spark):
    df = spark.createDataFrame([("timeout",), ("auth",), ("unauthorized",), ("?",)], "m string")
    assert {tuple(r) for r in error_stats(df, "m").collect()} == {
        ("category", "Network", 1),
        ("category", "Authentication", 2),
        ("category", "Unknown", 1),
        ("severity", "Error", 2),
        ("severity", "Critical", 2),
    }


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0 B"),
        (1023, "1023 B"),
        (1024, "1.00 KB"),
        (1152, "1.12 KB"),
        (1536, "1.50 KB"),
        (1048575, "1024.00 KB"),
        (1 << 20, "1.00 MB"),
        (5 << 30, "5.00 GB"),
        (3 << 50, "3072.00 TB"),
        (None, None),
    ],
)
def test_format_bytes(spark, size, text):
    assert spark.createDataFrame([(size,)], "n long").select(format_bytes(F.col("n"))).first()[0] == text


def test_uris(spark):
    df = spark.createDataFrame([("mongodb+srv://u:p@h/x",), ("mongodb://h",), ("http://u:p@h and ftp://a:b@c",)], "u string")
    rows = df.select(valid_uri(F.col("u")), mask_credentials(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [
        (True, "mongodb+srv://***@h/x"),
        (True, "mongodb://h"),
        (False, "http://***@h and ftp://***@c"),
    ]


def test_export_stats(spark):
    df = spark.createDataFrame([("é",), ("ab",), (None,)], "text string")
    assert tuple(export_stats(df, "text").first()) == (3, 4, 4 / 3)
    assert tuple(export_stats(df.limit(0), "text").first()) == (0, 0, 0.0)
    row = spark.range(1).select(docs_per_second(F.lit(500), F.lit(250)), docs_per_second(F.lit(5), F.lit(0))).first()
    assert tuple(row) == (2000.0, None)
