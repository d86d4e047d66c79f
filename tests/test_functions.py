from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from stratafile.functions import mime as M
from stratafile.functions import scalars as S

NATIVE = "application/vnd.google-apps."


def value(spark, column, **inputs):
    kinds = {str: "string", int: "bigint", float: "double", bytes: "binary", bool: "boolean"}
    fields = ", ".join(f"{k} {kinds[type(v)] if v is not None else 'string'}" for k, v in inputs.items()) or "x int"
    row = tuple(inputs.values()) or (1,)
    return spark.createDataFrame([row], fields).select(column.alias("v")).first()["v"]


def test_tables_have_their_published_sizes():
    types = list(M.CATEGORIES)
    assert len(types) == len(set(types)) == 54
    assert len(M.EXTENSIONS) == 46
    assert len(M.EXPORT_FORMATS) == 5
    assert len(M.NATIVE_TYPES) == 9 and len(M.NATIVE_NAMES) == 9


@pytest.mark.parametrize(
    "mime,category",
    [
        ("image/unknown", "image"),
        ("video/unknown", "video"),
        ("audio/unknown", "audio"),
        ("text/unknown", "document"),
        (NATIVE + "unknown", "google-workspace"),
        ("unknown/type", "other"),
        ("text/x-c++", "code"),
        ("text/csv", "spreadsheet"),
        (NATIVE + "script", "code"),
        (NATIVE + "jam", "whiteboard"),
        (None, None),
    ],
)
def test_category(spark, mime, category):
    assert value(spark, M.category(F.col("m")), m=mime) == category


def test_every_exact_type_has_the_same_category_in_map_and_join(spark):
    rows = M.mime_dimension(spark).withColumnRenamed("category", "expected")
    joined = M.classify_by_dimension(rows).withColumn("by_expr", M.category(F.col("mime_type")))
    assert joined.where("category <> expected OR by_expr <> expected").count() == 0
    assert joined.where(~M.extension(F.col("mime_type")).eqNullSafe(F.col("file_extension"))).count() == 0


def test_export_formats(spark):
    got = {k: value(spark, M.export_format(F.col("m")), m=NATIVE + k) for k in ["document", "spreadsheet", "folder", "form"]}
    assert got == {"document": "text/plain", "spreadsheet": "text/csv", "folder": None, "form": None}
    assert value(spark, M.extension(F.col("m")), m="audio/webm") is None


@pytest.mark.parametrize(
    "uri,token",
    [
        ("https://x/changes?pageToken=abc%2F123%3Dxyz", "abc/123=xyz"),
        ("https://x/changes?a=1&pageToken=t&pageToken=u", "t"),
        ("https://x/changes?pageToken=&pageToken=u", "u"),
        ("https://x/changes?pageToken=a b#frag", "a b"),
        ("https://x/changes?pageToken=", None),
        ("https://x/changes?oldpageToken=1", None),
        ("not a uri", None),
        ("", None),
        (None, None),
        ("https://x/?pageToken=%zz", None),
    ],
)
def test_page_token(spark, uri, token):
    assert value(spark, S.page_token(F.col("u")), u=uri) == token


@pytest.mark.parametrize("size", [0, 1, 128, 1023, 1024, 1536, 1048576, 1048577, 5 * 2**20, 52428800, 12345678])
def test_size_text(spark, size):
    kb = Decimal(size) / 1024
    unit, amount = ("MB", kb / 1024) if kb > 1024 else ("KB", kb)
    expected = f"{amount.quantize(Decimal('0.01'), ROUND_HALF_EVEN)} {unit}"
    assert value(spark, S.size_text(F.col("s")), s=size) == expected


def test_timestamps(spark):
    out = [value(spark, S.utc_suffix(F.col("t")), t=t) for t in ["2025-01-01T00:00:00Z", "2025-01-01T00:00:00+00:00", "2025-01-01T00:00:00", "2025-01-01T00:00:00+02:00", "", None]]
    assert out == ["2025-01-01T00:00:00Z", "2025-01-01T00:00:00Z", "2025-01-01T00:00:00", "2025-01-01T00:00:00+02:00", "", None]


@pytest.mark.parametrize("n,expected", [(None, 100), (0, 1), (-5, 1), (250, 250), (1000, 1000), (5000, 1000)])
def test_page_size(spark, n, expected):
    column = S.clamp_page_size(F.lit(n).cast("int"))
    assert value(spark, column) == expected


def test_backoff_and_jitter(spark):
    delays = [value(spark, S.backoff_delay(F.lit(a))) for a in range(8)]
    assert delays == [1, 2, 4, 8, 16, 32, 60, 60]
    rate_limit = [value(spark, S.backoff_delay(F.lit(a), base=2.0, maximum=120.0)) for a in range(7)]
    assert rate_limit == [2, 4, 8, 16, 32, 64, 120]
    rows = spark.range(500).select(S.jittered_delay(F.lit(8.0), F.col("id")).alias("d")).collect()
    assert all(6.0 <= r.d <= 10.0 for r in rows) and len({r.d for r in rows}) > 100


@pytest.mark.parametrize(
    "status,name",
    [(200, None), (204, None), (429, "RateLimitError"), (401, "AuthenticationError"), (403, "AuthenticationError"),
     (404, "TerminalError"), (400, "TerminalError"), (500, "RetriableError"), (503, "RetriableError")],
)
def test_error_class(spark, status, name):
    assert value(spark, S.error_class(F.col("s")), s=status) == name


def test_token_endpoint_classes(spark):
    got = {s: value(spark, S.token_error_class(F.col("s")), s=s) for s in [200, 400, 401, 429, 503, 500, 418]}
    assert got == {200: None, 400: "AuthenticationError", 401: "AuthenticationError", 429: "RetriableError",
                   503: "RetriableError", 500: "RetriableError", 418: "AuthenticationError"}


def test_retry_after_and_error_body(spark):
    assert [value(spark, S.retry_after_seconds(F.col("h")), h=h) for h in ["30", "soon", "", None, "1.5"]] == [30, 60, 60, 60, 60]
    assert value(spark, S.api_error_body(F.col("b")), b='{"error":{"message":"m"}}') == '{"message":"m"}'
    assert value(spark, S.api_error_body(F.col("b")), b='{"x":1}') == '{"x":1}'
    assert value(spark, S.api_error_body(F.col("b")), b="y" * 800) == "y" * 800
    assert value(spark, S.api_error_body(F.col("b"), 500), b="y" * 800) == "y" * 500
    assert value(spark, S.api_error_body(F.col("b")), b="") == "Unknown error"


def test_keys_and_paths(spark):
    assert value(spark, S.idempotency_key("drive", F.col("c"), F.lit("file"), F.col("i")), c="conn", i="1A") == "drive:conn:file:1A"
    assert value(spark, S.idempotency_key("drive", F.col("c"), F.lit("file"), F.col("i")), c=None, i="1A") is None
    customer = "550e8400-e29b-41d4-a716-446655440000"
    digest = value(spark, S.sha256_hex(F.col("b")), b=b"Hello")
    assert digest == "185f8db32271fe25f561a6fc938b2e264306ec304eda518007d1764826381969"
    assert value(spark, S.blob_path(F.col("c"), F.col("h")), c=customer, h=digest) == f"55/0e/{customer}/18/5f/{digest}"
    assert value(spark, S.mock_blob_path(F.col("c"), F.col("h")), c=customer, h=digest) == f"mock/{customer[:8]}/{digest[:16]}"
    assert value(spark, S.space_path(F.col("c"), F.col("g")), c="cu", g="gr") == "/cu/graph/snowball/gr"
    assert value(spark, S.space_path(F.col("c"), F.col("g"), F.col("p")), c="cu", g="gr", p="/own") == "/own"


def test_offload_threshold_is_strict(spark):
    for size, expected in [(262143, False), (262144, False), (262145, True)]:
        assert value(spark, S.exceeds_threshold(F.col("b")), b=b"x" * size) is expected


def test_channel_expiry(spark):
    assert value(spark, S.channel_expiry_ms(F.to_timestamp(F.lit("2024-02-01T00:00:00Z")))) == 1706745600000 + 23 * 3600 * 1000
