"""Scalar building blocks: sizes, timestamps, keys, paths, tokens and error classes, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OFFLOAD_THRESHOLD = 262_144
MAX_FILE_BYTES = 52_428_800
DEFAULT_PAGE_SIZE = 100
MAX_PAGE_SIZE = 1000
MAX_REVISION_PAGE = 200
DEFAULT_RETRY_AFTER = 60
CHANNEL_HOURS = 23
UNTITLED = "(Untitled)"
# End of fixed values.


def blank_to_null(value: Column) -> Column:
    """Python truthiness of strings: the empty string counts as missing."""
    return F.nullif(value, F.lit(""))


def parse_integer(value: Column) -> Column:
    """A variant read as integer: null where the key is absent, 0 where the value does not parse."""
    return F.when(value.isNotNull(), F.coalesce(F.try_variant_get(value, "$", "bigint"), F.lit(0).cast("bigint")))


def parse_integer_text(value: Column, present: Column | None = None) -> Column:
    present = value.isNotNull() if present is None else present
    return F.when(present, F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint")))


def utc_suffix(value: Column) -> Column:
    """``+00:00`` becomes ``Z``; every other text stays as it is."""
    return F.when(
        value.endswith("+00:00"), F.concat(F.left(value, F.length(value) - F.lit(6)), F.lit("Z"))
    ).otherwise(value)


def size_text(size_bytes: Column) -> Column:
    """``12.06 KB`` or, above 1024 KB, ``1.50 MB``; ties round half to even."""
    kilobytes = size_bytes / F.lit(1024.0)
    return F.when(
        kilobytes > 1024, F.format_string("%.2f MB", F.bround(kilobytes / F.lit(1024.0), 2))
    ).when(size_bytes.isNotNull(), F.format_string("%.2f KB", F.bround(kilobytes, 2)))


def status_flags(trashed: Column, starred: Column, shared: Column) -> Column:
    return F.concat_ws(
        ", ",
        F.when(trashed, F.lit("trashed")),
        F.when(starred, F.lit("starred")),
        F.when(shared, F.lit("shared")),
    )


def owner_names(owners: Column) -> Column:
    return F.array_join(F.transform(owners, lambda o: o["name"]), ", ")


def resource_type(is_folder: Column) -> Column:
    return F.when(is_folder, F.lit("folder")).otherwise(F.lit("file"))


def idempotency_key(provider: str, connection_id: Column, kind: Column, resource_id: Column) -> Column:
    """``provider:connection:type:id``; null as soon as one part is null."""
    return F.concat(F.lit(provider + ":"), connection_id, F.lit(":"), kind, F.lit(":"), resource_id)


def empty_batch_key(provider: str, connection_id: Column, kind: Column, batch_id: Column) -> Column:
    return F.concat(F.lit(provider + ":"), connection_id, F.lit(":"), kind, F.lit(":empty:"), batch_id)


def page_token(uri: Column) -> Column:
    """First non-empty ``pageToken`` value of the query part, URL-decoded; null where there is none."""
    query = F.regexp_extract(uri, r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_extract(query, r"(?:^|&)pageToken=([^&]+)", 1)
    return F.try_url_decode(blank_to_null(raw))


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def deterministic_id(*parts: Column) -> Column:
    """A stable id in place of a random one."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def _hex_dirs(value: Column) -> list[Column]:
    return [F.substring(value, 1, 2), F.substring(value, 3, 2)]


def blob_path(customer_id: Column, sha256: Column) -> Column:
    """``{c[0:2]}/{c[2:4]}/{customer}/{h[0:2]}/{h[2:4]}/{h}``"""
    return F.concat_ws("/", *_hex_dirs(customer_id), customer_id, *_hex_dirs(sha256), sha256)


def mock_blob_path(customer_id: Column, sha256: Column) -> Column:
    return F.concat_ws("/", F.lit("mock"), F.substring(customer_id, 1, 8), F.substring(sha256, 1, 16))


def payload_key(customer_id: Column, connection_id: Column, message_id: Column) -> Column:
    return F.concat(F.concat_ws("/", F.lit("payloads"), customer_id, connection_id, message_id), F.lit(".json"))


def exceeds_threshold(payload: Column, threshold: int = OFFLOAD_THRESHOLD) -> Column:
    return F.octet_length(payload) > F.lit(threshold)


def space_path(customer_id: Column, snowball_id: Column, stored: Column | None = None) -> Column:
    """``/{customer}/graph/snowball/{graph}`` unless the connection stores a path of its own."""
    built = F.concat(F.lit("/"), customer_id, F.lit("/graph/snowball/"), F.coalesce(snowball_id, F.lit("")))
    return built if stored is None else F.coalesce(blank_to_null(stored), built)


def clamp_page_size(requested: Column, default: int = DEFAULT_PAGE_SIZE, maximum: int = MAX_PAGE_SIZE) -> Column:
    return F.least(F.greatest(F.coalesce(requested, F.lit(default)), F.lit(1)), F.lit(maximum))


def retry_after_seconds(header: Column) -> Column:
    """Digits are seconds, everything else the default wait."""
    return F.coalesce(
        F.when(header.rlike(r"^\d+$"), header.try_cast("int")), F.lit(DEFAULT_RETRY_AFTER)
    )


def backoff_delay(attempt: Column, base: float = 1.0, multiplier: float = 2.0, maximum: float = 60.0) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(multiplier), attempt), F.lit(maximum))


def jittered_delay(delay: Column, *key: Column) -> Column:
    """Within 25 % of ``delay``, the position drawn from a hash of ``key`` instead of a random source."""
    unit = F.pmod(F.xxhash64(*key), F.lit(10_001)) / F.lit(10_000.0)
    return F.greatest(delay * (F.lit(0.75) + unit * F.lit(0.5)), F.lit(0.0))


def error_class(status: Column) -> Column:
    """Error class of an API response; null for success. A null status stands for a network error or timeout."""
    return (
        F.when(status.isNull(), F.lit("RetriableError"))
        .when(status == 429, F.lit("RateLimitError"))
        .when(status.isin(401, 403), F.lit("AuthenticationError"))
        .when(status.between(500, 599), F.lit("RetriableError"))
        .when(status.between(400, 499), F.lit("TerminalError"))
    )


def token_error_class(status: Column) -> Column:
    """Error class of the token endpoint; null for success."""
    return (
        F.when(status.isNull() | status.isin(429, 503) | (status >= 500), F.lit("RetriableError"))
        .when(status != 200, F.lit("AuthenticationError"))
    )


# Category of each error class.
ERROR_CATEGORIES = {
    "RetriableError": "transient",
    "TerminalError": "permanent",
    "RateLimitError": "rate_limit",
    "ValidationError": "validation",
    "AuthenticationError": "authentication",
    "AuthorizationError": "authorization",
    "ConfigurationError": "configuration",
    "ResourceNotFoundError": "not_found",
    "ChangeTokenExpiredError": "change_token_expired",
}
RETRIABLE_CLASSES = ["RetriableError", "RateLimitError"]
# End of fixed values.


def error_category(name: Column) -> Column:
    branch = None
    for error, value in ERROR_CATEGORIES.items():
        branch = (F if branch is None else branch).when(name == error, F.lit(value))
    return branch.when(name.isNotNull(), F.lit("unknown"))


def is_retriable(name: Column) -> Column:
    return name.isin(RETRIABLE_CLASSES)


def api_error_body(body: Column, most: int | None = None) -> Column:
    """The ``error`` object of a JSON body, else the whole JSON body, else the text (its first ``most`` characters, if
    that is given)."""
    text = body if most is None else F.left(body, F.lit(most))
    parsed = F.get_json_object(body, "$")
    return (
        F.when(F.coalesce(body, F.lit("")) == "", F.lit("Unknown error"))
        .when(parsed.isNotNull(), F.coalesce(F.get_json_object(body, "$.error"), body))
        .otherwise(text)
    )


def channel_expiry_ms(now: Column, hours: int = CHANNEL_HOURS) -> Column:
    return F.unix_millis(now + F.expr(f"INTERVAL {hours} HOURS"))


def duration_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two instants, truncated."""
    return ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000)).cast("bigint")


def present_or(present: Column, value: Column, default) -> Column:
    """A default only where the key is absent; an explicit null stays null."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.when(present, value).otherwise(default)
