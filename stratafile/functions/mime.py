"""MIME classification as Column expressions; every lookup stays inside code generation."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The MIME tables below must equal the data model's for right results.
NATIVE_PREFIX = "application/vnd.google-apps."
DOCUMENT = "application/vnd.google-apps.document"
SPREADSHEET = "application/vnd.google-apps.spreadsheet"
PRESENTATION = "application/vnd.google-apps.presentation"
FOLDER = "application/vnd.google-apps.folder"
FORM = "application/vnd.google-apps.form"
DRAWING = "application/vnd.google-apps.drawing"
SITE = "application/vnd.google-apps.site"
SCRIPT = "application/vnd.google-apps.script"
WHITEBOARD = "application/vnd.google-apps.jam"
DEFAULT_MIME = "application/octet-stream"

NATIVE_TYPES = [DOCUMENT, SPREADSHEET, PRESENTATION, FOLDER, FORM, DRAWING, SITE, SCRIPT, WHITEBOARD]

NOT_EXPORTABLE_TYPES = [FORM, SITE, WHITEBOARD]

EXPORT_FORMATS = {
    DOCUMENT: "text/plain",
    SPREADSHEET: "text/csv",
    PRESENTATION: "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    DRAWING: "image/png",
    SCRIPT: "application/vnd.google-apps.script+json",
}

CATEGORIES = {
    DOCUMENT: "document",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "document",
    "application/msword": "document",
    "application/pdf": "document",
    "text/plain": "document",
    "text/html": "document",
    "application/rtf": "document",
    SPREADSHEET: "spreadsheet",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "spreadsheet",
    "application/vnd.ms-excel": "spreadsheet",
    "text/csv": "spreadsheet",
    PRESENTATION: "presentation",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "presentation",
    "application/vnd.ms-powerpoint": "presentation",
    FOLDER: "folder",
    FORM: "form",
    DRAWING: "drawing",
    SITE: "site",
    WHITEBOARD: "whiteboard",
    "image/jpeg": "image",
    "image/png": "image",
    "image/gif": "image",
    "image/svg+xml": "image",
    "image/webp": "image",
    "image/bmp": "image",
    "image/tiff": "image",
    "video/mp4": "video",
    "video/mpeg": "video",
    "video/quicktime": "video",
    "video/x-msvideo": "video",
    "video/webm": "video",
    "audio/mpeg": "audio",
    "audio/mp3": "audio",
    "audio/wav": "audio",
    "audio/ogg": "audio",
    "audio/webm": "audio",
    "application/zip": "archive",
    "application/x-rar-compressed": "archive",
    "application/x-tar": "archive",
    "application/gzip": "archive",
    "application/x-7z-compressed": "archive",
    SCRIPT: "code",
    "text/javascript": "code",
    "application/javascript": "code",
    "application/json": "code",
    "text/x-python": "code",
    "application/x-python-code": "code",
    "text/x-java-source": "code",
    "text/x-c": "code",
    "text/x-c++": "code",
    "text/markdown": "code",
    "text/x-yaml": "code",
    "application/xml": "code",
    "text/xml": "code",
}

CATEGORY_PREFIXES = [
    ("image/", "image"),
    ("video/", "video"),
    ("audio/", "audio"),
    ("text/", "document"),
    (NATIVE_PREFIX, "google-workspace"),
]

EXTENSIONS = {
    DOCUMENT: ".txt",
    SPREADSHEET: ".csv",
    PRESENTATION: ".pptx",
    DRAWING: ".png",
    SCRIPT: ".json",
    "application/pdf": ".pdf",
    "text/plain": ".txt",
    "text/html": ".html",
    "text/csv": ".csv",
    "application/rtf": ".rtf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/msword": ".doc",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.ms-powerpoint": ".ppt",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "image/gif": ".gif",
    "image/svg+xml": ".svg",
    "image/webp": ".webp",
    "image/bmp": ".bmp",
    "image/tiff": ".tiff",
    "video/mp4": ".mp4",
    "video/mpeg": ".mpeg",
    "video/quicktime": ".mov",
    "video/x-msvideo": ".avi",
    "video/webm": ".webm",
    "audio/mpeg": ".mp3",
    "audio/mp3": ".mp3",
    "audio/wav": ".wav",
    "audio/ogg": ".ogg",
    "application/zip": ".zip",
    "application/x-rar-compressed": ".rar",
    "application/x-tar": ".tar",
    "application/gzip": ".gz",
    "application/x-7z-compressed": ".7z",
    "text/javascript": ".js",
    "application/javascript": ".js",
    "application/json": ".json",
    "text/x-python": ".py",
    "text/x-java-source": ".java",
    "text/markdown": ".md",
    "text/x-yaml": ".yaml",
    "application/xml": ".xml",
    "text/xml": ".xml",
}

NATIVE_NAMES = {
    DOCUMENT: "Google Docs",
    SPREADSHEET: "Google Sheets",
    PRESENTATION: "Google Slides",
    FORM: "Google Forms",
    DRAWING: "Google Drawings",
    SITE: "Google Sites",
    SCRIPT: "Google Apps Script",
    "application/vnd.google-apps.map": "Google My Maps",
    WHITEBOARD: "Google Jamboard",
}
DEFAULT_NATIVE_NAME = "Google Workspace file"
# End of fixed values.


def _lookup(table: dict[str, str], mime: Column) -> Column:
    literal_map = F.create_map(*[F.lit(item) for item in chain.from_iterable(table.items())])
    return F.try_element_at(literal_map, mime)


def is_native(mime: Column) -> Column:
    return mime.isin(NATIVE_TYPES)


def is_folder(mime: Column) -> Column:
    return mime == F.lit(FOLDER)


def export_format(mime: Column) -> Column:
    return _lookup(EXPORT_FORMATS, mime)


def needs_export(mime: Column) -> Column:
    return mime.isin(list(EXPORT_FORMATS))


def category(mime: Column) -> Column:
    """Exact type first, then the type's prefix, else ``other``."""
    branch = None
    for name in dict.fromkeys(CATEGORIES.values()):
        types = [m for m, of in CATEGORIES.items() if of == name]
        branch = (F if branch is None else branch).when(mime.isin(types), F.lit(name))
    for prefix, name in CATEGORY_PREFIXES:
        branch = branch.when(mime.startswith(prefix), F.lit(name))
    return branch.when(mime.isNotNull(), F.lit("other"))


def extension(mime: Column) -> Column:
    return _lookup(EXTENSIONS, mime)


def native_name(mime: Column) -> Column:
    return F.coalesce(_lookup(NATIVE_NAMES, mime), F.lit(DEFAULT_NATIVE_NAME))


def mime_dimension(spark: SparkSession) -> DataFrame:
    """The exact MIME table as a dimension for joins; its size is the fixed number of known types."""
    rows = [(m, name, EXTENSIONS.get(m), EXPORT_FORMATS.get(m), m in NATIVE_TYPES) for m, name in CATEGORIES.items()]
    return spark.createDataFrame(
        rows, "mime_type string, category string, file_extension string, export_format string, is_native boolean"
    )


def classify_by_dimension(df: DataFrame, mime_col: str = "mime_type") -> DataFrame:
    """Category through a join with the dimension, prefix rules filling the misses."""
    dimension = mime_dimension(df.sparkSession).select(
        F.col("mime_type").alias("_dim_mime"), F.col("category").alias("_dim_category")
    )
    fallback = None
    for prefix, name in CATEGORY_PREFIXES:
        fallback = (F if fallback is None else fallback).when(F.col(mime_col).startswith(prefix), F.lit(name))
    joined = df.join(F.broadcast(dimension), F.col(mime_col) == F.col("_dim_mime"), "left")
    return joined.withColumn(
        "category", F.coalesce("_dim_category", fallback.when(F.col(mime_col).isNotNull(), F.lit("other")))
    ).drop("_dim_mime", "_dim_category")
