"""Table layouts, field labels and fixed values shared by every job."""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields

from pyspark.sql import types as T

# Fixed values of the archive record format. They have to be byte-equal to what
# existing archives contain, so they are spelled out here and nowhere else.
VERSION = "HDFSWriter/0.3"
MAGIC = f"{VERSION}\r\n".encode("ascii")
CRLF = "\r\n"
TIMESTAMP_FORMAT = "yyyyMMddHHmmss"

# Fixed default limits: content size filter and file roll size.
MAX_CONTENT_BYTES = 20 * 1024 * 1024
ROLL_BYTES = 63 * 1024 * 1024

# Fixed number of steps that may be taken past the first parent to find a seed.
SEED_WALK_STEPS = 50

# Annotation given to a capture that the size filter rejects.
UNWRITTEN_SIZE = "unwritten:size"

# Parse errors of malformed records.
TRUNCATED = "document truncated"
BAD_HEADER = "bad document header"


@dataclass(frozen=True)
class FieldNames:
    """Label of each well-known field, in the order in which it is written."""

    url: str = "URL"
    ip: str = "Ip-Address"
    crawl_time: str = "Crawl-Time"
    is_seed: str = "Is-Seed"
    seed_url: str = "Seed-Url"
    path_from_seed: str = "Path-From-Seed"
    via: str = "Via"

    def __post_init__(self):
        labels = astuple(self)
        if len(set(labels)) != len(labels):
            raise ValueError(f"field labels must differ: {labels}")
        for label in labels:
            if not label or any(c in label for c in ":\r\n"):
                raise ValueError(f"not a usable field label: {label!r}")

    def items(self) -> list[tuple[str, str]]:
        """(column name, label) pairs in writing order."""
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


# Columns whose label is left out of a record when the value is blank.
OPTIONAL_FIELDS = ("path_from_seed", "via")

RAW = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("doc", T.BinaryType()),
    ]
)

CAPTURE = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("crawl_time", T.TimestampNTZType()),
        T.StructField("is_seed", T.BooleanType()),
        T.StructField("path_from_seed", T.StringType()),
        T.StructField("via", T.StringType()),
        T.StructField("seed_url", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("scheme", T.StringType()),
        T.StructField("extension", T.StringType()),
        T.StructField("request", T.BinaryType()),
        T.StructField("response", T.BinaryType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("charset", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

LINK = T.StructType(
    [
        T.StructField("src_url", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("href", T.StringType()),
        T.StructField("target_url", T.StringType()),
        T.StructField("is_internal", T.BooleanType()),
    ]
)
