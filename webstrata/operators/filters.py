"""Which captures are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_CONTENT_BYTES, UNWRITTEN_SIZE

# Fixed value: URLs of name lookups, robots files, style sheets and scripts.
URL_REJECT = r"^((dns:.*)|(.*(robots.txt|css|js)$))"

# Our own choice of file extensions that count as media.
MEDIA_EXTENSIONS = (
    "bmp", "gif", "ico", "jpe", "jpeg", "jpg", "png", "svg", "tif", "tiff", "webp",
    "aac", "aif", "aiff", "au", "m4a", "mid", "midi", "mp2", "mp3", "ogg", "ra", "ram", "wav", "wma",
    "asf", "avi", "flv", "m4v", "mkv", "mov", "mp4", "mpeg", "mpg", "qt", "rm", "swf", "webm", "wmv",
    "7z", "arj", "bz2", "gz", "rar", "tar", "tgz", "zip",
    "doc", "pdf", "ppt", "ps", "xls",
)


def annotate_size(df: DataFrame, max_bytes: int = MAX_CONTENT_BYTES, size: Column | None = None) -> DataFrame:
    """Add ``annotation``: why a capture is not to be written, null if it is."""
    size = F.octet_length("body") if size is None else size
    return df.withColumn("annotation", F.when(size > max_bytes, F.lit(UNWRITTEN_SIZE)))


def filter_size(df: DataFrame, max_bytes: int = MAX_CONTENT_BYTES, size: Column | None = None) -> DataFrame:
    """Captures whose content is not larger than the limit; one without content stays."""
    size = F.octet_length("body") if size is None else size
    return df.where(F.coalesce(size <= max_bytes, F.lit(True)))


def filter_url_reject(df: DataFrame, pattern: str = URL_REJECT, column: str = "url") -> DataFrame:
    """Captures whose URL does not match; one without URL stays."""
    return df.where(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def filter_media(df: DataFrame, extensions: tuple[str, ...] = MEDIA_EXTENSIONS, column: str = "extension") -> DataFrame:
    """Captures whose file extension is not a media type; none at all is accepted."""
    return df.where(~F.coalesce(F.col(column).isin(*extensions), F.lit(False)))
