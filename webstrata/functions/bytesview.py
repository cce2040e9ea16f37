"""Byte-exact work on binary columns with Spark's own string functions.

Casting a binary column to string neither copies nor checks the bytes, and
``substring_index`` and ``octet_length`` work on bytes. So record boundaries can
be found without decoding a body, whatever its bytes are; only the short header
parts are ever turned into text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def empty() -> Column:
    return F.lit(b"")


def view(binary: Column) -> Column:
    """The bytes as an unchecked string, for byte searches and ASCII patterns."""
    return binary.cast("string")


def utf8(binary: Column) -> Column:
    """The bytes as text, broken UTF-8 sequences replaced by U+FFFD."""
    return F.make_valid_utf8(binary.cast("string"))


def after(binary: Column, n_bytes: Column | int) -> Column:
    """The bytes that follow the first ``n_bytes``."""
    start = F.lit(n_bytes) + F.lit(1) if isinstance(n_bytes, int) else n_bytes + F.lit(1)
    return F.substring(binary, start, F.octet_length(binary))


def first(binary: Column, n_bytes: Column) -> Column:
    return F.substring(binary, F.lit(1), n_bytes)


def with_blank_line(df: DataFrame, column: str, length: str, gap: str) -> DataFrame:
    """Find the first LF LF or LF CR LF in a binary column, whichever comes earlier.

    ``length``: bytes before the line end that starts the blank line, all bytes if there
    is none. ``gap``: bytes of that line end and the blank line, 0 if there is none."""
    rest = [c for c in df.columns]
    size = F.octet_length(column)
    df = df.select("*", F.substring_index(view(F.col(column)), "\n\r\n", 1).alias("_crlf"))
    has_crlf = F.octet_length("_crlf") < size
    # The LF after the cut belongs to the search: "\n\n\r\n" starts with an LF LF.
    searched = F.when(has_crlf, F.concat(F.col("_crlf"), F.lit("\n"))).otherwise(F.col("_crlf"))
    df = df.select("*", F.substring_index(searched, "\n\n", 1).alias("_lf"))
    has_lf = F.octet_length("_lf") < F.octet_length("_crlf") + F.when(has_crlf, 1).otherwise(0)
    return df.select(
        *rest,
        F.when(has_lf, F.octet_length("_lf")).otherwise(F.octet_length("_crlf")).alias(length),
        F.when(has_lf, 2).when(has_crlf, 3).otherwise(0).alias(gap),
    )


def big_endian(n: Column, n_bytes: int) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 2 * n_bytes, "0"))


def frame(doc: Column) -> Column:
    """Put the 4-byte big-endian length in front of a document."""
    return F.concat(big_endian(F.octet_length(doc), 4), doc)


def unframe(framed: Column) -> Column:
    """Drop the 4-byte length of a framed document."""
    return after(framed, 4)


def to_text_writable(payload: Column) -> Column:
    """Serialise bytes the way a Hadoop ``Text`` is: variable-length int, then bytes."""
    n = F.octet_length(payload).cast("bigint")
    size = F.ceil(F.length(F.hex(n)) / F.lit(2)).cast("int")
    long_form = F.concat(
        F.unhex(F.hex((F.lit(144) - size).cast("bigint"))),
        F.unhex(F.lpad(F.hex(n), size * 2, F.lit("0"))),
    )
    return F.concat(F.when(n <= 127, big_endian(n, 1)).otherwise(long_form), payload)


def from_text_writable(value: Column) -> Column:
    """The payload of a serialised Hadoop ``Text``."""
    lead = F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")
    return after(value, F.when(lead <= 127, 1).otherwise(F.lit(145) - lead))
