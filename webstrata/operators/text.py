"""Decoded request, response and body text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import charset as C
from ..functions.stages import cut


def decode_text(captures: DataFrame, column: str = "body", to: str = "text", charset: str = "charset") -> DataFrame:
    """Add the text of a binary column by the capture's charset, less one closing line end."""
    keep = [c for c in captures.columns if c != to]
    df = cut(captures.select("*", C.label(F.col(charset)).alias("_label")), "label")
    df = df.select(*keep, C.decode(F.col(column), F.col("_label")).alias("_text"))
    return df.select(*keep, C.chomp(F.col("_text")).alias(to))
