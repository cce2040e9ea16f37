"""Archive records (RAW) -> captures (CAPTURE).

The steps are separate projections so that each intermediate value is computed
once and an unused one is pruned: a count by status never slices a body. Lengths
are in bytes; bodies stay binary and are at most copied, never decoded. The only
text pass over a body is the search for a declaration, for bodies it applies to.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bytesview as B
from ..functions import mime as M
from ..functions import urls as U
from ..functions.stages import cut
from ..schema import BAD_HEADER, CAPTURE, MAGIC, TRUNCATED, VERSION, FieldNames


def _field(block: Column, label: str) -> Column:
    """Last value of a label; every line of ``block`` has an LF on both sides."""
    mark = f"\n{label}:"
    value = F.substring_index(F.substring_index(block, mark, -1), "\n", 1)
    return F.when(F.contains(block, F.lit(mark)), F.ltrim(value, F.lit(" \t")))


def _entries(block: Column) -> Column:
    """Field lines as (label, line number, value), in that order."""
    lines = F.filter(F.split(block, "\n"), lambda x: x != "")
    return F.array_sort(
        F.transform(
            lines,
            lambda x, i: F.struct(
                F.substring_index(x, ":", 1).alias("label"),
                i.alias("line"),
                F.ltrim(F.substring(x, F.instr(x, ":") + 1, F.length(x)), F.lit(" \t")).alias("value"),
            ),
        )
    )


def _fields(entries: Column) -> Column:
    """Map of the entries; of equal labels the last one in line counts."""
    last = F.filter(
        entries,
        lambda e, i: ~F.coalesce(F.try_element_at(entries, i + 2)["label"] == e["label"], F.lit(False)),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["label"], e["value"])))


def crawl_timestamp(text: Column) -> Column:
    """14 digits as TIMESTAMP_NTZ, null for anything else."""
    digits = r"\A(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})\z"
    return F.when(text.rlike(digits), F.regexp_replace(text, digits, "$1-$2-$3 $4:$5:$6")).try_cast("timestamp_ntz")


def is_record(doc: Column) -> Column:
    """Whether a document starts with the first line of this format."""
    return F.coalesce(F.startswith(doc, F.lit(MAGIC)), F.lit(False))


def record_error(doc: Column) -> Column:
    """Why a document is not a record of this format; null for a good one."""
    reason = F.when(F.octet_length(doc) >= len(MAGIC), F.lit(BAD_HEADER)).otherwise(F.lit(TRUNCATED))
    return F.when(~is_record(doc), reason)


def valid_records(raw: DataFrame, mode: str = "DROPMALFORMED") -> DataFrame:
    """Treat records with a bad envelope: keep with ``error``, drop, or fail."""
    mode = mode.upper()
    if mode == "PERMISSIVE":
        return raw.withColumn("error", record_error(F.col("doc")))
    if mode == "DROPMALFORMED":
        return raw.where(is_record(F.col("doc"))).withColumn("error", F.lit(None).cast("string"))
    if mode == "FAILFAST":
        message = F.concat(record_error(F.col("doc")), F.lit(": "), F.coalesce(F.col("uri"), F.lit("?")))
        failed = F.when(~is_record(F.col("doc")), F.raise_error(message).cast("string"))
        return raw.withColumn("error", failed)
    raise ValueError(f"unknown mode {mode!r}: PERMISSIVE, DROPMALFORMED or FAILFAST")


Where = Column | str | Iterable[Column | str]


def _terms(spark: SparkSession, where: Where) -> list[Column]:
    """Conditions that all have to hold. Text is split where its outermost operators are AND."""
    out = []
    for term in [where] if isinstance(where, (str, Column)) else where:
        if not isinstance(term, str):
            out.append(term)
            continue
        left = [spark._jsparkSession.sessionState().sqlParser().parseExpression(term)]
        parts = []
        while left:
            expression = left.pop()
            if expression.getClass().getSimpleName() == "And":
                left += [expression.right(), expression.left()]
            else:
                parts.append(expression)
        out += [F.expr(p.sql()) for p in parts] if len(parts) > 1 else [F.expr(term)]
    return out


def _columns_of(term: Column, df: DataFrame) -> set[str]:
    """Names of the columns that a condition on ``df`` refers to, as Spark resolves them."""
    references = df.where(term)._jdf.queryExecution().analyzed().references().toSeq()
    return {references.apply(i).name() for i in range(references.size())}


def split_where(raw: DataFrame, where: Where) -> tuple[DataFrame, list[Column]]:
    """Apply the conditions that RAW rows can be judged by, and return those that are left.

    These are the ones on ``uri`` and on columns that are passed through; they reach the scan, where they prune folders
    and Parquet row groups. All others wait for the parse."""
    passed = [c for c in raw.columns if c not in ("uri", "doc", "error")]
    parsed = [F.lit(None).cast(f.dataType).alias(f.name) for f in CAPTURE.fields if f.name != "uri"]
    result = raw.select("uri", *[f"`{c}`" for c in passed], *parsed)
    later = []
    for term in _terms(raw.sparkSession, where):
        if _columns_of(term, result) <= {"uri", *passed}:
            raw = raw.where(term)
        else:
            later.append(term)
    return raw, later


def parse_records(
    raw: DataFrame, names: FieldNames = FieldNames(), mode: str = "PERMISSIVE", where: Where = (), html5: bool = False
) -> DataFrame:
    """Parse RAW rows into CAPTURE rows. http and https are read alike.

    Columns of ``raw`` other than ``uri`` and ``doc`` are passed through. ``where`` filters the result by conditions on
    any of its columns; those on ``uri`` and on columns passed through are applied to the scan, before a record is
    looked at (so that FAILFAST does not see the rows they leave out), the others to what was parsed. With ``html5`` a
    ``<meta charset=...>`` in the head, outside of comments, declares a charset too."""
    raw, later = split_where(raw, where)
    extra = [c for c in raw.columns if c not in ("uri", "doc", "error")]
    c = F.col

    df = valid_records(raw, mode)
    # When failing, the check has to be part of the data path or it would be pruned.
    good = c("error").isNull() if mode.upper() == "FAILFAST" else is_record(c("doc"))
    # From here on the document starts with the LF that ends the first line, so
    # that every field line has a line end in front of it.
    df = df.select(*extra, "uri", "error", F.when(good, B.after(c("doc"), len(MAGIC) - 1)).alias("_rest"))

    df = B.with_blank_line(df, "_rest", "_len", "_gap")

    # Field lines run to the blank line or to a line without a colon, which is
    # taken away as well. ISO-8859-1 makes one character out of each byte, so the
    # lengths of this small text are byte counts.
    df = df.select(
        "*", F.concat(F.decode(B.first(c("_rest"), c("_len")), "ISO-8859-1"), F.lit("\n")).alias("_text")
    )
    df = df.select("*", F.length(F.regexp_extract("_text", r"\A\n(?:[^:\n]*+:[^\n]*+\n)*+", 0)).alias("_lines"))
    odd_line = F.substring_index(F.substring(c("_text"), c("_lines") + 1, F.length("_text")), "\n", 1)
    block = F.concat(B.utf8(B.first(c("_rest"), c("_lines"))), F.lit("\n"))
    block = F.replace(block, F.lit("\r\n"), F.lit("\n"))
    df = df.select(
        *extra, "uri", "error", "_rest",
        # Lines without a value go, so that they do not hide an earlier value.
        F.regexp_replace(block, r"\n[^:\n]*+:[ \t]*+(?=\n)", "").alias("_block"),
        F.when(c("_lines") > c("_len"), c("_len") + c("_gap"))
        .otherwise(c("_lines") + F.length(odd_line) + 1)
        .alias("_end"),
    )

    df = df.select(
        *extra, "uri", "error", "_block",
        _field(c("_block"), names.url).alias("url"),
        B.after(c("_rest"), c("_end")).alias("_tail"),
    )
    df = df.select("*", U.scheme(c("url")).alias("scheme"))
    df = df.select("*", F.coalesce(c("scheme").isin("http", "https"), F.lit(False)).alias("_web"))

    df = B.with_blank_line(df, "_tail", "_request_len", "_request_gap")
    size = F.when(c("_web"), c("_request_len") + c("_request_gap")).otherwise(0)
    df = df.select(
        *[x for x in df.columns if x not in ("_tail", "_request_len", "_request_gap")],
        B.first(c("_tail"), size).alias("request"),
        B.after(c("_tail"), size).alias("response"),
    )

    df = cut(df, "split")
    df = B.with_blank_line(df, "response", "_head_len", "_head_gap")
    df = df.select(
        *[x for x in df.columns if x not in ("_head_len", "_head_gap")],
        F.when(c("_web"), B.view(B.first(c("response"), c("_head_len")))).alias("_head"),
        F.when(~c("_web"), c("response"))
        .when(c("_head_gap") > 0, B.after(c("response"), c("_head_len") + c("_head_gap")))
        .otherwise(F.when(c("response").isNotNull(), B.empty()))
        .alias("body"),
    )

    df = df.select("*", M.content_type_header(c("_head")).alias("_ct"))
    df = df.select("*", M.normalize_mime(c("_ct")).alias("_type"))
    df = df.select("*", F.when(c("_web") & M.sniffable(c("_type")), M.declaration(B.view(c("body")), html5)).alias("_found"))
    # What the declaration says, with an empty string for "says nothing".
    df = df.select(
        "*",
        M.is_xml_declaration(c("_found")).alias("_xml"),
        M.meta_content(c("_found")).alias("_meta"),
    )
    named = M.html5_charset(c("_found")) if html5 else F.lit(None).cast("string")
    df = df.select("*", named.alias("_named"))
    df = df.select("*", F.coalesce(M.charset_label(c("_meta")), c("_named"), M.charset_label(c("_ct"))).alias("_label"))

    df = cut(df, "declared")
    df = df.select("*", _entries(c("_block")).alias("_entries"))

    status = F.regexp_extract("_head", r"\A\S*\s+(\d+)", 1).try_cast("int")
    columns = {
        "version": F.when(c("_block").isNotNull(), F.lit(VERSION)),
        "ip": _field(c("_block"), names.ip),
        "crawl_time": crawl_timestamp(_field(c("_block"), names.crawl_time)),
        "is_seed": _field(c("_block"), names.is_seed).try_cast("boolean"),
        "path_from_seed": _field(c("_block"), names.path_from_seed),
        "via": _field(c("_block"), names.via),
        "seed_url": _field(c("_block"), names.seed_url),
        "fields": _fields(c("_entries")),
        "extension": U.extension(c("url")),
        "status": F.when(c("_block").isNotNull(), F.coalesce(status, F.lit(0))),
        "content_type": F.coalesce(M.sniffed_type(c("_meta"), c("_type")), F.when(c("_named").isNotNull(), "text/html")),
        "charset": F.coalesce(F.when(c("_xml"), M.xml_encoding(c("_found"))), M.clean_charset(c("_label"))),
    }
    df = df.select(*extra, *[columns.get(f.name, c(f.name)).alias(f.name) for f in CAPTURE.fields])
    # Filters on the result stay above this point. Moved below, a filter would repeat the expressions of all steps, over
    # and over, to compute its column a second time.
    df = cut(df, "parse")
    return reduce(DataFrame.where, later, df)


def field_lookup(captures: DataFrame, label: str, name: str = "value") -> DataFrame:
    """Add the value of one label, null where the record does not have it."""
    return captures.withColumn(name, F.try_element_at(F.col("fields"), F.lit(label)))


def derived_select(captures: DataFrame) -> DataFrame:
    """What a record says and what was derived from it, without its bytes."""
    return captures.select(
        "uri", "url", "ip", "crawl_time", "is_seed", "seed_url", "path_from_seed", "via", "fields",
        "content_type", "charset", "status", "scheme", "extension",
    )
