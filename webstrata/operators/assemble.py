"""Building archive records from captures.

Input columns: ``uri`` or ``url``, the well-known field columns of ``FieldNames``,
``request`` and ``response`` (binary). Columns that are missing count as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bytesview as B
from ..schema import CRLF, OPTIONAL_FIELDS, TIMESTAMP_FORMAT, VERSION, FieldNames


def crawl_time_14(ts: Column) -> Column:
    """A timestamp as 14 digits; one without time zone is taken as it is."""
    return F.date_format(ts, TIMESTAMP_FORMAT)


def _one_line(value: Column) -> Column:
    """A value must not break its line, or the record could not be read back."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def _values(df: DataFrame) -> dict[str, Column]:
    """Text of each well-known field, null where the label is to be left out."""
    types = dict(df.dtypes)

    def text(name: str) -> Column:
        if name == "url" and "url" not in types:
            name = "uri"
        if name not in types:
            return F.lit(None).cast("string")
        if types[name].startswith("timestamp"):
            value = F.col(name)
            if types[name] == "timestamp":
                value = F.to_utc_timestamp(value, F.current_timezone())
            return crawl_time_14(value)
        return _one_line(F.col(name).cast("string"))

    out = {}
    for name, _ in FieldNames().items():
        value = text(name)
        if name in OPTIONAL_FIELDS:
            out[name] = F.when(F.trim(value) != "", value)
        else:
            out[name] = F.coalesce(value, F.lit(""))
    return out


def named_fields(df: DataFrame, names: FieldNames = FieldNames()) -> DataFrame:
    """Add ``fields``: label -> value of the fields a record of this capture has.

    URL, address, crawl time, seed flag and seed URL are always there, path and
    referrer only when not blank."""
    values = _values(df)
    pairs = [x for name, label in names.items() for x in (F.lit(label), values[name])]
    return df.withColumn("fields", F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()))


def rename_fields(df: DataFrame, old: FieldNames, new: FieldNames) -> DataFrame:
    """Relabel the well-known fields of a ``fields`` map; other labels stay.

    Where a record also has a field of its own under the new label, the relabelled one wins."""
    changed = [(a, b) for (_, a), (_, b) in zip(old.items(), new.items()) if a != b]
    if not changed:
        return df
    labels = F.create_map(*[F.lit(x) for pair in changed for x in pair])
    before = F.create_map(*[F.lit(x) for a, b in changed for x in (b, a)])

    def stays(k: Column, _: Column) -> Column:
        replaced = F.coalesce(F.map_contains_key("fields", F.coalesce(F.try_element_at(before, k), F.lit(""))), F.lit(False))
        return ~replaced | F.try_element_at(labels, k).isNotNull()

    kept = F.map_filter("fields", stays)
    return df.withColumn("fields", F.transform_keys(kept, lambda k, _: F.coalesce(F.try_element_at(labels, k), k)))


def _record(field_block: Column, request: Column, response: Column) -> Column:
    header = F.concat(F.lit(VERSION + CRLF), field_block, F.lit(CRLF))
    return F.concat(
        F.encode(header, "UTF-8"),
        F.coalesce(request, B.empty()),
        F.coalesce(response, B.empty()),
    )


def has_request(uri: Column, request: Column) -> Column:
    """The request where a record stores one, that is for http* URIs, else null."""
    return F.when(F.startswith(F.lower(uri), F.lit("http")), request)


def _binary(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("binary")


def encode_record(df: DataFrame, names: FieldNames = FieldNames(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Captures -> RAW (``uri``, ``doc``), after any columns to ``keep``."""
    values = _values(df)
    lines = []
    for name, label in names.items():
        line = F.concat(F.lit(f"{label}: "), values[name], F.lit(CRLF))
        lines.append(F.coalesce(line, F.lit("")) if name in OPTIONAL_FIELDS else line)
    uri = F.col("uri") if "uri" in df.columns else F.col("url")
    doc = _record(F.concat(*lines), has_request(uri, _binary(df, "request")), _binary(df, "response"))
    return df.select(*keep, uri.alias("uri"), doc.alias("doc"))


def rewrite_record(
    df: DataFrame,
    set_fields: dict[str, Column | str] | None = None,
    request: Column | None = None,
    response: Column | None = None,
    names: FieldNames = FieldNames(),
) -> DataFrame:
    """Parsed captures -> RAW with changed fields, request or response.

    All labels of ``fields`` are kept, the well-known ones in their usual order,
    the others after them by name. Setting a label to null removes it."""
    fields = F.col("fields")
    if set_fields:
        changed = [
            x for k, v in set_fields.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v).cast("string"))
        ]
        kept = F.map_filter("fields", lambda k, _: ~k.isin(*set_fields))
        fields = F.map_filter(F.map_concat(kept, F.create_map(*changed)), lambda _, v: v.isNotNull())
    known = [label for _, label in names.items()]
    staged = df.select(
        "uri",
        fields.alias("fields"),
        (F.col("request") if request is None else request).alias("request"),
        (F.col("response") if response is None else response).alias("response"),
    )
    others = F.array_sort(F.filter(F.map_keys("fields"), lambda k: ~k.isin(*known)))
    present = F.filter(
        F.concat(F.array(*[F.lit(k) for k in known]), others),
        lambda k: F.try_element_at(F.col("fields"), k).isNotNull(),
    )
    block = F.array_join(
        F.transform(
            present, lambda k: F.concat(k, F.lit(": "), _one_line(F.try_element_at(F.col("fields"), k)), F.lit(CRLF))
        ),
        "",
    )
    doc = _record(block, F.col("request"), F.col("response"))
    return staged.select("uri", doc.alias("doc"))


def frame_record(raw: DataFrame) -> DataFrame:
    """RAW with ``doc`` carrying its 4-byte length in front."""
    return raw.withColumn("doc", B.frame(F.col("doc")))


def unframe_record(raw: DataFrame) -> DataFrame:
    return raw.withColumn("doc", B.unframe(F.col("doc")))
