"""Elements, attributes and links of HTML captures as table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bytesview as B
from ..functions import html as H
from ..functions import urls as U
from ..functions.stages import cut


def _text(captures: DataFrame, body: str):
    return B.utf8(F.col(body)) if dict(captures.dtypes)[body] == "binary" else F.col(body)


def extract_elements(captures: DataFrame, element: str, keep: tuple[str, ...] = ("url",), body: str = "body") -> DataFrame:
    """One row per start tag of an element: ``pos`` and ``tag``."""
    return captures.select(*keep, F.posexplode(H.start_tags(_text(captures, body), element)).alias("pos", "tag"))


def extract_attributes(tags: DataFrame) -> DataFrame:
    """One row per attribute of ``tag``: ``attr_pos``, ``name``, ``value``."""
    keep = [c for c in tags.columns if c != "tag"]
    rows = tags.select(*keep, F.posexplode(H.attributes(F.col("tag"))).alias("attr_pos", "_written"))
    return rows.where("attr_pos > 0").select(
        *keep,
        "attr_pos",
        H.attribute_name(F.col("_written")).alias("name"),
        H.attribute_value(F.col("_written")).alias("value"),
    )


def element_content(captures: DataFrame, element: str, keep: tuple[str, ...] = ("url",), body: str = "body") -> DataFrame:
    """One row per closed element: ``pos`` and ``content``."""
    rows = captures.select(*keep, F.posexplode(H.elements(_text(captures, body), element)).alias("pos", "_written"))
    return rows.where(H.is_closed(F.col("_written"), element)).select(
        *keep, "pos", H.element_content(F.col("_written"), element).alias("content")
    )


def with_base(captures: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Add ``base_url``: href of the first base element in the head, resolved against
    the page; without a usable one the URL of the page itself."""
    keep = [c for c in captures.columns if c != "base_url"]
    df = captures.withColumn("_tag", H.first_tag(H.element_content(_text(captures, body), "head"), "base"))
    df = df.withColumn("_href", F.when(F.col("_tag") != "", H.attribute(F.col("_tag"), "href")))
    df = cut(U.with_base_parts(df, url, "_page"), "base")
    df = U.with_resolved(df, "_href", "_named", "_page")
    named = F.when(F.col("_href") != "", F.col("_named"))
    return df.select(*keep, F.coalesce(named, F.col(url)).alias("base_url"))


def _pages(captures: DataFrame, url: str, body: str) -> DataFrame:
    return with_base(captures.select(F.col(url).alias("src_url"), _text(captures, body).alias("_html")), "src_url", "_html")


def _hrefs(pages: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    hrefs = extract_attributes(extract_elements(pages, "a", keep, "_html")).where("name = 'href' and value is not null")
    return hrefs.select(*keep, "pos", F.col("value").alias("href"))


def _resolved(links: DataFrame, keep_unresolved: bool) -> DataFrame:
    """Resolve ``href`` by ``_base``; a target on ``src_host`` is internal."""
    out = U.with_resolved(links, "href", "target_url")
    if not keep_unresolved:
        out = out.where(F.col("target_url").isNotNull())
    same = F.coalesce(U.host(F.col("target_url")) == F.col("src_host"), F.lit(False))
    return out.withColumn("is_internal", F.when(F.col("target_url").isNotNull(), same)).drop("_base")


def extract_links(captures: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """One row per href of an ``a`` element: ``src_url``, ``base_url``, ``pos``, ``href``."""
    return _hrefs(_pages(captures, url, body), ("src_url", "base_url"))


def resolve_links(links: DataFrame, keep_unresolved: bool = False) -> DataFrame:
    """Add ``target_url`` and ``is_internal`` (same host as the page) -> LINK.

    A reference that is no valid URI cannot be resolved. It is dropped, or kept with
    a null target so that it can be counted."""
    staged = U.with_base_parts(links, "base_url").withColumn("src_host", U.host(F.col("src_url")))
    return _resolved(staged, keep_unresolved).select("src_url", "pos", "href", "target_url", "is_internal")


def hosted_links(captures: DataFrame, url: str = "url", body: str = "body", keep_unresolved: bool = False) -> DataFrame:
    """LINK rows of HTML captures and ``src_host``; all that depends on the page alone
    is worked out before its links are taken apart."""
    pages = U.with_base_parts(_pages(captures, url, body), "base_url")
    pages = pages.withColumn("src_host", U.host(F.col("src_url")))
    links = _resolved(_hrefs(pages, ("src_url", "src_host", "_base")), keep_unresolved)
    return links.select("src_host", "src_url", "pos", "href", "target_url", "is_internal")


def page_links(captures: DataFrame, url: str = "url", body: str = "body", keep_unresolved: bool = False) -> DataFrame:
    """LINK rows of HTML captures."""
    return hosted_links(captures, url, body, keep_unresolved).drop("src_host")
