"""Web-crawl archives on Spark: capture tables, parsing, links, URLs, reports."""

from .functions.sql import register_functions
from .functions.urls import canonical_url, normalize_url, url_fingerprint
from .operators.assemble import encode_record, frame_record, named_fields, rename_fields, rewrite_record, unframe_record
from .operators.dedupe import dedupe_captures
from .operators.filters import annotate_size, filter_media, filter_size, filter_url_reject
from .operators.lineage import resolve_seed, via_join
from .operators.links import element_content, extract_attributes, extract_elements, extract_links, page_links, resolve_links
from .operators.parse import derived_select, field_lookup, parse_records, split_where, valid_records
from .operators.text import decode_text
from .plans.reports import bytes_written, count_charsets, count_links, count_mime_types, output_text, running_bytes
from .schema import CAPTURE, LINK, RAW, FieldNames
from .sources.archive import Written, publish_files, scan_archive, scan_multi, sink_archive, stored_compression, write_open_files
from .sources.counted import stream_written
from .sources.documents import scan_documents, scan_pages, sink_documents
from .sources.rolling import assign_files, sink_rolling
from .sources.table import scan_split, scan_table, sink_split, sink_table
from .streaming.ingest import stream_filter, stream_ingest, stream_rows

__all__ = [n for n in dir() if not n.startswith("_")]
