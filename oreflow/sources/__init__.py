from oreflow.sources.delimited import (
    file_headers, header_drift, read_delimited, read_lookups, require_headers, row_widths, stream_delimited,
)
from oreflow.sources.digests import content_digest, file_digests
from oreflow.sources.documents import (
    explode_records, pinned_records, read_envelopes, read_lines, read_open_envelopes, record_field, stream_envelopes, stream_lines,
    stream_open_envelopes,
)
from oreflow.sources.listing import list_files
from oreflow.sources.lineage import with_lineage

__all__ = [
    "file_headers", "header_drift", "read_delimited", "read_lookups", "require_headers", "row_widths", "stream_delimited",
    "content_digest", "file_digests",
    "explode_records", "pinned_records", "read_envelopes", "read_lines", "read_open_envelopes", "record_field", "stream_envelopes",
    "stream_lines", "stream_open_envelopes",
    "list_files", "with_lineage",
]
