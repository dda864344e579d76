from oreflow.functions.links import extract_links, file_name, first_links, is_data_file
from oreflow.functions.names import resolve_column, sanitize_names
from oreflow.functions.text import to_double, to_int, to_long, trimmed

__all__ = [
    "extract_links", "file_name", "first_links", "is_data_file",
    "resolve_column", "sanitize_names",
    "to_double", "to_int", "to_long", "trimmed",
]
