"""Readers and writers for statement files, company documents and file inventories."""

from quarterdeck.sources.delimited import (
    append_delimited,
    infer_delimited,
    read_delimited_text,
    read_directory,
    read_statement,
    write_delimited,
)
from quarterdeck.sources.documents import map_documents, read_documents, record_documents, write_documents
from quarterdeck.sources.files import (
    compare_file_stats,
    file_manifest,
    file_stats,
    json_record_counts,
    required_inputs,
    required_summary,
    verify_files,
)

__all__ = [
    "append_delimited",
    "compare_file_stats",
    "file_manifest",
    "file_stats",
    "infer_delimited",
    "json_record_counts",
    "map_documents",
    "read_delimited_text",
    "read_directory",
    "read_documents",
    "read_statement",
    "record_documents",
    "required_inputs",
    "required_summary",
    "verify_files",
    "write_delimited",
    "write_documents",
]
