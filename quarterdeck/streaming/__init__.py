"""Incremental loading of statement files as they land (Structured Streaming).

The warehouse refreshes by re-running batch loads; :func:`stream_statements`
is the same append load as an incremental, exactly-once file stream.
"""

from quarterdeck.streaming.incremental import landing_schema, run_available, stream_statements

__all__ = ["landing_schema", "run_available", "stream_statements"]
