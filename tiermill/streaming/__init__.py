from .ingest import ingest_stream, read_stream

__all__ = ["ingest_stream", "read_stream"]
