from .ingest import ingest_new_files, read_ingested

__all__ = ["ingest_new_files", "read_ingested"]
