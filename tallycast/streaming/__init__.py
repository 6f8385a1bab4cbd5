from .ingest import ingest_new_days, merge_days

__all__ = ["ingest_new_days", "merge_days"]
