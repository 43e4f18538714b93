from lakestrata.streaming.ingest import default_checkpoint, ingest_new_files

__all__ = ["default_checkpoint", "ingest_new_files"]
