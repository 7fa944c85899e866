from .jobs import file_stream, read_staged, stream_append_new, stream_stage, stream_upsert

__all__ = ["file_stream", "read_staged", "stream_append_new", "stream_stage", "stream_upsert"]
