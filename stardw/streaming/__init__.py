from .loads import stream_append, stream_changes

__all__ = ["stream_append", "stream_changes"]
