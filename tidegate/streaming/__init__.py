"""The polling sync as Structured Streaming micro-batches."""

from tidegate.streaming.sync import start_sync, sync_epoch, validate_stream

__all__ = ["start_sync", "sync_epoch", "validate_stream"]
