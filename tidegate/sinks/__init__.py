"""Previews, reports and the state tables of a deployment."""

from tidegate.sinks.files import write_preview, write_report
from tidegate.sinks.state import Commit, StateStore

__all__ = ["Commit", "StateStore", "write_preview", "write_report"]
