"""Errors raised by the driver; executors never raise for bad rows, they mark them."""

from __future__ import annotations

from collections.abc import Sequence

# Fixed values of the error report.
MAX_SAMPLES = 5
MAX_SAMPLE_CHARS = 500


class LoadError(Exception):
    """A load that cannot succeed by running it again."""


class ConfigError(LoadError):
    """An unsupported disposition, strategy, action or missing key."""


class SchemaError(LoadError):
    """A hint that the data cannot satisfy."""


class RejectedRows(LoadError):
    """Some rows of a load were rejected; nothing of the load was committed."""

    def __init__(
        self,
        table: str,
        load_id: str,
        failed_count: int,
        total_count: int,
        samples: Sequence[str],
    ) -> None:
        self.table = table
        self.load_id = load_id
        self.failed_count = failed_count
        self.total_count = total_count
        self.samples = [s[:MAX_SAMPLE_CHARS] for s in samples[:MAX_SAMPLES]]
        super().__init__(
            f"load '{load_id}' of '{table}': {failed_count} rejects among {total_count} rows, "
            f"such as {self.samples}"
        )
