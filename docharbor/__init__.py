"""Load tables and files into keyed document collections with Spark and keep them in sync."""

from docharbor.errors import ConfigError, LoadError, RejectedRows, SchemaError
from docharbor.plans.dataset import Dataset
from docharbor.plans.load import LoadResult, run_load
from docharbor.plans.sync import SyncSpec, run_sync
from docharbor.spec import LoadSpec

__all__ = [
    "ConfigError",
    "Dataset",
    "LoadError",
    "LoadResult",
    "LoadSpec",
    "RejectedRows",
    "SchemaError",
    "SyncSpec",
    "run_load",
    "run_sync",
]
