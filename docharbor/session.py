"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Timestamps without an offset mean UTC, so every session must agree on it.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of a hot root are split even where the step after the join must move them once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Only the newer Parquet reader pushes counts into the scan.
FOOTER_COUNTS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}

# Files of a shuffle go with the query that made them, not when the driver next collects garbage.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Files a task may write at once, instead of sorting its rows by their folders.
OPEN_FILES_LIMIT = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the plans that are made and run inside the block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(name: str = "docharbor", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    )
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Pin the session time zone that every conversion assumes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def split_hot_roots(spark: SparkSession) -> None:
    """Let joins by root id split a root that owns very many children, at the cost of a shuffle."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _single_machine_dir()


@cache
def _single_machine_dir() -> str:
    return tempfile.mkdtemp(prefix="docharbor-")
