"""The same load per micro-batch of a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from docharbor.plans.dataset import Dataset
from docharbor.plans.load import run_load
from docharbor.spec import LoadSpec


def load_stream(
    stream: DataFrame, dataset: Dataset, spec: LoadSpec, *, name: str, checkpoint: str
) -> DataStreamWriter:
    """A writer that loads every micro-batch under an id of its own.

    A batch that is replayed after a failure has the id of its first try, and a load that
    was completed is not run again, so every batch takes effect once. The id holds that of
    the checkpoint: a stream begun anew counts its batches from 0 again, and they are others.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run_load(dataset, [(spec, batch)], f"{name}-{_stream_id(batch, checkpoint)}-{batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)


def _stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint."""
    rows = batch.sparkSession.read.text(f"{checkpoint}/metadata").collect()
    return json.loads(rows[0][0])["id"]
