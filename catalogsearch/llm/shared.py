"""What the operators of this subpackage share: the folder all executors see, and tables written there."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..checkpoints import checkpoint_folder


def shared_path(session: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_folder(session)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The DataFrame, written once as Parquet to the shared folder and read back, so that lineage ends here."""
    session = frame.sparkSession
    path = shared_path(session, label)
    frame.write.parquet(path)
    return session.read.schema(frame.schema).parquet(path)


def table(session: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.read.parquet(f"{sf_dir}/{name}.parquet")


def by_rows(function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], rows: int):
    """For mapInArrow: calls the function with at most so many rows at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield from function(batch.slice(start, rows))

    return run


def kept_by_worker(key: tuple, make: Callable[[], object]):
    """What a Python worker makes once and keeps between tasks: one thing at a time.

    Functions of this package travel by value, so their own module's globals are new in each task; this is not. A worker
    outlives its stage, so what an earlier operator kept, such as a tokenizer's cache, is dropped here.
    """
    place = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if place.__dict__.get("key") != key:
        place.key = place.thing = None
        place.thing = make()
        place.key = key
    return place.thing
