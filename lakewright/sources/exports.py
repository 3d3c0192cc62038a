"""Writing DataFrames as framed gzip objects: the inverse of the ingest sources."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from lakewright.scratch import qualified_path
from lakewright.sources.framing import HEADER
from lakewright.sources.stores import store_of, store_settings


def frame_object(records: list[bytes]) -> bytes:
    """One gzip object holding the records as length-prefixed frames."""
    return gzip.compress(b"".join(struct.pack(HEADER, len(r)) + r for r in records), 6, mtime=0)


def write_objects(df: DataFrame, root: str) -> DataFrame:
    """Write each ``name, content`` row as the object ``root/name`` and return ``path, length``.

    Objects are written by the tasks themselves. A retried task writes the same
    bytes to the same name.
    """
    root, settings = qualified_path(df.sparkSession, root), store_settings(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root, settings)
        store.create_dir(base, recursive=True)
        for batch in batches:
            paths, lengths = [], []
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                    out.write(content.as_buffer())
                paths.append(f"{root.rstrip('/')}/{name}")
                lengths.append(len(content.as_buffer()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], names=["path", "length"]
            )

    return df.select("name", "content").mapInArrow(run, "path string, length bigint")


def write_groups(
    df: DataFrame, keys: Sequence[Column], root: str, object_of: Callable[[tuple, pd.DataFrame], tuple[str, bytes]]
) -> DataFrame:
    """Write each group of rows with equal ``keys`` as the object ``root/name`` that ``object_of`` gives with its content, and return ``path, length``.

    The worker that builds an object writes it and holds that one only. Built by one step and written by the next, each core would
    keep two workers, and the second would hold as many objects as Spark hands over in a batch.
    """
    root, settings = qualified_path(df.sparkSession, root), store_settings(df.sparkSession)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, content = object_of(key, pdf)
        store, base = store_of(root, settings)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(content)
        return pd.DataFrame({"path": [f"{root.rstrip('/')}/{name}"], "length": [len(content)]})

    return df.groupBy(*keys).applyInPandas(run, "path string, length bigint")


def set_modified(spark: SparkSession, paths: Iterable[str], millis: int) -> None:
    """Give a handful of objects another modification time, where their file system keeps one."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(where, millis, -1)
