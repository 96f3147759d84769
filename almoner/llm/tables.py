"""Reading input tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from almoner.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage: a lost executor costs the tasks that were running, not
    what was kept. The files live as long as the checkpoint folder does.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and where each row begins (one more for the end). Null: empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` bytes of text; a longer text comes alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(lengths):
        return
    part = (np.cumsum(lengths) - lengths) // limit
    edges = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [len(lengths)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def same_key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of neighbouring rows that agree in ``keys``, from batches sorted by them."""
    rest: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows, bool)
        columns = [t.column(k).to_numpy() for k in keys]
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        edges = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        if rest and first != last:
            yield pa.concat_tables(rest)
            rest = []
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            if rest:
                yield pa.concat_tables([*rest, t.slice(a, b - a)])
                rest = []
            else:
                yield t.slice(a, b - a)
        rest.append(t.slice(edges[-2], edges[-1] - edges[-2]))
        last = tuple(c[-1] for c in columns)
    if rest:
        yield pa.concat_tables(rest)
