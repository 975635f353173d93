"""What the text operators share: stored intermediate tables and Arrow maps over a text column.

Python work goes through ``mapInArrow`` in slices of a megabyte of text, so memory does not depend on how many rows
Spark puts into a batch; only a single text longer than a slice is held whole.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.session import work_folder

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there, and a lost executor costs nothing."""
    path = work_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once for each application, for clusters where it is not installed."""
    context = spark.sparkContext
    if not getattr(context, "_martloom_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/martloom", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._martloom_shipped = True


def arrow_map(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """mapInArrow with the package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def fold_of(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo the number of parts (NULL ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns only, so that a repeated task draws the same."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def text_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings (or binary values), one after the other, and where each begins (one more entry than
    strings).

    NULL counts as the empty string.
    """
    plain = pa.types.is_binary(strings.type) or pa.types.is_large_binary(strings.type)
    if strings.null_count:
        strings = strings.fill_null(b"" if plain else "")
    strings = strings.cast(pa.large_binary() if plain else pa.large_string())
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most so many bytes of text; a longer text is a run of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def with_text_columns(
    df: DataFrame, text: str, added: StructType, make: Callable[[], Callable[[pa.Array], list]], most: int = SLICE_BYTES
) -> DataFrame:
    """All columns of df, and those that make()(texts) returns for the text column.

    make runs once in each task; what it returns gets an Arrow array of texts and gives one array for each added field.
    """
    names = [*df.columns, *added.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text, most):
                found = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(part.column(text))]
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=names)

    return arrow_map(df, run, StructType([*df.schema.fields, *added.fields]))
