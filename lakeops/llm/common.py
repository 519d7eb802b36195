"""Small helpers shared by the operators: words, row keys, checkpoints, Arrow batches."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import ensure_checkpoint_dir

#: a word is a run of anything but space, tab, newline, vertical tab, form feed and carriage return
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """128 bits that name a row by its id and text, never null.

    Rows with the same id and text share the key, whatever order or task they are read in,
    so a lost executor cannot change it.
    """
    i, t = F.col(doc_id).cast("string"), whole(text)
    return F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit("|"), i).alias("k2")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` whose names do not clash with ``names``; an operator's column replaces one of the same name."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def columns_named(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col(f"`{n}`") for n in names]


def give_back() -> None:
    """Return what this worker has freed to the system: it outlives its task, and later stages need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # not every C library has it
    if trim:
        trim(0)


def map_rows(df: DataFrame, keep: Sequence[str], fields: T.StructType, inputs: Sequence[str],
             work: Callable[..., dict[str, Sequence]]) -> DataFrame:
    """Append columns computed per Arrow batch.

    ``work(*columns)`` gets the input columns as Arrow arrays and returns a sequence per new field.
    The columns ``keep`` pass through.
    """
    names = {f.name for f in fields}
    keep = [c for c in keep if c not in names]
    read = list(dict.fromkeys([*keep, *inputs]))
    # by number: Spark resolves the names of what it hands to Arrow, and a name may hold a dot
    slim = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns_named(read))])
    schema = T.StructType([T.StructField(c, slim.schema[i].dataType, slim.schema[i].nullable) for i, c in enumerate(keep)] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = work(*[batch.column(read.index(c)) for c in inputs])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(keep))]
                    + [new[f.name] if isinstance(new[f.name], pa.Array) else pa.array(new[f.name], arrow_type(f.dataType))
                       for f in fields],
                    names=[*keep, *[f.name for f in fields]])
        give_back()

    return slim.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
              T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind])
    return simple[type(kind)]


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column, a null one as the empty text."""
    return (x or "" for x in column.to_pylist())


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts of an Arrow column, and the number of the text each stands in."""
    split = pc.ascii_split_whitespace(column.cast(pa.string()).fill_null(""))
    flat = split.flatten()
    text = np.repeat(np.arange(len(column)), np.diff(split.offsets.to_numpy()))
    full = pc.binary_length(flat).to_numpy() > 0           # white space at the ends leaves empty words
    return (flat, text) if full.all() else (flat.filter(pa.array(full)), text[full])


def blocks(column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first row, their bytes in one array, their bounds in it."""
    column = pa.array([x or "" for x in column.to_pylist()], pa.large_string()) if column.null_count else column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        last = min(last, len(column))
        yield first, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


class Shipped:
    """A value broadcast to the tasks, with state that a worker process keeps from task to task.

    The state is a cache: it may be lost or start anew at any time without changing a result.
    """

    def __init__(self, spark, value):
        self._held = spark.sparkContext.broadcast({"value": value})

    @property
    def value(self):
        return self._held.value["value"]

    def state(self, name: str, make: Callable):
        held = self._held.value
        if name not in held:
            held[name] = make()
        return held[name]
