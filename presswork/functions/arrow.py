"""Arrow-batched functions that are made when they are called: their types can't be parsed without a session."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of input that are Python objects at once; a batch of ten thousand pages would be several copies of itself.
SLICE_BYTES = 1 << 20


def release() -> None:
    """Gives freed memory back to the system; a Python worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def _sliced(columns: tuple[pa.Array, ...]) -> Iterator[list[pd.Series]]:
    """The columns in pieces of about SLICE_BYTES, and of a row at least."""
    n = len(columns[0])
    rows = max(1, n * SLICE_BYTES // max(1, sum(c.nbytes for c in columns)))
    for at in range(0, n, rows):
        yield [pd.Series(c.slice(at, rows).to_pylist(), dtype=object) for c in columns]


def _array(out: pd.Series | pd.DataFrame, kind: pa.DataType, zone: str) -> pa.Array:
    """out in Arrow; times without a zone are local."""
    if isinstance(out, pd.DataFrame):
        return pa.StructArray.from_arrays([_array(out[f.name], f.type, zone) for f in kind], fields=list(kind))
    if pa.types.is_timestamp(kind) and kind.tz and out.dt.tz is None:
        out = out.dt.tz_localize(zone, ambiguous=False)
    return pa.array(out, kind, from_pandas=True)


def arrow_function(kind: str, once: bool = False):
    """A function of pandas Series, as a column function; Series are pieces of Spark's batches.

    With `once` the optimizer can't call it again where a filter or another column needs what came of it.
    """

    def made(f):
        @wraps(f)
        def call(*columns: Column) -> Column:
            spark_type = T.DataType.fromDDL(kind)
            into, zone = to_arrow_type(spark_type), SparkSession.active().conf.get("spark.sql.session.timeZone")

            def run(*batch: pa.Array) -> pa.Array:
                parts = [_array(f(*piece), into, zone) for piece in _sliced(batch)]
                out = pa.concat_arrays(parts) if parts else pa.array([], into)
                del parts
                release()
                return out

            made_of = F.arrow_udf(run, spark_type)
            return (made_of.asNondeterministic() if once else made_of)(*columns)

        call.plain = f
        return call

    return made
