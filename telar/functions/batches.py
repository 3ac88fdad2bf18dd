"""Arrow batches in and out of Python workers, in slices small enough for two workers beside one small heap."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from telar.session import ship


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str | StructType, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` over plain lists.

    ``make()`` runs once per task and returns the function that gets a slice of at most ``rows`` rows as a dict of
    lists and returns a dict of lists, of any length, with the columns of ``schema``.
    """
    ship(df.sparkSession)
    struct = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = f({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[x.name], type=x.type) for x in out], schema=out)
        rest = getattr(f, "rest", None)
        if rest is not None and (got := rest()) is not None:
            yield pa.RecordBatch.from_arrays([pa.array(got[x.name], type=x.type) for x in out], schema=out)

    return df.mapInArrow(run, struct)
