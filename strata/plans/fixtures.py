"""Writers of input files in the producers' formats (test landings only)."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of this package


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one JSON array, an element each; nothing for no elements."""
    begun = False
    for batch in batches:
        texts = batch.column("j").to_pylist()
        if texts:
            lines = ["," + x for x in texts]
            if not begun:
                lines[0] = "[" + texts[0]
            begun = True
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], names=["value"])


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 10000) -> None:
    """Files that each hold one JSON array of about ``rows_per_file`` objects.

    Rows are dealt to files by a hash of their text; a task writes its array line by line, so it holds a
    batch of rows and never an array.
    """
    full = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    texts = df.select(F.to_json(F.struct(*df.columns), full).alias("j"))
    n = max(1, -(-texts.count() // rows_per_file))
    texts.repartition(n, "j").mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)
