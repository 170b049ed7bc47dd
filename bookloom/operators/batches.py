"""Packing a sequence of small chunks into batches, in order and exactly, without one task for the sequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bookloom.session import materialize


def _walk(sizes: list[int], full: int, filled: int) -> tuple[list[int], int, int]:
    """(batches closed before each chunk, batches closed in all, what the open batch holds) from an open batch that holds ``filled``."""
    before, closed = [], 0
    for size in sizes:
        if filled and filled + size > full:
            closed, filled = closed + 1, 0
        before.append(closed)
        filled += size
        if filled >= full:
            closed, filled = closed + 1, 0
    return before, closed, filled


def next_fit(chunks: DataFrame, order: list[Column], size: str, full: int, out: str = "batch") -> DataFrame:
    """``chunks`` with the number, from 1, of the batch each falls into when they are taken in order.

    A batch is closed before a chunk that would take it above ``full``, and when
    it holds ``full``.  ``order`` must be total; sizes are positive.  What comes
    before a range of chunks matters to it only by what the open batch holds,
    which is one of ``full`` numbers; so every range is walked for each of them
    at once, the ranges are then put together by a table of ``full`` rows a
    range, and no task sees more than its range.
    """
    n = max(2, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = materialize(chunks.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id().cast("long")), "chunks")
    fields = [f for f in rows.schema.fields if f.name != "_part"]

    def outcomes(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.sort_values("_place")["_size"].tolist()
        made = [(int(pdf["_part"].iloc[0]), filled, *_walk(sizes, full, filled)[1:]) for filled in range(full)]
        return pd.DataFrame(made, columns=["part", "filled", "closed", "left"])

    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).withColumn("_size", F.col(size).cast("long"))
    ends = placed.select("_part", "_place", "_size").groupBy("_part").applyInPandas(outcomes, "part long, filled long, closed long, left long").toPandas()
    start: dict[int, tuple[int, int]] = {}
    closed = filled = 0
    table = {(int(p), int(f)): (int(c), int(x)) for p, f, c, x in ends.itertuples(index=False)}
    for part in sorted({p for p, _ in table}):
        start[part] = (closed, filled)
        more, filled = table[part, filled]
        closed += more

    def numbered(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        done, held = start[int(pdf["_part"].iloc[0])]
        before = _walk(pdf["_size"].tolist(), full, held)[0]
        return pdf.assign(**{out: [done + b + 1 for b in before]})[[*(f.name for f in fields), out]]

    return placed.groupBy("_part").applyInPandas(numbered, StructType([*fields, StructField(out, LongType())]))
