"""CSV whose quoted values may hold line breaks, read by many tasks a file.

Whether a line starts inside a quoted value depends on all quotes before it. Each byte range of a file counts its
lines with an odd number of quotes; a running sum over the ranges of a file tells how each range starts; lines are
then joined to records range by range. Only pieces of records that cross a range's end are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.session import ship_package

QUOTE = '"'
PIECES = "file string, block bigint, run bigint, is_header boolean, record string"
RANGE = ["file", "block"]


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, block, is_open, run): does a range start inside a value, and in which range did that record start."""
    n_quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = lines.select(*RANGE, (n_quotes % 2).alias("_odd"))
    per_range = counts.groupBy(*RANGE).agg(F.sum("_odd").alias("n_odd"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_odd").over(earlier), F.lit(0))
    started = per_range.withColumn("is_open", before % 2 == 1).withColumn("is_left_open", (before + F.col("n_odd")) % 2 == 1)
    opens = F.when(F.col("is_left_open") & (F.col("n_odd") > 0), F.col("block"))
    return started.withColumn("run", F.last(opens, ignorenulls=True).over(earlier)).drop("n_odd")


class _Cutter:
    """Joins the lines of a task to records, range after range.

    Gives whole records, or else only the pieces of records that lie in several ranges.
    """

    def __init__(self, whole: bool):
        self.whole = whole

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pending, is_open, run, is_first = None, [], False, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            odd = np.bitwise_and(pc.count_substring(batch.column("value"), QUOTE).to_numpy(zero_copy_only=False), 1)
            edges = [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
            for start, stop in zip([0, *edges], [*edges, len(files)]):
                if at != (files[start], blocks[start]):
                    out += self._rest(at, pending, run, is_first)
                    at, pending = (files[start], blocks[start]), []
                    is_open, is_first = batch.column("is_open")[start].as_py(), blocks[start] == 0
                    run = batch.column("run")[start].as_py() if is_open else None
                state = (np.cumsum(odd[start:stop]) + is_open) % 2
                lines = batch.column("value").slice(start, stop - start).to_pylist()
                done = 0
                for end in np.flatnonzero(state == 0) + 1:
                    pending += lines[done:end]
                    if (run is None) == self.whole:
                        out.append((*at, run, is_first, "\n".join(pending)))
                    pending, run, is_first, done = [], None, False, end
                pending += lines[done:]
                is_open = bool(state[-1])
            yield self._batch(out)
        yield self._batch(self._rest(at, pending, run, is_first))

    def _rest(self, at, pending, run, is_first) -> list[tuple]:
        """What a range leaves open belongs to the record that started there, or before."""
        if self.whole or not pending:
            return []
        return [(*at, at[1] if run is None else run, is_first, "\n".join(pending))]

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        names = ["file", "block", "run", "is_header", "record"]
        columns = zip(*rows, strict=True) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """All values as text, as Spark's own ``multiLine`` reader gives them, without its one task a file.

    One difference: in files whose lines end in \\r\\n that reader turns \\r\\n inside values into \\n; here it stays.

    Files have a header, values may be quoted, quotes in values are doubled, lines end in \\n or \\r\\n; blank lines
    are no records. The text is scanned three times: for the quotes, for whole records, and the ranges that leave a record
    open for its pieces. The table of ranges is broadcast: one row per ``spark.sql.files.maxPartitionBytes`` of input, some 100 MB
    for 100 TB. A file without any line gives no rows; without any header there are no columns.
    """
    schema = spark.read.csv(path, header=True, multiLine=True, escape=QUOTE, inferSchema=False).schema
    if not schema.fields:
        return spark.createDataFrame([], schema)
    ship_package(spark)
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    # Left join: a line whose range is not known would be a fault, never a row to drop.
    known = F.when(F.col("is_open").isNull(), F.raise_error(F.lit("a file changed while it was read"))).otherwise(F.col("is_open"))
    placed = lines.join(F.broadcast(_ranges(lines)), RANGE, "left").withColumn("is_open", known)
    whole = placed.drop("is_left_open").mapInArrow(_Cutter(True), PIECES)
    crossing = placed.where("is_open OR is_left_open").drop("is_left_open").mapInArrow(_Cutter(False), PIECES)
    in_order = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = crossing.groupBy("file", "run").agg(
        F.bool_or("is_header").alias("is_header"), F.array_join(in_order["record"], "\n").alias("record")
    )
    records = whole.select("is_header", "record").unionByName(joined.select("is_header", "record")).where("NOT is_header")
    text = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    options = {"escape": QUOTE, "multiLine": "true"}
    values = F.from_csv(F.col("record"), ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names), options)
    return records.select(text.alias("record")).where("record <> ''").select(values.alias("_row")).select("_row.*")
