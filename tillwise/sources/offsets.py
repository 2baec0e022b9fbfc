"""A stream over a table of Parquet files that admits rows by their position.

    spark.dataSource.register(RowOffsets)
    spark.readStream.format("row_offsets").schema("..., row_no long, batch_no long")
        .option("path", folder).option("rows_per_batch", 800).load()

Offsets are row positions: files in order of name, rows in order within the file. ``row_no``
is the position and ``batch_no`` the position divided by ``rows_per_batch``, so a single
micro-batch can carry any number of logical batches, and their statistics come from one
job. Nothing is staged: tasks read their rows from the files themselves.

Files may be added, with names that sort after the ones there. Logical batches are admitted
whole; with ``flush`` (the default) the rows left over at the end are a last, shorter one.
The folder must be on a file system that pyarrow opens by its address.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Rows that one task reads.
PART_ROWS = 1_000_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        path = "file://" + path
    elif path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class RowPart(InputPartition):
    def __init__(self, file: str, skip: int, rows: int, first: int):
        self.file, self.skip, self.rows, self.first = file, skip, rows, first


class RowOffsetReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path = options["path"]
        self.size = int(options.get("rows_per_batch", "800"))
        self.flush = options.get("flush", "true").lower() == "true"
        self.part_rows = int(options.get("part_rows", str(PART_ROWS)))
        self.columns = [f.name for f in schema]
        self.schema = schema
        self.known: dict[str, int] = {}

    def _files(self) -> list[tuple[str, int]]:
        """Files and their rows; the footer of a file is read once."""
        system, folder = _opened(self.path)
        found = system.get_file_info(fs.FileSelector(folder, recursive=False))
        names = sorted(f.path for f in found if f.path.endswith(".parquet"))
        for name in names:
            if name not in self.known:
                self.known[name] = pq.read_metadata(name, filesystem=system).num_rows
        return [(name, self.known[name]) for name in names]

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        rows = sum(n for _, n in self._files())
        return {"row": rows if self.flush else rows - rows % self.size}

    def partitions(self, start: dict, end: dict) -> list[RowPart]:
        parts, first = [], 0
        for name, rows in self._files():
            low, high = max(start["row"], first), min(end["row"], first + rows)
            for at in range(low, high, self.part_rows):
                parts.append(RowPart(name, at - first, min(self.part_rows, high - at), at))
            first += rows
        return parts

    def read(self, partition: RowPart) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        system, _ = _opened(self.path)
        with pq.ParquetFile(partition.file, filesystem=system) as file:
            skip, left, at = partition.skip, partition.rows, partition.first
            stored = [c for c in self.columns if c not in ("row_no", "batch_no")]
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if skip >= rows:
                    skip -= rows
                    continue
                for batch in file.iter_batches(10_000, [group], stored):
                    if skip >= batch.num_rows:
                        skip -= batch.num_rows
                        continue
                    batch, skip = batch.slice(skip, left), 0
                    at += batch.num_rows
                    left -= batch.num_rows
                    numbers = np.arange(at - batch.num_rows, at)
                    made = {"row_no": pa.array(numbers), "batch_no": pa.array(numbers // self.size)}
                    yield pa.RecordBatch.from_arrays(
                        [
                            made[f.name] if f.name in made else batch.column(f.name).cast(f.type)
                            for f in wanted
                        ],
                        schema=wanted,
                    )
                    if not left:
                        return


class RowOffsets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_offsets"

    def streamReader(self, schema: T.StructType) -> RowOffsetReader:
        return RowOffsetReader(dict(self.options), schema)


def stream_rows(
    spark: SparkSession, path: str, schema: T.StructType, rows_per_batch: int, flush: bool = True
) -> DataFrame:
    """The rows of a Parquet folder as a stream, with ``row_no`` and ``batch_no``."""
    spark.dataSource.register(RowOffsets)
    whole = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in schema],
        T.StructField("row_no", T.LongType()), T.StructField("batch_no", T.LongType()),
    ])
    return (
        spark.readStream.format("row_offsets").schema(whole)
        .option("path", path).option("rows_per_batch", rows_per_batch).option("flush", str(flush).lower())
        .load()
    )


def folder_of(df: DataFrame) -> str:
    """The folder of a frame that scans one written table, all its files in one folder."""
    folders = {f.rsplit("/", 1)[0] for f in df.select(F.lit(1)).inputFiles()}
    if len(folders) != 1:
        raise ValueError(f"not one written table: {sorted(folders)}")
    return folders.pop()
