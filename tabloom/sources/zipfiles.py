"""CSV members of zip archives as a Spark data source.

Zip is not a codec of Spark's readers.  ``spark.read.format("tabloom_zip")``
reads the central directory of each archive and makes one partition per
member, so a large archive is read by many tasks; a member is decompressed as
a stream and handed on in Arrow batches of ``BATCH`` rows.  The schema is given
by the user and cast by Arrow; with ``columns`` only these are parsed into
values.  Archives must be reachable by ``open`` under the same path on the
driver and all executors (a shared mount); use Spark's own readers on gzip
files elsewhere.
"""
from __future__ import annotations

import glob
import io
import os
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "tabloom_zip"
#: Bytes of CSV parsed at a time.
BLOCK_BYTES = 4 << 20


def _local(path: str) -> str:
    return path[len("file:"):].replace("///", "/", 1) if path.startswith("file:") else path


@dataclass
class Member(InputPartition):
    archive: str
    name: str


class ZipReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path = _local(options["path"])
        self.suffix = options.get("suffix", ".csv")
        self.header = options.get("header", "true").lower() == "true"
        #: Columns as they stand in the files; the schema may ask for some of them, in any order.
        self.names = [c for c in options.get("names", "").split(",") if c] or [f.name for f in schema.fields]

    def partitions(self) -> list[Member]:
        archives = sorted(glob.glob(os.path.join(self.path, "*.zip"))) if os.path.isdir(self.path) else [self.path]
        return [Member(a, i.filename) for a in archives for i in zipfile.ZipFile(a).infolist() if not i.is_dir() and i.filename.endswith(self.suffix)]

    def read(self, partition: Member) -> Iterator:
        import pyarrow as pa
        from pyarrow import csv
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        with zipfile.ZipFile(partition.archive) as z, z.open(partition.name) as raw:
            try:
                batches = csv.open_csv(
                    io.BufferedReader(raw), read_options=csv.ReadOptions(block_size=BLOCK_BYTES, skip_rows=int(self.header), column_names=self.names),
                    parse_options=csv.ParseOptions(newlines_in_values=True),
                    convert_options=csv.ConvertOptions(column_types={f.name: f.type for f in want}, include_columns=want.names, strings_can_be_null=True, quoted_strings_can_be_null=False))
            except pa.ArrowInvalid as e:
                if "Empty CSV" in str(e):
                    return
                raise
            yield from batches


class ZipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give a schema: it is never guessed from the files")

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(schema, self.options)


def read_zip(spark: SparkSession, path: str, schema: StructType | str, columns=None, header: bool = True, suffix: str = ".csv") -> DataFrame:
    """CSV members of the archive ``path`` (or of all archives in that folder); only ``columns`` are converted when given."""
    full = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    narrow = StructType([full[c] for c in columns]) if columns else full
    spark.dataSource.register(ZipSource)
    r = spark.read.format(FORMAT).schema(narrow).option("names", ",".join(full.names)).option("header", str(header).lower()).option("suffix", suffix)
    return r.load(path)


def write_zip(df: DataFrame, folder: str, header: bool = True) -> None:
    """One archive per partition under ``folder`` (a shared mount), with one CSV member each; rows are written as they stream."""
    names = df.columns
    local = _local(folder)

    def archive(batches: Iterator) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        os.makedirs(local, exist_ok=True)
        # written aside and renamed, so a repeated task never leaves half an archive
        half = os.path.join(local, f".part-{part:05d}-{TaskContext.get().taskAttemptId()}")
        with zipfile.ZipFile(half, "w", zipfile.ZIP_DEFLATED) as z, z.open(f"part-{part:05d}.csv", "w", force_zip64=True) as out:
            if header:
                out.write((",".join(names) + "\n").encode())
            rows = 0
            for b in batches:
                rows += len(b)
                out.write(b.to_csv(index=False, header=False).encode())
        os.replace(half, os.path.join(local, f"part-{part:05d}.zip"))
        yield pd.DataFrame({"rows": [rows]})

    df.mapInPandas(archive, "rows long").agg({"rows": "sum"}).collect()
