"""Zip packages as a Spark data source, their writer, and what their members say about their kind.

The source lists the packages below a folder and deals them by bytes: small ones
together, a large one as several ranges, each of which reads the members that
begin in it.  A task reads a package's directory first and then only the members
that the query's filter on ``part`` leaves.  Folders are opened by pyarrow, so any
store that it knows will do.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

SCHEMA = "path string, place int, part string, size long, content binary"
#: Bytes of packages that a task takes.
TASK_BYTES = 64 << 20


@dataclass
class Ranges(InputPartition):
    """(path, first byte, end) of the packages of a task."""

    items: list[tuple[str, int, int]]


#: What a pushed filter on ``part`` asks of a member's name.
TESTS = {
    EqualTo: lambda name, value: name == value,
    In: lambda name, value: name in value,
    StringStartsWith: lambda name, value: name.startswith(value),
    StringEndsWith: lambda name, value: name.endswith(value),
    StringContains: lambda name, value: value in name,
}


class PackageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ending = options["path"], options.get("ending", ".zip")
        self.task_bytes, self.content = int(options.get("task_bytes", TASK_BYTES)), options.get("content", "true") == "true"
        self.tests: list[tuple[type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in TESTS and f.attribute == ("part",):
                self.tests.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Ranges]:
        files, root = fs.FileSystem.from_uri(self.path)
        found = [x for x in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if x.is_file and x.path.endswith(self.ending)]
        out, held = [], 0
        for x in sorted(found, key=lambda x: x.path):
            for begin in range(0, max(1, x.size), self.task_bytes):
                end = min(x.size, begin + self.task_bytes) if begin + self.task_bytes < x.size else max(x.size, 1)
                if not out or held + end - begin > self.task_bytes:
                    out.append(Ranges([]))
                    held = 0
                out[-1].items.append((x.path, begin, end))
                held += end - begin
        return out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[tuple]:
        files, _ = fs.FileSystem.from_uri(self.path)
        for path, begin, end in partition.items:
            with files.open_input_file(path) as f:
                try:
                    package = zipfile.ZipFile(f)
                except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter from a seek before the first byte
                    if not self.tests and begin == 0:
                        yield path, None, None, None, None
                    continue
                for place, m in enumerate(package.infolist()):
                    if begin <= m.header_offset < end and not m.is_dir() and all(TESTS[kind](m.filename, value) for kind, value in self.tests):
                        yield path, place, m.filename, m.file_size, package.read(m) if self.content else None


class PackageSource(DataSource):
    """``spark.read.format("packages")``; options path, ending, task_bytes and content (false: directories alone are read)."""

    @classmethod
    def name(cls) -> str:
        return "packages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PackageReader:
        return PackageReader(self.options)


def packages(spark: SparkSession, path: str, ending: str = ".zip", content: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """path, place, part, size, content of the members of all packages below ``path``; a file that is no package is one row with a null part."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackageSource)
    return spark.read.format("packages").options(path=path, ending=ending, content=str(content).lower(), task_bytes=str(task_bytes)).load()


def write_packages(members: DataFrame, folder: str) -> DataFrame:
    """Writes one package for each ``package`` of (package, place, part, content), in the order of place; returns package and bytes.

    A package is written under its own name by whichever task has it last, so a
    repeated task leaves the same file.
    """

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"{root}/{key[0].as_py()}.zip"
        with files.open_output_stream(name + ".part") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for row in rows.sort_by([("place", "ascending"), ("part", "ascending")]).select(["part", "content"]).to_pylist():
                z.writestr(zipfile.ZipInfo(row["part"]), row["content"] or b"", zipfile.ZIP_DEFLATED)
        files.move(name + ".part", name)
        return pa.table({"package": pa.array([key[0].as_py()], pa.string()), "bytes": pa.array([files.get_file_info(name).size], pa.int64())})

    rows = members.select(F.col("package").cast("string").alias("package"), "place", "part", "content")
    return rows.groupBy("package").applyInArrow(write, "package string, bytes long")


# Endings of images, and the members that tell a kind, in the order in which they decide.
IMAGE = r"(?i)\.(jpg|jpeg|png|webp|bmp|gif|tif)$"
TELLING = [("word/document.xml", "docx"), ("ppt/presentation.xml", "pptx"), ("xl/workbook.xml", "xlsx")]
LOOKED_AT = 400


def package_kinds(parts: DataFrame) -> DataFrame:
    """path, kind and number of images of packages given as (path, place, part), by the names of their members."""
    early = F.col("place") < LOOKED_AT
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    holds = lambda text: any_(early & F.contains("part", F.lit(text)))
    images, n = F.count_if(F.col("part").rlike(IMAGE)), F.count("part")
    kind = F.when(n == 0, "error")
    kind = kind.when(holds("Contents/section0.xml"), "hwpx").when(any_(F.col("part") == "mimetype") & any_((F.col("place") < 5) & F.contains("part", F.lit("hwp"))), "hwpx")
    kind = kind.when(any_(F.startswith("part", F.lit("Contents/"))) & (holds("settings.xml") | holds("version.xml")), "hwpx")
    for text, name in TELLING:
        kind = kind.when(holds(text), name)
    many = (images > 0) & (images >= F.greatest(F.lit(1.0), 0.5 * n))
    one = parts.groupBy("path").agg(kind.when(many, "zip_images").otherwise("zip_other").alias("kind"), images.alias("images"))
    return one.select("path", "kind", F.when(F.col("kind") == "zip_images", F.col("images")).otherwise(0).alias("images"))
