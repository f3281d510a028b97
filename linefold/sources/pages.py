"""Readers of page JSON and of file trees."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = """array<struct<page: int, page_idx: int, page_width: double, image_width: double, width: double, page_height: double, image_height: double, height: double,
lines: array<struct<id: string, parent_id: string, type: string, subtype: string, text: string, text_display: string,
region: struct<top_left_x: double, top_left_y: double, width: double, height: double>, font_size: double, `column`: int, line: int, conversion_output: boolean, confidence: double>>>>"""


def _pages(value, place: int | None = None) -> Iterator[dict]:
    """Every object with a non-empty list of line objects, at any depth, with its page number or its place in the list."""
    if isinstance(value, list):
        for i, x in enumerate(value, 1):
            yield from _pages(x, i)
    elif isinstance(value, dict):
        lines = value.get("lines")
        if isinstance(lines, list) and lines and all(isinstance(x, dict) for x in lines):
            number = next((value[k] for k in ("page", "page_idx") if isinstance(value.get(k), int)), place)
            yield value | {"page": number}
        else:
            for x in value.values():
                yield from _pages(x, place)


def read_lines(spark: SparkSession, path: str, name_contains: list[str] | None = None) -> DataFrame:
    """Lines of all files below ``path`` (a folder a file), in the extractor's schema.

    The nesting of pages differs between files, so one small walk per file finds
    the pages; all else is typed by ``from_json``.  Names are filtered before any file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -2))
    if name_contains:
        files = files.where(F.exists(F.array(*[F.lit(x) for x in name_contains]), lambda x: F.contains(F.col("file"), x)))

    def walk(frames):
        for f in frames:
            yield pd.DataFrame({"file": f["file"], "body": [json.dumps(list(_pages(json.loads(c)))) for c in f["content"]]})

    pages = files.select("file", "content").mapInPandas(walk, "file string, body string").select("file", F.posexplode(F.from_json("body", PAGE)).alias("p", "page"))
    size = lambda what: F.coalesce(*[F.nullif(F.col(f"page.{k}"), F.lit(0.0)) for k in (f"page_{what}", f"image_{what}", what)])
    one = pages.select("file", "p", F.col("page.page").alias("page"), size("width").alias("page_width"), size("height").alias("page_height"), F.posexplode("page.lines").alias("k", "l"))
    return one.select("file", "page", "page_width", "page_height", (F.col("p").cast("long") * 1_000_000 + F.col("k")).alias("ord"), "l.*")


def read_packages(spark: SparkSession, path: str, ending: str = "*.zip") -> DataFrame:
    """path, part, content of the members of all zip packages below ``path``; a file that is no package gives one row with a null part."""

    def parts(frames):
        for f in frames:
            rows = []
            for name, body in zip(f["path"], f["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(body)) as z:
                        rows += [(name, m.filename, z.read(m)) for m in z.infolist() if not m.is_dir()]
                except zipfile.BadZipFile:
                    rows.append((name, None, None))
            yield pd.DataFrame(rows, columns=["path", "part", "content"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ending).load(path)
    return files.select("path", "content").mapInPandas(parts, "path string, part string, content binary")


# First bytes of file kinds.
MAGIC = [(b"%PDF", "pdf"), (b"PK\x03\x04", "zip"), (b"\x89PNG", "png"), (b"\xff\xd8\xff", "jpg"), (b"GIF8", "gif"), (b"\xd0\xcf\x11\xe0", "ole")]


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, name, folder, ext, kind, size_mb, sha256 of every file of a tree; Spark's file scan leaves empty files out."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    kind = F.coalesce(*[F.when(F.substring("content", 1, len(m)) == F.lit(m), k) for m, k in MAGIC], F.lit("other"))
    name = F.element_at(F.split("path", "/"), -1)
    return f.select(
        "path",
        name.alias("name"),
        F.element_at(F.split("path", "/"), -2).alias("folder"),
        F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("ext"),
        kind.alias("kind"),
        F.round(F.col("length") / 1e6, 2).alias("size_mb"),
        F.sha2("content", 256).alias("sha256"),
    )


def duplicate_files(files: DataFrame) -> DataFrame:
    return files.groupBy("sha256").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths")).where("n > 1")
