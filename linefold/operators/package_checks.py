"""Checks of document packages as a table of violations (check, key, detail)."""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the package format: parts, reference attributes with the element that defines them, and the widest formula.
SECTION, HEADER, MANIFEST, MEDIA = "section0.xml", "header.xml", "content.hpf", "BinData/"
REFERENCES = {"charPrIDRef": "hh:charPr", "paraPrIDRef": "hh:paraPr", "borderFillIDRef": "hh:borderFill"}
WIDEST = 20268


@F.pandas_udf(T.BooleanType())
def _parses(xml: pd.Series) -> pd.Series:
    def one(x) -> bool:
        try:
            ElementTree.fromstring(x)
            return True
        except (ElementTree.ParseError, TypeError):
            return False

    return xml.map(one)


def _all(text: str, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))


def checks(parts: DataFrame) -> DataFrame:
    """Violations in packages given as (path, part, content); a file that is no package breaks the first check."""
    body = F.decode("content", "utf-8")
    own = lambda name: F.max(F.when(F.endswith("part", F.lit(name)), body))
    one = parts.groupBy("path").agg(own(SECTION).alias("sec"), own(HEADER).alias("hdr"), own(MANIFEST).alias("hpf"), F.count_if(F.contains("part", F.lit(MEDIA))).alias("media"))
    pictures, tables = F.size(_all("sec", r"(<hp:pic[ >])")), F.size(_all("sec", r"(<hp:tbl[ >])"))
    manifest = _all("hpf", r'<opf:item id="([^"]+)"')
    loose = F.filter(_all("sec", r'binaryItemIDRef="([^"]+)"'), lambda r: ~F.exists(manifest, lambda m: F.contains(m, r)))
    empty = F.size(F.filter(_all("sec", r"(?s)<hp:script>(.*?)</hp:script>"), lambda x: F.trim(x) == ""))
    wide = F.filter(F.transform(_all("sec", r'<hp:equation[^>]*>\s*<hp:sz width="(\d+)"'), lambda x: x.cast("long")), lambda x: x > WIDEST)
    inline = F.size(_all("sec", r'(?s)(<hp:pic[^>]*>(?:(?!</hp:pic>).)*?treatAsChar="1")'))
    found = [F.when(~_parses(x), F.struct(F.lit("broken xml").alias("check"), F.lit(name).alias("detail"))) for x, name in (("sec", SECTION), ("hdr", HEADER), ("hpf", MANIFEST))]
    broken = lambda when, name, detail: F.when(when, F.struct(F.lit(name).alias("check"), detail.cast("string").alias("detail")))
    for ref, element in REFERENCES.items():
        missing = F.array_sort(F.array_except(_all("sec", rf'{ref}="(\d+)"'), _all("hdr", rf'<{element} id="(\d+)"')))
        found.append(broken(F.size(missing) > 0, f"undefined {ref}", F.array_join(missing, ",")))
    found += [
        broken(pictures != F.col("media"), "pictures differ from media", F.concat_ws(" / ", pictures, "media")),
        broken(F.size(loose) > 0, "picture not in manifest", F.array_join(loose, ",")),
        broken(F.contains("sec", F.lit("linesegarray")), "line coordinates", F.lit("linesegarray")),
        broken(~F.array_contains(_all("sec", r'colCount="(\d+)"'), "2") & (tables == 0), "no layout", F.lit("neither two columns nor a table")),
        broken(empty > 0, "empty formula", empty),
        broken(F.size(wide) > 0, "formula wider than the column", F.array_max(wide)),
        broken(inline > 0, "picture in the text flow", inline),
    ]
    rows = one.select("path", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x"))
    return rows.select("x.check", F.col("path").alias("key"), "x.detail")
