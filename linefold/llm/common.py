"""Helpers shared by the training-data operators.

Common rules, unless an operator says otherwise: a null text counts as empty;
one row comes out for each row that goes in, repeated rows included; input
columns that an operator does not use are passed through or left out, and an
output column replaces an input column of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from linefold.session import shared_dir, written  # noqa: F401  the operators' tables lie in the shared folder

#: Characters of text that one step of a text operator holds at a time.
MAX_CHARS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id"):
    """True for the fifth of the documents from which nothing is learnt; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_docs: int) -> DataFrame:
    """(text, y) of at most ``max_docs`` labelled documents that are not held out."""
    y = labels.where(~held_out() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(y), "doc_id").select("text", "y")


def thinned(docs: DataFrame, total: int, max_docs: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """About ``max_docs`` of ``total`` rows, by a hash of id and text; the share has the hash's 64 bits, so that no size makes it nothing."""
    if total <= max_docs:
        return docs
    return docs.where(F.xxhash64(id_col, text) < F.lit(int(2.0**64 * max_docs / total) - 2**63))


def slices(batch: pa.RecordBatch, text: str, max_chars: int = MAX_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``max_chars`` bytes of text; a longer text is a part of its own."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
        if i > start and held + n > max_chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def texts_of(part: pa.RecordBatch, text: str = "text") -> list[str]:
    return [t or "" for t in part.column(text).to_pylist()]


def map_texts(
    df: DataFrame,
    new: str,
    make: Callable[[], Callable[[list[str]], list]],
    text: str = "text",
    keep: list[str] | None = None,
    rows: Callable | None = None,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """Append columns computed from a text column, partition by partition, without a shuffle.

    ``make()`` runs once a task and returns a function from a list of texts
    (null read as "") to one list or Arrow array for each column of ``new``.
    ``keep`` names the input columns that stay (default: all).  With ``rows``,
    that function of a record batch is used instead of the texts alone.
    """
    out_new = T._parse_datatype_string(new)
    fresh = {f.name for f in out_new}
    stay = [f for f in df.schema if f.name not in fresh and (keep is None or f.name in keep)]
    need = list(dict.fromkeys([f.name for f in stay] + [text]))
    kinds = [to_arrow_type(f.dataType) for f in out_new]
    names = [f.name for f in stay] + [f.name for f in out_new]

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, text, max_chars):
                cols = fn(part) if rows else fn(texts_of(part, text))
                made = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in stay] + made, names)

    return df.select(*[F.col(f"`{n}`") for n in need]).mapInArrow(run, T.StructType(stay + list(out_new)))
