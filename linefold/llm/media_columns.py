"""Media columns over content-addressed payloads in tar shards.

``store`` turns each text into an 8-bit greyscale PNG, ``SAMPLE_ROW`` samples
wide (UTF-8 bytes, padded with blanks to a positive multiple of that), and
appends it to its task's tar shard under the SHA-256 of the payload; a shard
holds a payload once.  The table of rows carries digest, shard, offset and
length and is committed after the shards are closed, so that a retried task
leaves at most shards that nothing refers to.  A digest that several tasks
stored is read from the smallest (shard, offset).

``located`` gives one place for each digest.  There ``header_columns`` fills
width, height and sample bits from the first bytes of each stored image alone,
by ranges, and ``read_back`` reads the whole images, decodes them and computes
features; the two can follow each other without a shuffle.  Copies of a payload
in the shards of other tasks stay there unused: one shard place for each digest
would take a shuffle of all texts before writing.  Digests are 32 bytes until
they are shown.  All files lie in the shared folder and are reached with
``pyarrow.fs``, so any store that it knows will do.

Null and empty texts are one row of blanks.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from linefold.llm.common import shared_dir, slices, texts_of

SAMPLE_ROW = 192
SHARD_BYTES = 256 << 20
HEADER_BYTES = 33  # signature and image header
#: Bytes of a shard that one reading task takes, about.
READ_BYTES = 16 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // SAMPLE_ROW)) * SAMPLE_ROW), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, SAMPLE_ROW)
    body = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], 1).tobytes()  # each row unfiltered
    head = struct.pack(">IIBBBBB", SAMPLE_ROW, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(body, 6)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int]:
    """Width, height and sample bits from the first ``HEADER_BYTES``."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", data[16:25])


def samples(data: bytes) -> bytes:
    """The samples of an unfiltered greyscale PNG; every chunk's checksum is verified."""
    width, height, _ = header(data)
    at, body = 8, b""
    while at < len(data):
        n = struct.unpack(">I", data[at : at + 4])[0]
        kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + part) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged chunk")
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Size, mean sample, and a 64-bit hash: which of 8 x 8 fields are lighter than the mean."""
    x = np.frombuffer(payload, np.uint8).reshape(-1, SAMPLE_ROW).astype(np.float64)
    rows = np.arange(8) * len(x) // 8
    bands = np.stack([x[r : max(r + 1, (k + 1) * len(x) // 8)].mean(0) for k, r in enumerate(rows)])
    fields = bands.reshape(8, 8, -1).mean(2)
    bits = (fields > x.mean()).ravel()
    return f"{SAMPLE_ROW}x{len(x)}:{x.mean():.4f}:{int(''.join('1' if b else '0' for b in bits), 2):016x}"


class _Shard:
    def __init__(self, fs, folder: str):
        self.path, self.size, self.places = f"{folder}/{uuid.uuid4().hex}.tar", 0, {}
        self.out = fs.open_output_stream(self.path)

    def put(self, digest: bytes, payload: bytes) -> tuple[int, int]:
        if digest not in self.places:
            data = png(payload)
            info = tarfile.TarInfo(f"{digest.hex()}.png")
            info.size = len(data)
            self.places[digest] = (self.size + 512, len(data))
            block = info.tobuf(tarfile.USTAR_FORMAT) + data + b"\0" * (-len(data) % 512)
            self.out.write(block)
            self.size += len(block)
        return self.places[digest]

    def close(self):
        self.out.write(b"\0" * 1024)
        self.out.close()


def store(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Write the shards and the table of rows: id, n_bytes, payload_bytes, digest, shard, offset, length."""
    spark = docs.sparkSession
    base = shared_dir(spark, "media")
    names = [id_col, "n_bytes", "payload_bytes", "digest", "shard", "offset", "length"]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        fs, folder = pafs.FileSystem.from_uri(f"{base}/shards")
        fs.create_dir(folder, recursive=True)
        shard = None
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for t in texts_of(part):
                    payload, n = payload_of(t)
                    digest = hashlib.sha256(payload).digest()
                    if shard and shard.size > SHARD_BYTES:
                        shard.close()
                        shard = None
                    shard = shard or _Shard(fs, folder)
                    rows.append((n, len(payload), digest, shard.path.rsplit("/", 1)[1], *shard.put(digest, payload)))
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(id_col)] + [pa.array(c, k) for c, k in zip(cols, kinds)], names)
        if shard:
            shard.close()

    out = docs.select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, payload_bytes long, digest binary, shard string, offset long, length long")
    out.write.parquet(f"{base}/rows")
    return spark.read.schema(out.schema).parquet(f"{base}/rows").withColumn("folder", F.lit(f"{base}/shards"))


def places(rows: DataFrame) -> DataFrame:
    """One place for each digest: the smallest (shard, offset)."""
    return rows.groupBy("folder", "digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("folder", "digest", "at.*")


def located(rows: DataFrame) -> DataFrame:
    """The places in stretches of shards dealt over the tasks, each to be read from front to back."""
    return places(rows).repartition("shard", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("shard", "offset")


def _ranged(at: DataFrame, new: str, fn) -> DataFrame:
    """Append the columns ``new``, which ``fn(file, offset, length)`` takes from each stored image; rows stay where they are."""
    fresh = T._parse_datatype_string(new)
    kinds = [to_arrow_type(f.dataType) for f in fresh]
    schema = T.StructType([*at.schema, *fresh])

    def run(batches):
        handle, opened = None, None
        for b in batches:
            rows = []
            for folder, shard, offset, length in zip(*(b.column(c).to_pylist() for c in ("folder", "shard", "offset", "length"))):
                if opened != (folder, shard):
                    if handle:
                        handle.close()
                    fs, path = pafs.FileSystem.from_uri(f"{folder}/{shard}")
                    handle, opened = fs.open_input_file(path), (folder, shard)
                rows.append(fn(handle, offset, length))
            cols = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, k) for c, k in zip(cols, kinds)]], schema.names)
        if handle:
            handle.close()

    return at.mapInArrow(run, schema)


def header_columns(at: DataFrame) -> DataFrame:
    """Append width, height and sample_bits to ``located`` rows, from ranged reads of the headers alone."""
    return _ranged(at, "width int, height int, sample_bits int", lambda f, offset, length: header(f.read_at(HEADER_BYTES, offset)))


def read_back(at: DataFrame) -> DataFrame:
    """Append to ``located`` rows what the stored bytes give: payload_sha256 (binary), tail_crc32, media_bytes, media_sha256 (binary), feature."""

    def one(f, offset, length):
        data = f.read_at(length, offset)
        payload = samples(data)
        return hashlib.sha256(payload).digest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).digest(), feature(payload)

    return _ranged(at, "payload_sha256 binary, tail_crc32 long, media_bytes long, media_sha256 binary, feature string", one)
