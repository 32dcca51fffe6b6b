"""Media columns: content-addressed payloads in tar shards (operator 5).

``write_shards`` stores the media of each row in a tar file per task, a member per distinct digest, and returns an
index row with digest, shard, offset and length. The index is the commit record: shard names are unique to the task
attempt, so a file that a lost attempt left is named by no row. ``locate`` picks one place per digest among those that
several tasks stored. ``probe`` fills metadata columns by reading a member's header bytes only; ``read_media`` reads whole
members back in shard order. Files go through ``pyarrow.fs`` below the shared folder, at any address it knows.

Here the media of a text is a lossless 8-bit grey PNG, 64 samples wide, of its UTF-8 bytes and zeros up to a positive
multiple of 64. A null text is an empty one (64 zeros). Repeated rows and null ids are kept, equal texts share one
member, an empty table gives no rows and no shard. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, query, shared_dir, table, with_fields

WIDTH = 64
#: Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33

INDEX = "digest string, n_bytes long, shard string, offset long, length long"
METADATA = "width long, height long, bit_depth int, colour_type int"
COMPUTED = "media_sha256 string, payload_sha256 string, tail_crc32 long, feature string"


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, level: int = 1) -> bytes:
    """An 8-bit grey image of WIDTH columns; every row has filter 0."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def header_of(first: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type from the first HEADER_BYTES bytes."""
    if first[:8] != SIGNATURE or first[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIBB", first[16:26])


def decode_png(media: bytes) -> bytes:
    width, height, depth, colour = header_of(media[:HEADER_BYTES])
    if (depth, colour) != (8, 0):
        raise ValueError("only 8-bit grey images are stored")
    at, packed = 8, []
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at:at + 8])
        body = media[at + 8:at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + size:at + 12 + size])[0]:
            raise ValueError("damaged chunk")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered rows are stored")
    return rows[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Average hash: 8 x 8 block means of the image against their mean, as 16 hexadecimal digits."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    columns = image.reshape(len(image), 8, WIDTH // 8).mean(axis=2)
    edges = np.arange(9) * len(columns) // 8
    sums = np.concatenate((np.zeros((1, 8)), np.cumsum(columns, axis=0)))
    spans = np.maximum(edges[1:], edges[:-1] + 1)
    blocks = (sums[spans] - sums[edges[:-1]]) / (spans - edges[:-1])[:, None]
    return np.packbits(blocks.ravel() > blocks.mean()).tobytes().hex()


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, n_bytes, shard, offset, length) per row; to be stored once, as running it writes the shards."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("body"))
    schema = with_fields(T.StructType(list(rows.schema)[:1]), INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out, shard, at, known = None, "", 0, {}
        try:
            for batch in batches:
                found = []
                for body in batch.column(1):
                    text = body.as_buffer().to_pybytes() if body.is_valid else b""
                    payload = payload_of(text)
                    key = hashlib.sha256(payload).digest()
                    if key not in known:
                        media = encode_png(payload)
                        digest = hashlib.sha256(media).hexdigest()
                        if out is None:
                            store.create_dir(root, recursive=True)
                            shard = f"shard-{uuid.uuid4().hex}.tar"
                            out = store.open_output_stream(f"{root}/{shard}")
                        member = tarfile.TarInfo(f"{digest}.png")
                        member.size = len(media)
                        head = member.tobuf(tarfile.USTAR_FORMAT)
                        out.write(head + media + bytes(-len(media) % 512))
                        known[key] = digest, at + len(head), len(media)
                        at += len(head) + len(media) + -len(media) % 512
                    digest, offset, length = known[key]
                    found.append((digest, len(text), shard, offset, length))
                digests, sizes, shards, offsets, lengths = zip(*found) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.array(shards, pa.string()),
                     pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=[id_col, "digest", "n_bytes", "shard", "offset", "length"],
                )
            if out is not None:
                out.write(bytes(1024))
        finally:
            if out is not None:
                out.close()

    return rows.mapInArrow(write, schema)


def locate(index: DataFrame) -> DataFrame:
    """(digest, shard, offset, length): one place per digest, ordered for reading."""
    places = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    return places.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")


def _range_reader(folder: str):
    """read(shard, offset, length); keeps the last shard open."""
    store, root = _open(folder)
    held = ["", None]

    def read(shard: str, offset: int, length: int) -> bytes:
        if held[0] != shard:
            held[:] = shard, store.open_input_file(f"{root}/{shard}")
        got = held[1].read_at(length, offset)
        if len(got) != length:
            raise ValueError(f"{shard} ends before {offset + length}")
        return got

    return read


def _places(batch: pa.RecordBatch):
    return zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "offset", "length")))


def probe(places: DataFrame, folder: str) -> DataFrame:
    """Add the metadata columns from the header bytes of each member."""

    def headers(batches):
        read = _range_reader(folder)
        for batch in batches:
            values = [header_of(read(s, o, HEADER_BYTES)) for s, o, _ in _places(batch)]
            cols = [[v[i] for v in values] for i in range(4)]
            for name, col, kind in zip(("width", "height", "bit_depth", "colour_type"), cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32())):
                batch = batch.append_column(name, pa.array(col, kind))
            yield batch

    return places.mapInArrow(headers, with_fields(places.schema, METADATA))


def read_media(places: DataFrame, folder: str) -> DataFrame:
    """Add what is computed from the stored bytes: the digests of media and payload, and the feature."""

    def features(batches):
        read = _range_reader(folder)
        for batch in batches:
            found = []
            for shard, offset, length in _places(batch):
                media = read(shard, offset, length)
                payload = decode_png(media)
                found.append((hashlib.sha256(media).hexdigest(), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), feature_of(payload)))
            for i, (name, kind) in enumerate((("media_sha256", pa.string()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("feature", pa.string()))):
                batch = batch.append_column(name, pa.array([f[i] for f in found], kind))
            yield batch

    return places.mapInArrow(features, with_fields(places.schema, COMPUTED))


@query("op5_media")
def op5_media(spark: SparkSession, folder: str) -> DataFrame:
    store = f"{shared_dir(spark).rstrip('/')}/media-{uuid.uuid4().hex}"
    index = materialize(write_shards(table(spark, folder, "documents"), store), "media-index")
    stored = read_media(probe(locate(index), store), store).select(
        "digest", (F.col("width") * F.col("height")).alias("payload_bytes"), "payload_sha256", "tail_crc32",
        F.col("length").alias("media_bytes"), "media_sha256", "feature",
    )
    return index.select("doc_id", "n_bytes", "digest").join(stored, "digest").drop("digest")
