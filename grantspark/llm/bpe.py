"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file (operator 8).

``encode`` adds the ids of a text as little-endian unsigned 32-bit integers, ``decode`` turns such ids back into
the raw bytes (which need not be valid UTF-8 for ids of another origin). Long texts are cut at safe boundaries:
places where every match of the pattern that begins before ends, and after which matching does not look back.
So each part is encoded alone with the same ids, and no part makes the regular expression walk a whole book.

A null text encodes as an empty one, null ids decode to no bytes; a text without any safe boundary (one huge word) is
one part. Repeated rows, null ids and further columns of any name do not matter: only the two named columns are read.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import over_texts, query, table, vocabulary_path, worker_state

#: A part is cut at the first safe boundary after so many characters.
PART_CHARS = 1 << 16

#: Safe boundaries: white space after anything else; the last of a run of white space before anything else; a letter
#: or digit beside another class (an apostrophe before letters is none, it may begin a contraction).
SAFE = regex.compile(
    r"(?<=[^\s\x1c-\x1f])(?=[ \t\r\n])|(?<=[ \t\r\n])(?=[ \t\r\n][^\s\x1c-\x1f])|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])"
    r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
)


#: White space so long that the pattern's look-ahead would exhaust the stack; it is handed over as the one match it is.
LONG_SPACE = re.compile(r"[^\S\x1c-\x1f]{2000,}")


def codec(rank_path: str, pattern: str):
    import tiktoken

    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, part_chars: int = PART_CHARS) -> list[str]:
    """Cut a text at safe boundaries; the parts joined are the text."""
    if len(text) <= part_chars:
        return [text]
    find = SAFE.search
    parts, start = [], 0
    while len(text) - start > part_chars:
        cut = find(text, start + part_chars)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    parts.append(text[start:])
    return parts


def encode_text(enc, text: str, part_chars: int = PART_CHARS) -> bytes:
    ids: list[int] = []
    start = 0
    for run in LONG_SPACE.finditer(text):
        # the run is one match, but for a last character that belongs to the word after it
        stop = run.end() if run.end() == len(text) else run.end() - 1
        for part in safe_parts(text[start:run.start()], part_chars):
            ids += enc.encode_ordinary(part)
        ids += enc._encode_single_piece(text[run.start():stop])
        start = stop
    for part in safe_parts(text[start:], part_chars):
        ids += enc.encode_ordinary(part)
    return np.array(ids, dtype="<u4").tobytes()


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           part_chars: int = PART_CHARS) -> DataFrame:
    """(id, ids): the ids of each text as little-endian unsigned 32-bit integers, one row per row."""

    @F.arrow_udf("binary")
    def ids(column: pa.Array) -> pa.Array:
        enc = worker_state(("bpe", rank_path, pattern), lambda: codec(rank_path, pattern))
        return over_texts(lambda run: [encode_text(enc, t, part_chars) for t in run], pa.binary(), column)

    ids = ids.asNondeterministic()  # else a decoder above would run it once more
    return docs.select(F.col(id_col), ids(F.col(text_col)).alias("ids"))


def decode(encoded: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the raw bytes of the ids."""

    @F.arrow_udf("binary")
    def raw(column: pa.Array) -> pa.Array:
        enc = worker_state(("bpe", rank_path, pattern), lambda: codec(rank_path, pattern))
        return pa.array([enc.decode_bytes(np.frombuffer(x.as_buffer(), "<u4").tolist()) if x.is_valid else b"" for x in column], pa.binary())

    return encoded.withColumn("decoded", raw(F.col(ids_col)))


@query("op8_bpe")
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    at = (vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return decode(encode(table(spark, folder, "documents"), *at), *at).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
