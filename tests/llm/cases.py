"""Small tables with every awkward case, and helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int, parts=("the", "and", "er", "tion", "th", "ing", "on", "re", "wh", "st")) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows() -> list[tuple]:
    shared = prose(80, 1)
    long = prose(6000, 2)
    texts = [
        None, "", " \t\n\x0b ", "one", "A b", shared, shared, prose(30, 3) + "\n" + shared + " " + prose(40, 4), prose(20, 5) + " " + shared,
        long, long + " tail", "x" * 9000, "same " * 300, "naïve Ünïcödé 東京 ñandú ß " * 12, "a b\x1cc  d \n\n e", "!!! ??? 123 ###", "it's we'll <|endoftext|> ok",
        prose(400, 6), prose(400, 6).replace("the", "The", 1), "line\nline\nline\n" * 30, " " * 5000 + "z",
    ]
    out = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out.append(out[7])  # a repeated row
    out.append((None, "no id " + shared, "en", None, 5))
    out.append((None, None, None, None, None))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df):
    """Further columns named like those the operators add."""
    from pyspark.sql import functions as F

    for name in ("ids", "fingerprint", "length", "offset", "sequence_id", "piece", "score", "lang_pred", "tox_score", "spans", "n_words", "key", "row", "words", "kept", "digest", "shard"):
        df = df.withColumn(name, F.lit("clash"))
    return df
