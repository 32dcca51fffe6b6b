"""Columns of the input whose names the operators use themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantspark.llm import packing, substrings


def test_substrings_keep_all_columns(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"a {passage} b"), (2, f"c {passage} d"), (3, None)], "doc_id long, text string")
    named = df.withColumns({c: F.lit(f"{c}!") for c in ("key", "_body", "_packed", "_marks", "_0", "row")})
    got = {r.doc_id: r for r in substrings.dedup_substrings(named).collect()}
    assert {d: (r.n_removed, r.kept) for d, r in got.items()} == {1: (40, "a b"), 2: (40, "c d"), 3: (0, None)}
    assert all(r[c] == f"{c}!" for r in got.values() for c in ("key", "_body", "_packed", "_marks", "_0", "row"))


def test_packing_keeps_all_columns(spark):
    df = spark.createDataFrame([(i, 1 + i % 7) for i in range(100)], "doc_id long, length long")
    named = df.withColumns({c: F.lit(f"{c}!") for c in ("_task", "_number", "_first", "_place", "c0", "sequence_id", "offset")})
    rows = packing.pack(named, 16).collect()
    assert len(rows) == 100 and all(r[c] == f"{c}!" for r in rows for c in ("_task", "_number", "_first", "_place", "c0"))
    seen = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(seen, seen[1:])) and max(o + n for _, o, n in seen) <= 16
