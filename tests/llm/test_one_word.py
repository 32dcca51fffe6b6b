"""The rule against one word that makes up more than half of a document (operator 4)."""

from __future__ import annotations

from grantspark.llm import langid, quality
from grantspark.llm.common import ORACLES, QUERIES

from .cases import frame


def test_majority_word_behind_other_words(spark):
    title = [f"title{i}" for i in range(8)]
    body = [w for i in range(40) for w in ("again", "again", f"other{i}")]
    # exactly half of 80 is not more than half
    half = [w for i in range(40) for w in ("again", f"{'other' if i % 2 else 'thing'}{i}")]
    texts = [" ".join(title + body), " ".join(body), " ".join(half), " ".join(half[1:] + ["again", "again"]), "", None]
    got = {r.doc_id: r.rejected_by for r in quality.judged(frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])).collect()}
    assert got == {0: "one_word", 1: "one_word", 2: None, 3: "one_word", 4: "base", 5: "base"}


def test_sql_counts_every_word(spark, tmp_path):
    """The check SQL finds a majority word that stands behind others, too."""
    import duckdb

    title, body = [f"title{i}" for i in range(8)], [w for i in range(40) for w in ("again", "again", f"other{i}")]
    data = [(1, " ".join(title + body), "en", "s", 1), (2, " ".join(f"word{i}" for i in range(90)), "en", "s", 1), (3, None, "en", "s", 1)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(ORACLES["op4_quality"])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    want = {r[at["doc_id"]]: r[at["kept"]] for r in cursor.fetchall()}
    assert want == {1: False, 2: True, 3: False}
    assert {r.doc_id: r.kept for r in QUERIES["op4_quality"](spark, str(tmp_path)).collect()} == want


def test_signs_are_no_letters():
    assert langid.words_of("½ ² Ⅷ 12") == [] and langid.words_of("a½b çÉ") == ["a", "b", "çé"]
