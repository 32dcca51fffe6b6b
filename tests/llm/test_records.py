"""Fixity, quotations and the pipeline."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from grantspark.llm import fixity, quotes, simhash, toxicity
from grantspark.llm.common import materialize

from .cases import frame, prose

RECORD = "file long, offset long, hash string"


def replica(spark, data, name):
    return materialize(spark.createDataFrame(data, RECORD), name)


def test_audit_finds_what_differs(spark):
    data = [(f, o * 30_000, hashlib.sha256(f"{f}-{o}".encode()).hexdigest()) for f in (-5, 0, 1, 18, 300) for o in range(60)]
    other = [(f, o, "bad" if (f, o) in ((18, 60_000), (-5, 0)) else h) for f, o, h in data if (f, o) != (300, 59 * 30_000)] + [(7, 0, "new")]
    found = fixity.audit(replica(spark, data, "a"), replica(spark, other, "b"))
    assert Counter(map(tuple, found.collect())) == Counter([(18, 60_000, "corrupt"), (-5, 0, "corrupt"), (300, 59 * 30_000, "missing"), (7, 0, "extra")])
    assert fixity.audit(replica(spark, data, "a"), replica(spark, data[::-1], "b")).count() == 0
    assert fixity.audit(replica(spark, [], "a"), replica(spark, [], "b")).count() == 0
    assert fixity.audit(replica(spark, data[:3], "a"), replica(spark, [], "b")).count() == 3


def test_records_with_nulls_and_repeats(spark):
    pages = spark.createDataFrame([(1, "u", "<p>"), (1, "u", "<p>"), (None, None, None), (2, None, "é"), (1001, "v", "")], "page_id long, url string, html string")
    record = fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    got = {(r[0], bytes(r[1])) for r in pages.select("page_id", record).collect()}
    head = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{}>\r\nWARC-Target-URI: {}\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    assert (2, head.format(2, "", 2, "é").encode()) in got and (None, head.format("-", "", 0, "").encode()) in got
    placed = fixity.with_offsets(
        pages.select(fixity.file_of(F.col("page_id"), F.col("url"), F.col("html")).alias("file"), "page_id", F.octet_length(record).cast("long").alias("length")), "page_id"
    ).collect()
    assert {(r.file, r.page_id) for r in placed if r.file >= 0} == {(0, 1), (0, 2), (1, 1001)}
    zero = sorted((r.offset, r.length) for r in placed if r.file == 0)
    assert [o for o, _ in zero] == [0, zero[0][1], zero[0][1] + zero[1][1]]


def test_quotation_links(spark):
    mail = [
        (1, 0, "user", "Where is the hall?\nSee you"),
        (1, 1, "assistant", "Second street.\n> Where is  the HALL?\n> See you"),
        (1, 2, "user", "Thanks\n>> Where is the hall?\n> Second street."),
        (1, 3, "user", "A reply to the first\n> where is the hall?"),
        (1, 4, "user", "> never written\nown"),
        (2, 0, "user", "Where is the hall?"),
        (2, 5, "user", None),
        (2, 6, "user", ""),
        (None, 0, "user", "x"),
        (1, 3, "user", "A reply to the first\n> where is the hall?"),
    ]
    df = spark.createDataFrame(mail, "conv_id long, turn long, role string, body string").withColumn("depth", F.lit("clash"))
    got = sorted(((r.conv_id, r.turn, r.root, r.depth, r.parent, r.text) for r in quotes.link(df).collect()), key=repr)
    first = "Where is the hall?\nSee you"
    assert got == sorted([
        (1, 0, 0, 0, None, first), (1, 1, 0, 1, 0, "Second street."), (1, 2, 0, 2, 1, "Thanks"), (1, 3, 0, 1, 0, "A reply to the first"),
        (1, 4, 4, 0, None, "own"), (2, 0, 0, 0, None, "Where is the hall?"), (2, 5, 5, 0, None, ""), (2, 6, 6, 0, None, ""),
        # a row without a conversation and one that repeats a turn are left unlinked
        (None, 0, 0, 0, None, "x"), (1, 3, 3, 0, None, "A reply to the first"),
    ], key=repr)
    assert quotes.link(df.filter("turn < 0")).count() == 0


def test_long_thread_depth(spark):
    df = spark.createDataFrame([(1, i, "user", f"line {i}" + (f"\n> line {i - 1}" if i else "")) for i in range(150)], "conv_id long, turn long, role string, body string")
    assert {(r.turn, r.root, r.depth) for r in quotes.link(df).collect()} == {(i, 0, i) for i in range(150)}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """On a small corpus: toxic, wordless, copied and repeating documents, each stage's decision known."""
    import corpus_pipeline
    from .test_text_operators import brute_components, brute_strip, slow_fingerprint

    passage = prose(60, 77)
    data = []
    for i in range(300):
        words = prose(60, 9000 + i).split()
        if i % 6 == 0:
            words[5] = words[20] = "idiot"
        data.append((i, " ".join(words), "en", f"s{i % 3}", 1))
    data += [(1000, data[1][1], "en", "s", 1), (1001, data[1][1], "en", "s", 1), (1002, "123 !!!", "en", "s", 1), (1003, None, None, None, None), (1004, "", "en", "s", 0)]
    data += [(2000 + i, prose(30, 7000 + i) + " " + passage + " " + prose(30, 8000 + i), "en", "s", 1) for i in range(4)]
    folder = str(tmp_path)
    frame(spark, data).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [r for r in data if not (r[1] and "idiot" in r[1])]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near_copies", "passages", "packing"]
    docs = materialize(stages["toxicity"](spark, docs, folder), "t")
    assert docs.columns == frame(spark).columns and {r.doc_id for r in docs.collect()} == {r[0] for r in kept}
    kept = [r for r in kept if r[0] not in (1002, 1003, 1004)]
    docs = materialize(stages["language"](spark, docs, folder), "t")
    assert {r.doc_id for r in docs.collect()} == {r[0] for r in kept}
    component = brute_components([(r[0], slow_fingerprint(r[1])) for r in kept])
    kept = [r for r in kept if component[slow_fingerprint(r[1])] == r[0]]
    docs = materialize(stages["near_copies"](spark, docs, folder), "t")
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r[0] for r in kept) and not {1000, 1001} & {r[0] for r in kept}
    docs = materialize(stages["passages"](spark, docs, folder), "t")
    want = {r[0]: k for r, (_, _, k) in zip(kept, brute_strip([r[1] for r in kept]))}
    assert {r.doc_id: r.text for r in docs.collect()} == want and all(passage not in t for t in want.values())
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    last = stages["packing"](spark, docs, folder)
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == Counter(r.doc_id for r in last.collect())
    assert simhash.RADIUS == 2 and toxicity.FIT_DOCS > 0


def test_every_message_comes_back(spark):
    mail = [(1, 0, "a", "x"), (None, 0, "a", "x"), (1, None, "a", "y"), (1, None, "a", "y"), (1, 0, "b", "x"), (1, 0, None, "z"), (1, 1, "a", "ok\n> x"), (None, None, None, None)]
    mail += [(7, 3, "a", "same")] * 10_000
    got = quotes.link(spark.createDataFrame(mail, "conv_id long, turn long, role string, body string"))
    assert got.count() == len(mail) and got.filter("conv_id = 7 AND root = 3 AND depth = 0").count() == 10_000
    assert [tuple(r) for r in got.filter("conv_id = 1 AND turn = 1").select("root", "parent").collect()] == [(0, 0)]


def test_fixity_offsets_of_repeated_records(spark):
    rows = [(0, 1, "a", 10)] * 9000 + [(0, 1, "b", 7), (0, 0, "c", 5), (3, 3000, "d", 4)] + [(0, 1, f"u{i:04d}", 3) for i in range(500)]
    df = spark.createDataFrame(rows, "file long, page_id long, url string, length long")
    at = {}
    want = []
    for file, page, url, n in sorted(rows):
        want.append((file, page, url, n, at.get(file, 0)))
        at[file] = at.get(file, 0) + n
    assert sorted(tuple(r) for r in fixity.with_offsets(df, "page_id", "url").select("file", "page_id", "url", "length", "offset").collect()) == want


def test_fixity_joins_do_not_double_with_the_levels(spark):
    def joins(files):
        rows = spark.range(files).selectExpr("id AS file", "0L AS offset", "sha2(cast(id AS string), 256) AS hash")
        found = fixity.audit(materialize(rows, "a"), materialize(rows.withColumn("hash", F.when(F.col("file") == files // 2, "x").otherwise(F.col("hash"))), "b"))
        assert [tuple(r) for r in found.collect()] == [(files // 2, 0, "corrupt")]
        return found._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    # three levels of runs of files plan no more joins than none
    assert joins(1) == joins(5000) <= 3
