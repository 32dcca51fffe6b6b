"""Worked-out cases of single rules, and invariants of the sequential and skew-prone jobs."""

from __future__ import annotations

import datetime as dt
import json
import random
import re
import uuid
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from grantspark.functions import deadlines as D
from grantspark.functions import echo, money, titles, urls
from grantspark.functions.dates import iso_text
from grantspark.operators import audits, catalogue, chunks, deadlines, fields, listings, notices, recommend, retrieval, sections, values, work
from grantspark.streaming import events


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} string" for k in cols) or "x string"
    row = spark.createDataFrame([tuple(cols.values()) or ("",)], schema).select(expr.alias("v")).first()
    return row["v"]


@pytest.mark.parametrize("text,expected", [
    ("R$ 500.000,00 (quinhentos mil reais)", [500000.0]),
    ("R$ 10 milhões", [10.0, 10_000_000.0]),
    ("R$ 1,5 milhão", [1.0, 1_500_000.0]),
    ("R$ 1500,00", [150.0]),
    ("", []),
])
def test_amounts(spark, text, expected):
    assert one(spark, money.amounts("t"), t=text) == expected


def test_written_amount(spark):
    assert one(spark, money.written_amount("t"), t="dois milhões e quinhentos mil reais") == 2_500_000
    assert one(spark, money.written_amount("t"), t="duzentos reais") is None


def test_value_is_the_notice_number(spark):
    df = spark.createDataFrame([("00001946/2026", "1946/2026")], "valor_projeto string, numero string")
    row = values.value_quality(df).first()
    assert row["matches_number"] and row["suspicious"] and not row["plausible"]


def test_two_values_merge_first_wins(spark):
    ans = [
        (1, 0, '{"por_projeto":[],"total_programa":"R$ 9.000.000,00"}'),
        (1, 1, '{"por_projeto":["R$ 300.000,00 por projeto"],"bolsas":["R$ 900,00/mês"]}'),
        (1, 2, '{"por_projeto":["R$ 1.000,00 por projeto"],"bolsas":["R$ 900,00/mês","R$ 800,00/mês"]}'),
    ]
    rows = values.structure_value(spark.createDataFrame([(*a, "") for a in ans], "k int, o int, raw string, contexto string"))
    m = values.merge_values(rows, ["k"], "o").first()["estruturado"]
    assert m["valor"] == ["R$ 300.000,00 por projeto"] and m["total_programa"] == 9_000_000
    assert m["bolsas"] == ["R$ 900,00/mês", "R$ 800,00/mês"]


@pytest.mark.parametrize("text,expected", [
    ("Até 10/03/26", "Até 10/03/26"),
    ("de 01/02/2026 a 15/03/2026", "Até 15/03/2026"),
    ("Não informado", None),
    ("fluxo contínuo", "fluxo contínuo"),
])
def test_normalized_deadline(spark, text, expected):
    assert one(spark, D.normalized_deadline("t"), t=text) == expected


def test_roll_over(spark):
    assert one(spark, D.loose_date("t"), t="31/02/2026") == dt.date(2026, 3, 3)
    assert one(spark, D.loose_date("t"), t="5 de março de 2026") == dt.date(2026, 3, 5)


def test_active_pattern_is_bounded(spark):
    as_of = dt.date(2026, 6, 15)
    assert one(spark, D.has_active_pattern("t", as_of), t="chamada 39/2026") is False
    assert one(spark, D.has_active_pattern("t", as_of), t="até 9/2026") is True
    assert D.active_patterns(as_of)[:2] == ["06/2026", "6/2026"]


def test_titles_and_numbers(spark):
    t = "ADENDO Nº 02/2024"
    assert one(spark, titles.is_supplement("t"), t=t) and one(spark, titles.link_number("t"), t=t) == ""
    assert one(spark, titles.link_number("t"), t="ADENDO Nº 01/2025 ao Edital Nº 15/2024") == "15/2024"
    assert one(spark, titles.slug_number("t"), t="https://x/chamada-fapemig-012-2026/") == "012/2026"
    assert one(spark, iso_text("t"), t="até 5/3/2026") == "2026-03-05"


def test_urls(spark):
    assert one(spark, urls.resolve_pdf_url("t"), t="https://www.finep.gov.br/images/a.pdf") == "https://legacy.finep.gov.br/images/a.pdf"
    viewer = "https://www.fapema.br/wp-content/plugins/pdfjs/web/viewer.php?file=%2Fwp-content%2Fx.pdf&z=1"
    assert one(spark, urls.resolve_pdf_url("t"), t=viewer) == "https://www.fapema.br/wp-content/x.pdf"
    assert one(spark, urls.absolute_url("t", F.lit("https://a.br/x/y/z.html")), t="../b/./c.pdf?q=1") == "https://a.br/x/b/c.pdf?q=1"
    for host, bad in (("172.20.1.1", True), ("172.32.1.1", False), ("a.local", True), ("", True), ("300.1.1.1", False), ("x.gov.br", False)):
        assert one(spark, urls.is_unroutable("t"), t=host) is bad


def test_echo(spark):
    text = "Edital: N/A — Chamada X (BNDES) Campo: Localização Bacia do Rio Doce"
    assert one(spark, echo.strip_echo("t", F.lit(None), F.lit("bndes")), t=text) == "Bacia do Rio Doce"
    twice = one(spark, echo.strip_echo(echo.strip_echo("t", F.lit(None), F.lit("bndes")), F.lit(None), F.lit("bndes")), t=text)
    assert twice == "Bacia do Rio Doce"
    legit = "O Edital 05/2020 prevê apoio"
    assert one(spark, echo.strip_echo("t", F.lit("1/2"), F.lit("x")), t=legit) == legit


def test_chunk_starts_and_cover(spark):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(2000))
    out = chunks.chunk_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("chunk_index").collect()
    assert [r["content"] for r in out] == [text[0:800], text[600:1400], text[1200:2000]]


def brute_batches(lens, max_items, max_chars):
    ids, items, chars, batch = [], 0, 0, 0
    for n in lens:
        if items and (items >= max_items or chars + n > max_chars):
            batch, items, chars = batch + 1, 0, 0
        items, chars = items + 1, chars + n
        ids.append(batch)
    return ids


def test_batches_of_long_files_equal_the_plain_fold(spark):
    rng = random.Random(7)
    files = {f"f{i}": [rng.choice((1, 40, 200, 511, 512, 700)) for _ in range(n)] for i, n in enumerate((1, 7, 16, 17, 50, 333))}
    rows = [(f, i, "x" * n) for f, lens in files.items() for i, n in enumerate(lens)]
    df = spark.createDataFrame(rows, "file_id string, chunk_index int, content string")
    # blocks of 16 force every file above 16 chunks through the split form
    got = {(r["file_id"], r["chunk_index"]): r["batch_id"] for r in chunks.pack_embed_batches(df, block=16).collect()}
    for f, lens in files.items():
        assert [got[(f, i)] for i in range(len(lens))] == brute_batches([min(n, 512) for n in lens], 8, 2048)


def test_a_long_notice_is_read_whole(spark):
    """Over 5,000 chunks of one notice: every position once, in order, none cut."""
    df = spark.range(6000).select(
        F.lit("n").alias("notice_id"), F.pmod(F.col("id") * 7919, F.lit(6000)).alias("id"), F.lit("f").alias("file_id"),
        F.concat(F.lit("chunk "), "id").alias("content"), F.expr("CAST(id % 3 AS INT)").alias("order_index"),
    )
    ordered = retrieval.reading_order(df)
    rows = sorted((r["order_index"], r["id"]) for r in df.collect())
    assert {r["id"]: r["pos"] for r in ordered.collect()} == {i: k + 1 for k, (_, i) in enumerate(rows)}
    spans = sorted((r["start"], r["end"]) for r in retrieval.plain_text_spans(ordered).collect())
    assert spans[0][0] == 0 and all(b == a + 2 for (_, a), (b, _) in zip(spans, spans[1:])) and len(spans) == 6000
    assert sum(r["pieces"] for r in retrieval.scan_batches(ordered).collect()) == 6000


def test_events_are_read_strictly(spark):
    body = '"id":"1","name":"n","severity":"info","message":"m"'
    cases = {
        '{%s,"at":"2024-01-01T00:00:00Z"}' % body: None, '{%s,"at":"2024-01-01"}' % body: "malformed", '{%s}' % body: "missing at",
        '{"id":5,"name":"n","severity":"info","message":"m","at":"2024-01-01T00:00:00Z"}': "malformed", "[]": "malformed", "{bad": "malformed",
        '{%s,"at":"2024-01-01T00:00:00.5-03:00","props":{"a":1}}' % body: None,
    }
    got = events.parse_events(spark.createDataFrame([(c,) for c in cases], "detail string")).select("detail", "invalid").collect()
    assert {r["detail"]: r["invalid"] for r in got} == cases


def test_wrapped_timelines(spark):
    text = json.dumps({"fases": [{"nome": "Submissão", "data_fim": "2026-05-10"}]})
    for _ in range(4):
        assert one(spark, F.size(D.phases("t")), t=text) == 1
        text = json.dumps({"json": text})
    assert one(spark, F.coalesce(F.size(D.phases("t")), F.lit(-1)), t=text) == -1


def test_entities_and_bare_attributes(spark):
    page = "<a class=z href=/f.pdf>um</a><a href='b?a=1&amp;b=2'>do&ccedil;e n&ordm; &#231;&#xE7; &foo;</a><a href=\"c d\">a&amp;lt;b</a>"
    df = spark.createDataFrame([(1, "http://a.br/x/", page)], "page_id long, url string, html string")
    got = [(r["href"], r["text"], r["abs"]) for r in listings.extract_anchors(df).orderBy("pos").collect()]
    assert got == [("/f.pdf", "um", "http://a.br/f.pdf"), ("b?a=1&b=2", "doçe nº çç &foo;", "http://a.br/x/b?a=1&b=2"), ("c d", "a&lt;b", "http://a.br/x/c d")]


def test_area_patterns_escape(spark):
    scopes = spark.createDataFrame([(1, None, "x", a, 20) for a in ("a\\%b", "x_z", "q\\w", "plain")], "user_id long, empresa_id long, user_type string, area string, v_limit int")
    notices = spark.createDataFrame(
        [(i, None, None, None, None, None, None, None, t) for i, t in enumerate(("A%B", "aXb", "xyz", "qw", "plain"))],
        "id long, is_researcher boolean, is_company boolean, data_encerramento string, valor_projeto string, valor string, sobre_programa string, criterios_elegibilidade string, titulo string",
    ).withColumns({"area": F.lit(None).cast("string"), "descricao": F.lit(None).cast("string")})
    scopes = scopes.union(spark.createDataFrame([(2, None, "x", a, 20) for a in ("%", "zz", "n")], scopes.schema))
    got = {}
    for r in recommend.area_hits(scopes, recommend.classify(notices, dt.date(2026, 1, 1))).collect():
        got.setdefault(r["area"], []).append(r["id"])
    assert {a: sorted(i) for a, i in got.items()} == {"a\\%b": [0], "x_z": [2], "q\\w": [3], "plain": [4], "%": [0, 1, 2, 3, 4], "n": [4]}


def test_vectors_unwrap_and_reject(spark):
    raw = ["[1,2,3,4]", "[[1,2,3,4]]", "[ [ [1,2,3,4] ] ]", "[1,2]", "no", "[[1,2,3,4],[5,6,7,8]]"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    got = [r["v"] for r in df.select(chunks.coerce_vector("raw").alias("v")).collect()]
    assert got == [[1, 2, 3, 4]] * 3 + [None, None, [1, 2, 3, 4]]
    nan = spark.createDataFrame([("n", 1, [1.0, float("nan"), 2.0, 3.0], [1.0, 0.0, 0.0, 0.0])], "notice_id string, id long, embedding_perguntas array<double>, embedding array<double>")
    assert [r["score"] for r in retrieval.cosine_scores(nan, {"vagas": [1.0, 0.0, 0.0, 0.0]}).collect()] == [1.0]


def test_scan_batches_partition_in_order(spark):
    rng = random.Random(3)
    rows = [("n1", i, "f", "y" * rng.choice((10, 900, 1500, 3200)), i) for i in range(60)]
    df = spark.createDataFrame(rows, "notice_id string, id long, file_id string, content string, order_index int")
    ordered = retrieval.reading_order(df, 1000)
    got = retrieval.scan_batches(ordered).orderBy("batch").collect()
    head = [len(f"--- Documento f / chunk {i} ---\n") for i in range(60)]
    ids, items, chars, batch = [], 0, 0, 0
    for i, r in enumerate(rows):
        n = len(r[3]) + head[i]
        joined = chars + 2 + n if items else n
        if items and (items >= 3 or joined > 3000):
            batch, items, joined = batch + 1, 0, n
        items, chars = items + 1, joined
        ids.append(batch)
    assert [r["pieces"] for r in got] == [ids.count(b) for b in range(max(ids) + 1)]
    assert all(len(r["context"]) <= 3000 for r in got)


def test_cosine_bounds_and_zero(spark):
    rows = [("n", 1, [0.0] * 4, None), ("n", 2, [1.0, 2.0, 3.0, 4.0], None), ("n", 3, [1.0] * 4, [1.0, 2.0, 3.0]), ("n", 4, None, None)]
    df = spark.createDataFrame(rows, "notice_id string, id long, embedding array<float>, embedding_perguntas array<float>")
    got = {r["id"]: r["score"] for r in retrieval.cosine_scores(df, {"vagas": [1.0, 2.0, 3.0, 4.0]}).collect()}
    # a question vector that is too short is no vector: the full one counts
    assert got[1] == -1 and abs(got[2] - 1) < 1e-12 and -1 <= got[3] <= 1 and 4 not in got


def test_spread_windows(spark):
    w = retrieval.spread_windows(spark.createDataFrame([("n", 100000)], "notice_id string, plain_len long"), 8000, 3)
    assert [r["w_start"] for r in w.orderBy("window_index").collect()] == [0, 46000, 92000]


def test_scores(spark):
    as_of = dt.date(2026, 6, 15)
    cat = spark.createDataFrame(
        [("a", True, None, "saúde", "t", "d", "s", "c", "v", None, "2026-12-31", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1)),
         ("b", None, False, None, None, None, None, None, None, None, "2020-01-01", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1))],
        "id string, is_researcher boolean, is_company boolean, area string, titulo string, descricao string, sobre_programa string, criterios_elegibilidade string,"
        " valor_projeto string, valor string, data_encerramento string, criado_em timestamp, validado_em timestamp",
    )
    scopes = spark.createDataFrame([("u1", None, "pesquisador", "Saúde", 20), ("u2", None, "consultor", "", 20)], "user_id string, empresa_id string, user_type string, area string, v_limit int")
    scoring = recommend.Scoring(scopes.withColumn("v_limit", F.lit(None).cast("int")), cat, as_of)
    got = {(r["user_id"], r["edital_id"]): r["score"] for r in recommend.top_recommendations(scoring, min_score=0).collect()}
    assert len(got) == 4 and got[("u1", "a")] == 100 and got[("u2", "b")] == 0
    assert all(0 <= s <= 100 for s in got.values())
    sums = {r["user_id"]: (r["notices"], r["best"], r["eligible"]) for r in recommend.score_notices(scoring).collect()}
    assert sums["u1"] == (2, 100, 1)
    top = recommend.top_recommendations(recommend.Scoring(scopes, cat, as_of)).collect()
    assert [(r["user_id"], r["edital_id"], r["rank"], r["score"]) for r in top if r["user_id"] == "u1"] == [("u1", "a", 1, 100)]


def test_limits_over_many_notices(spark):
    """Areas that hit the first notices of a trait: the reach is doubled until the limit is filled; no limit gives all."""
    as_of, none = dt.date(2026, 1, 1), None
    rows = [(i, none, none, "", "solar" if i < 90 or i % 7 == 0 else "eolica", none, none, none, none, none, none) for i in range(600)]
    cat = spark.createDataFrame(rows, "id long, is_researcher boolean, is_company boolean, area string, titulo string, descricao string, sobre_programa string, criterios_elegibilidade string,"
                                " valor_projeto string, valor string, data_encerramento string")
    for limits in ((7, 30), (7, None)):
        scopes = spark.createDataFrame([(1, none, "x", "solar", limits[0]), (2, 5, "x", "EOL", limits[1]), (3, none, "x", "", 3)], "user_id long, empresa_id long, user_type string, area string, v_limit int")
        got = {}
        for r in recommend.top_recommendations(recommend.Scoring(scopes, cat, as_of), min_score=0).orderBy("rank").collect():
            got.setdefault(r["user_id"], []).append((r["score"], r["edital_id"]))
        for user, word, limit in ((1, "solar", limits[0]), (2, "eol", limits[1]), (3, "", 3)):
            want = sorted((-15 - 25 * (word != "" and word in r[4]), r[0]) for r in rows)[:limit]
            assert got[user] == [(-s, i) for s, i in want]


def test_audit_accept_beats_earlier_rejects(spark):
    rows = [("n", "vagas", b, True, v, d, "") for b, d, v in ((0, "reject", None), (1, "reject", None), (2, "accept", "30 vagas"))]
    df = spark.createDataFrame(rows, "notice_id string, field string, batch int, ok boolean, value string, decision string, reason string")
    r = catalogue.resolve_audits(df).first()
    assert (r["decision"], r["value"]) == ("accept", "30 vagas")
    r = catalogue.resolve_audits(df.where("batch < 2")).first()
    assert (r["decision"], r["batch"]) == ("reject", 1)


def test_answers(spark):
    rows = [("n", "vagas", "topk", 0, '```json\n{"vagas":"3 vagas"}\n```', False), ("n", "vagas", "topk", 1, "{}", False), ("n", "is_company", "topk", 0, '{"is_company":"true"}', False)]
    got = fields.parse_responses(spark.createDataFrame(rows, "notice_id string, field string, stage string, batch int, raw string, timed_out boolean")).collect()
    assert [(r["has_key"], r["value"]) for r in got] == [(True, "3 vagas"), (False, None), (True, None)]


def test_invalid_event(spark):
    detail = '{"id":"1","name":"n","severity":"debug","message":"m","at":"2026-01-01T00:00:00Z"}'
    assert events.parse_events(spark.createDataFrame([(detail,)], "detail string")).first()["invalid"] == "invalid severity"


def test_stream_equals_batch(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    from grantspark.plans.derived import derive

    landing = str(tmp_path / f"in-{uuid.uuid4().hex}")
    batch = derive(spark, folder, "domain_events").select("event_id", "detail")
    batch.repartition(4).write.parquet(landing)

    def job(df):
        return events.format_messages(events.route_events(events.parse_events(df))).select("event_id", "route", "text")

    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        events.run_incremental(events.read_stream(spark, landing, batch.schema), job, out, check)
    streamed = spark.read.parquet(out).drop("batch")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, job(batch).collect()))


def test_work_order(spark):
    at = lambda d: dt.datetime(2026, 1, d)
    n = spark.createDataFrame([(1, at(1), at(9)), (2, None, at(1)), (3, None, at(5)), (4, at(2), at(2))], "id long, informacoes_processadas_em timestamp, criado_em timestamp")
    counts = spark.createDataFrame([(4, 9), (1, 9), (2, 1)], "id long, chunks long")
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(work.order_work(n, "new_first")) == [3, 2, 1, 4]
    assert ids(work.order_work(n, "documents_chunks_only", counts)) == [1, 4, 2, 3]
    assert ids(work.order_work(n, "fetch")) == [1, 3, 4, 2]
    # an empty reference set filters nothing
    assert len(ids(work.filter_backlog(n, attached=spark.createDataFrame([], "id long")))) == 4


def test_ranked_windows_prune_before_the_shuffle(spark):
    scores = spark.range(1000).selectExpr("cast(id % 3 as string) notice_id", "'vagas' field", "id", "cast(id as double) score")
    plan = retrieval.topk_by_field(scores)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_association_uses_no_nested_loops(spark):
    from grantspark.plans.derived import derive

    folder = "/root/testdata/sf0.001"
    pairs = retrieval.associate_chunks(derive(spark, folder, "chunks"), derive(spark, folder, "attachments"))
    assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_supplement_joins_its_parent(spark):
    html = (
        '<ul><li><a href="/e.pdf">Edital nº 15/2024 de fomento</a></li><li><a href="/a.pdf">ADENDO Nº 01/2025</a> ao Edital Nº 15/2024</li>'
        '<li><a href="/o.pdf">ERRATA</a></li></ul>'
    )
    pages = spark.createDataFrame([(1, "https://x.br/lista", html)], "page_id long, url string, html string")
    headers, files = sections.attach_supplements(sections.block_anchors(pages), "funcap")
    assert [(r["numero"], r["titulo"]) for r in headers.collect()] == [("15/2024", "Edital nº 15/2024 de fomento")]
    assert sorted(r["pdf_url"] for r in files.collect()) == ["https://x.br/a.pdf", "https://x.br/e.pdf"]


def test_later_duplicates_donate_files(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "row_id long, titulo string")
    files = spark.createDataFrame([(1, "x"), (2, "y"), (2, "x"), (3, "z")], "row_id long, pdf_url string")
    kept, donated = listings.dedupe_first_wins(rows, F.col("titulo"), ["row_id"], files)
    assert sorted(r["row_id"] for r in kept.collect()) == [1, 3]
    assert sorted(map(tuple, donated.select("row_id", "pdf_url").collect())) == [(1, "x"), (1, "y"), (3, "z")]


def test_repairs_do_nothing_twice(spark):
    n = spark.createDataFrame([(1, "5/2026", "src", "Campo: vagas Texto: 3 vagas", '{"valor":["Campo: vagas","R$ 5,00"],"x":null}')], "id long, numero string, fonte string, vagas string, valor_projeto string")
    changes = audits.clean_echoes(n, fields=("vagas", "valor_projeto")).where("changed").collect()
    assert {(r["field"], r["after"]) for r in changes} == {("vagas", "3 vagas"), ("valor_projeto", '{"valor":["R$ 5,00"],"x":null}')}
    fixed = n.withColumns({"vagas": F.lit("3 vagas"), "valor_projeto": F.lit('{"valor":["R$ 5,00"],"x":null}')})
    assert audits.clean_echoes(fixed, fields=("vagas", "valor_projeto")).where("changed").count() == 0


def test_deadline_reconciled_from_timeline(spark):
    tl = '{"fases":[{"nome":"Resultado","data_fim":"2026-12-01"},{"nome":"Submissão","prazo":"até 10/08/2026 e 12/08/2026"}]}'
    df = spark.createDataFrame([("Não informado", tl, None)], "prazo_inscricao string, timeline_estimada string, data_encerramento string")
    r = deadlines.reconcile_deadline(df).first()
    assert r["reconciled"] == "até 10/08/2026 e 12/08/2026" and r["changed"]


def test_nothing_is_cut_by_default(spark):
    """The figures that used to be defaults: texts beyond them stay whole, and are cut where a limit is given."""
    long = "consulte o portal " * 30
    assert one(spark, D.normalized_deadline("t"), t=long) == long.strip()
    assert one(spark, D.normalized_deadline("t", most_chars=200), t=long) is None
    found = spark.createDataFrame([("n", "vagas", "topk", "x" * 5000, ["c1"], 1)], "notice_id string, field string, stage string, context string, chunk_ids array<string>, chunk_index int")
    assert len(fields.evidence_records(found).first()["evidence"]["snippet"]) == 5000
    assert len(fields.evidence_records(found, most_chars=2800).first()["evidence"]["snippet"]) == 2800
    phase = json.dumps({"fases": [{"nome": "n" * 400, "prazo": "até 10/08/2026 " + "p" * 300}]})
    got = one(spark, fields.clean_phases(D.phases("t")), t=phase)[0]
    assert (len(got["nome"]), len(got["prazo"])) == (400, 315)
    assert len(one(spark, fields.clean_phases(D.phases("t"), {"nome": 200}), t=phase)[0]["nome"]) == 200


@pytest.mark.parametrize("flag, ending", [("exige_obra", "reforma"), ("lei_14133_integral", "no que couber"), ("clt", "ter vínculo")])
def test_weak_support_is_seen_at_the_end_of_a_snippet(spark, flag, ending):
    """The veto reads the whole snippet, not its first 240 characters."""
    snippet = "texto do edital " * 30 + ending
    rows = [("n", json.dumps({flag: True, "evidencias": {flag: snippet}}), snippet)]
    r = fields.sanitize_profile(spark.createDataFrame(rows, "notice_id string, raw string, contexto string")).first()
    assert f"{flag}:evidencia_fraca" in r["rejeitados"] and r["perfil"][flag] is None


def test_values_keep_every_line_and_stipend(spark):
    lines = [f"até R$ {n}.000,00 " + "por proposta aprovada " * 12 for n in range(101, 110)]
    text = "; ".join(lines)
    got = spark.createDataFrame([(text,)], "t string").select(money.value_lines("t").alias("v"), money.value_lines("t", 6, 160).alias("few")).first()
    # the text is cut at each amount, so the lines joined give the text back but for its first words
    assert len(got["v"]) == 9 and all(len(x) > 160 for x in got["v"]) and "".join(got["v"]).replace(" ", "") == text[len("até "):].replace(" ", "")
    assert len(got["few"]) == 6 and all(len(x) == 160 for x in got["few"])

    answer = {"por_projeto": [f"R$ {n}.000,00" for n in range(101, 110)], "bolsas": [f"bolsa {n} R$ {n}00,00" for n in range(20, 29)]}
    rows = values.structure_value(spark.createDataFrame([(1, 0, json.dumps(answer), "")], "k int, o int, raw string, contexto string"))
    m = values.merge_values(rows, ["k"], "o").first()["estruturado"]
    assert m["valor"] == answer["por_projeto"] and m["bolsas"] == answer["bolsas"]
    assert values.merge_values(rows, ["k"], "o", max_lines=6).first()["estruturado"]["bolsas"] == answer["bolsas"][:6]


def test_stored_values_always_parse(spark):
    items = [f"R$ {n}.000,00 " + "x" * 300 for n in range(101, 121)]
    rows = spark.createDataFrame([(json.dumps({"valor": items}),), ("R$ 5,00 " + "y" * 500,), (None,), ("",)], "valor_projeto string")
    whole = [r["compacted"] for r in values.compact_value(rows).collect()]
    assert json.loads(whole[0])["valor"] == items and whole[1] == "R$ 5,00 " + "y" * 500 and whole[2:] == [None, None]
    short = values.compact_value(rows, max_chars=1400, line_chars=240, max_items=15).first()["compacted"]
    kept = json.loads(short)["valor"]
    assert len(short) <= 1400 and 8 <= len(kept) < 15 and all(len(x) == 120 for x in kept)


def test_long_file_names_are_files_of_their_own(spark):
    stem = "https://x.br/d/" + "edital-" * 40
    empty = spark.createDataFrame([], "caminho_storage string, path_mark string, url_original string")

    def found(*names):
        return spark.createDataFrame([(1, "src", "1/2026", n) for n in names], "edital_id long, fonte string, numero string, pdf_url string")

    def paths(df):
        return {r["url_original"]: r["caminho_storage"] for r in df.collect()}

    first = notices.register_attachments(empty, found(stem + "a.pdf", stem + "b.pdf", "https://x.br/d/short.pdf"))[0]
    a = paths(first)
    assert len(set(a.values())) == 3 and a["https://x.br/d/short.pdf"] == "src/1_2026/short.pdf"
    assert sum(p.endswith("edital-" * 4 + "edit.pdf") for p in a.values()) == 1
    later = notices.register_attachments(first, found(stem + "c.pdf", stem + "a.pdf", stem + "b.pdf"))[0]
    b = paths(later)
    assert list(b) == [stem + "c.pdf"] and not set(b.values()) & set(a.values())
    # older rows carry no mark: the address tells who holds the plain path
    old = first.drop("path_mark")
    again = paths(notices.register_attachments(old, found(stem + "a.pdf", stem + "b.pdf"))[0])
    assert not again
    # a name that is exactly as long as the cut collides with nothing that is stored under it
    exact = "https://x.br/d/" + ("edital-" * 40)[:200] + ".pdf"
    more = paths(notices.register_attachments(first, found(exact))[0])
    assert list(more) == [exact] and not set(more.values()) & set(a.values())


def test_span_overlap_is_found_near_its_place(spark):
    rng = random.Random(5)
    spans, at = [], 0
    for i in range(3000):
        n = rng.choice((1, 7, 400, 30_000)) if i % 500 == 0 else rng.randint(1, 60)
        spans.append(("n", f"c{i}", at, at + n))
        at += n + 2
    windows = [("n", i, i * 2000, min(at, i * 2000 + 3000)) for i in range(at // 2000 + 1)]
    s = spark.createDataFrame(spans + [("m", "x", 0, 5), ("m", "null", None, 5)], "notice_id string, id string, start long, end long")
    w = spark.createDataFrame(windows + [("m", 0, 5, 9), ("m", 1, 2, 4)], "notice_id string, window_index int, w_start long, w_end long")
    got = sorted(tuple(r) for r in retrieval.span_overlap_join(s, w).collect())
    want = [("n", j, c) for _, c, a, b in spans for _, j, x, y in windows if b > x and a < y] + [("m", 1, "x")]
    assert got == sorted(want)


def test_span_overlap_of_a_long_notice_is_linear(spark):
    s = spark.range(100_000).selectExpr("'n' AS notice_id", "cast(id AS string) AS id", "id * 102 AS start", "id * 102 + 100 AS end")
    w = retrieval.sliding_windows(retrieval.span_lengths(s))
    out = retrieval.span_overlap_join(s, w)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan.split("Join Inner")[1].split("\n")[0]
    n, windows = out.count(), w.count()
    # each window of 3000 characters meets some thirty chunks
    assert windows * 28 <= n <= windows * 32


class _Panels(HTMLParser):
    """Brute force for collapse panels: a stack of open elements."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.stack, self.titles, self.links, self.now = [], [], {}, None
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "").strip() for k, v in attrs}
        if tag == "a":
            self.now = None
            if a.get("href", "").startswith("#collapse-"):
                self.now = [a["href"][1:], ""]
                self.titles.append(self.now)
            elif ".pdf" in a.get("href", "").lower():
                for _, ident in self.stack:
                    self.links.setdefault(ident, []).append(a["href"])
        if tag not in ("br", "img"):
            self.stack.append((tag, a.get("id", "")))

    def handle_endtag(self, tag):
        if tag == "a":
            self.now = None
        if tag in [t for t, _ in self.stack]:
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if self.now:
            self.now[1] += data

    def pairs(self):
        named = [(i, re.sub(r"[+\-]\s*$", "", " ".join(t.split())).strip()) for i, t in self.titles]
        return {(t, h) for i, t in named if t for h in self.links.get(i, [])}


def test_collapse_panels_against_a_stack(spark):
    rng = random.Random(11)

    def tree(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            n = rng.randint(0, 12)
            kind = rng.random()
            if kind < 0.3:
                out.append(f'<a class=x href="/f/{n}.PDF?a=1&amp;b=2">Ficheiro <b>{n}</b></a>')
            elif kind < 0.5:
                out.append(f"<A href='#collapse-{n}'>Prêmio <i>{n}</i> &amp; outros +" + rng.choice(("</a>", "<a href='/x'>y</a>")))
            elif kind < 0.6:
                stray = ("</div>", "</section>") if depth == 4 else ()
                out.append(rng.choice((*stray, "<br>", "<img id=collapse-1 src=a.png/>", "<!-- <div id=collapse-2> -->", "<p>sem fim", "<script>'</div>'</script>")))
            elif depth:
                tag = rng.choice(("div", "section"))
                out.append(f"<{tag} class='p' id=\"collapse-{n}\">{tree(depth - 1)}</{tag}>" if rng.random() < 0.8 else f"<{tag}>{tree(depth - 1)}</{tag}>")
        return "".join(out)

    pages = [(i, f"https://s.br/{i}", "<html><body>" + "".join(tree(4) for _ in range(6)) + "</body></html>") for i in range(60)]
    long = "".join(f'<a href="#collapse-{n}">Painel {n}</a><div id="collapse-{n}"><div><a href="/g/{n}.pdf">x</a></div></div>' for n in range(3000))
    pages += [(60, "https://s.br/60", long), (61, "https://s.br/61", None), (62, "https://s.br/62", ""), pages[3]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r["page_id"], r["titulo"], r["link"], r["pdf_url"]) for r in sections.collapse_sections(df).collect()}
    want = {(i, t, url, "https://s.br" + h) for i, url, html in pages for t, h in _Panels(html or "").pairs()}
    assert len(want) > 3050 and got == want


def test_extra_fields_merge_into_both_snapshots(spark):
    kind = f"map<string,{fields.EVIDENCE}>"
    record = lambda source, snippet: (source, snippet, None, None, None)
    n = spark.createDataFrame(
        [(1, None, "a", None, {"vagas": record("topk", "40")}), (2, "R$ 1", None, "{}", {"valor_bolsa": record("topk", "old")}), (3, None, None, None, None)],
        f"id long, valor_bolsa string, valor_projeto string, perfil_execucao string, informacoes_extracao_evidence {kind}",
    )
    c = spark.createDataFrame([(2, "x", None), (9, "y", None)], "id long, valor_projeto string, perfil_execucao string")
    accepted = f"id long, value string, evidence {fields.EVIDENCE}"
    stipends = spark.createDataFrame([(1, "R$ 7", record("s", "seven")), (2, "R$ 8", record("s", "eight")), (2, "R$ 5", record("s", "five")), (None, "R$ 6", record("s", "six"))], accepted)
    values = spark.createDataFrame([(2, "v", record("r", "vee")), (9, "w", record("r", "dou"))], accepted)
    profiles = spark.createDataFrame([(3, '{"clt":true}'), (9, "{}")], "id long, value string")
    notices_, catalogue_ = fields.apply_extra_fields(n, c, stipends, values, profiles)
    assert notices_.columns == n.columns and catalogue_.columns == c.columns
    got = {r["id"]: r for r in notices_.collect()}
    assert [(got[i]["valor_bolsa"], got[i]["valor_projeto"], got[i]["perfil_execucao"]) for i in (1, 2, 3)] == [("R$ 7", "a", None), ("R$ 8", "v", "{}"), (None, None, '{"clt":true}')]
    shown = {i: {k: v["snippet"] for k, v in (got[i]["informacoes_extracao_evidence"] or {}).items()} for i in got}
    assert shown == {1: {"vagas": "40", "valor_bolsa": "seven"}, 2: {"valor_bolsa": "eight", "valor_projeto": "vee"}, 3: {}}
    # stipends stay with the notices, values and profiles reach the catalogue
    assert sorted(map(tuple, catalogue_.collect())) == [(2, "v", None), (9, "w", "{}")]
    # no answers at all change nothing
    same, _ = fields.apply_extra_fields(n, c)
    assert sorted(map(str, same.collect())) == sorted(map(str, n.collect()))


def test_numbered_places_span_partitions(spark):
    rows = spark.range(5000).selectExpr("id", "(id * 7919) % 5000 AS k").repartition(7)
    placed = work.numbered(rows.orderBy(F.desc("k"), "id"))
    assert placed.where("pos <> 5000 - k").count() == 0 and placed.count() == 5000
    assert work.numbered(rows.where("k < 0").orderBy("k")).count() == 0
    # ties keep the total order of the last key
    tied = work.numbered(rows.orderBy(F.pmod("id", F.lit(2)), "id")).where("pos IN (1, 2500, 2501, 5000)").orderBy("pos")
    assert [r["id"] for r in tied.collect()] == [0, 4998, 1, 4999]


def test_scan_reads_missing_columns_as_null(spark, tmp_path):
    spark.range(3).selectExpr("id", "'f' AS fonte", "id AS extra").write.parquet(str(tmp_path / "n"))
    from grantspark.sources.tables import SCHEMAS, scan_table, scan_tables

    got = scan_tables(spark, {"notices": str(tmp_path / "n")}, SCHEMAS, {"notices": ("id", "numero")})["notices"]
    assert got.columns == ["id", "numero"] and got.where("numero IS NOT NULL").count() == 0 and got.count() == 3
    assert scan_table(spark, str(tmp_path / "n"), SCHEMAS["notices"]).columns == ["id", "fonte", "numero", "valor_bolsa", "perfil_execucao"]


def test_upsert_scope_rows(spark):
    kind = "user_id long, edital_id long, score int"
    old, new = spark.createDataFrame([(1, 5, 10), (1, 6, 11), (2, 5, 12)], kind), spark.createDataFrame([(1, 5, 90), (3, 1, 80)], kind)
    assert sorted(map(tuple, recommend.upsert_scope_rows(old, new).collect())) == [(1, 5, 90), (1, 6, 11), (2, 5, 12), (3, 1, 80)]


def test_query_vectors_one_per_field(spark):
    names = list(retrieval.FIELDS)
    rows = [(n, [float(i), 1.0]) for i, n in enumerate(names)] + [(names[0], [5.0, 1.0])] * 20 + [("other", [1.0]), (names[1], None), (None, [1.0])]
    got = retrieval.query_vectors(spark.createDataFrame(rows, "field string, vector array<double>").repartition(5))
    assert got == {n: [float(i), 1.0] for i, n in enumerate(names)}
