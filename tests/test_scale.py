"""What keeps the cost of a row and of a task in bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantspark.functions import echo, money
from grantspark.functions.text import squish, strip
from grantspark.sources import tables


def test_tables_are_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(spark.range(1000, numPartitions=cores + 1)).rdd.getNumPartitions() == 100
    assert tables.spread(spark.range(1000, numPartitions=120)).rdd.getNumPartitions() == 120
    assert tables.spread(spark.range(5, numPartitions=1)).rdd.getNumPartitions() == cores


def test_a_form_of_echo_is_one_expression(spark):
    rows = spark.createDataFrame([("N/A 1 — x. Campo: Vagas. corpo", None, "s")], "t string, n string, f string")
    shown = rows.select(echo.strip_echo("t", "n", "f").alias("x"))
    # one pattern for each form and a few around them; nested copies of the text made them many times as many
    assert shown._jdf.queryExecution().analyzed().toString().count("regexp_replace") <= len(echo.FORMS) + 8
    assert shown.first().x == "N/A 1 — x. corpo"


def test_number_words_are_read_where_a_step_is_named(spark):
    rows = spark.createDataFrame([("dois MILHÕES",), ("cinco mil reais",), ("um MíL",), ("duzentos reais",), (None,)], "t string")
    got = rows.select(money.written_amount("t").alias("n"))
    assert "CASE WHEN RLIKE" in got._jdf.queryExecution().analyzed().toString()
    assert [r.n for r in got.collect()] == [2_000_000.0, 5000.0, 1000.0, None, None]


def test_whitespace_of_every_kind(spark):
    wide = "\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    rows = [("a b", "a b", "a b"), (" a  b\t", "a b", "a  b"), ("a\n\x0b\f\rb", "a b", "a\n\x0b\f\rb"), (wide + "a" + wide + "b" + wide, "a b", "a" + wide + "b"),
            ("\u200ba\u200b", "\u200ba\u200b", "\u200ba\u200b"), ("a \x85", "a \x85", "a\x85"), (None, "", ""), (" ", "", "")]
    df = spark.createDataFrame(rows, "t string, tidy string, bare string")
    plan = df.select(squish("t"))._jdf.queryExecution().analyzed().toString()
    assert "contains(" in plan.lower()  # a pattern runs only where a plain search found something
    assert df.where((squish("t") != F.col("tidy")) | (strip("t") != F.col("bare"))).count() == 0


def test_values_are_worked_out_once_for_a_merge(spark):
    from grantspark.operators import values as V

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def raw(i):
        seen.add(1)
        return '{"por_projeto":["R$ 5.000,00"],"bolsas":["bolsa R$ 900,00"]}'

    rows = V.structure_value(spark.range(6).select("id", (F.col("id") % 2).alias("k"), raw.asNondeterministic()("id").alias("raw"), F.lit(None).cast("string").alias("contexto")))
    got = V.merge_values(rows, ["k"], "id").collect()
    assert len(got) == 2 and all(r.estruturado.valor == ["R$ 5.000,00"] and r.estruturado.bolsas == ["bolsa R$ 900,00"] for r in got)
    assert seen.value == 6


def test_a_held_value_is_no_element_of_an_array(spark):
    from grantspark.functions.text import let

    df = spark.createDataFrame([("a b",), (None,)], "t string")
    shown = df.select(let(F.upper("t"), lambda u: F.concat(u, let(F.lower(u), lambda low: F.concat(low, u)))).alias("x"))
    # the type of an array read by position is worked out for each row, with those of all rules inside
    plan = shown._jdf.queryExecution().analyzed().toString()
    assert "get(" not in plan and "transform(" not in plan
    assert [r.x for r in shown.collect()] == ["A Ba bA B", None]


def test_each_level_of_a_timeline_is_parsed_once(spark):
    from grantspark.functions.deadlines import phases

    rows = [('{"fases":[{"nome":"a"}]}', ["a"]), ('{"json":"{\\"json\\":\\"{}\\"}"}', None), ('{"json":"{\\"fases\\":[{\\"nome\\":\\"b\\"}]}"}', ["b"]), ("", None), ("[1]", None), (None, None), ("{", None)]
    df = spark.createDataFrame(rows, "t string, names array<string>")
    shown = df.select("names", phases("t")["nome"].alias("got"))
    assert shown._jdf.queryExecution().analyzed().toString().count("from_json(") == 4
    assert all(r.names == r.got for r in shown.collect())


def test_rows_are_judged_once_for_the_catalogue(spark, tmp_path):
    from datetime import datetime

    from grantspark.operators import catalogue as C
    from grantspark.plans.derived import AS_OF, derive

    orders = "id AS o_orderkey, id * 3 AS o_custkey, DATE '1998-08-02' AS o_orderdate, 'O' AS o_orderstatus, id * 7.0D AS o_totalprice, '1-URGENT' AS o_orderpriority"
    spark.range(40).selectExpr(*orders.split(", ")).write.parquet(f"{tmp_path}/orders.parquet")
    notices = derive(spark, str(tmp_path), "notices")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def title(t):
        seen.add(1)
        return t

    rows = notices.withColumn("titulo", title.asNondeterministic()("titulo"))
    out = C.publish_catalogue(derive(spark, str(tmp_path), "catalogue"), rows, AS_OF, datetime(1998, 8, 1))
    assert out.count() > 0 and seen.value == 40


def test_texts_are_cut_and_read_as_before(spark):
    rows = [("R$ 5.000,00 e R$ 6.000,00", ["R$ 5.000,00", "R$ 6.000,00"], [5000.0, 6000.0]), ("até r$ 10 por mês; teto R$ 20", ["r$ 10 por mês; teto", "R$ 20"], [10.0, 20.0]),
            ("dois MILHÕES (três mil)", ["dois MILHÕES (três mil)"], [3000.0]), ("1,5 milhão", ["1,5 milhão"], [1_500_000.0]), ("sem valor", ["sem valor"], []), ("", [], []), (None, [], [])]
    df = spark.createDataFrame(rows, "t string, cut array<string>, n array<double>")
    got = df.select("cut", "n", money.segments("t").alias("s"), money.amounts("t").alias("a")).collect()
    assert all(r.s == r.cut and r.a == r.n for r in got)


def test_only_texts_with_something_to_drop_are_cleaned_again(spark):
    from grantspark.operators.chunks import chunk_documents

    rows = [(1, "ab  cd ef gh"), (2, "ab\x01cd\\ ef"), (3, "\x02 \x03"), (4, "é\u3000é \t é"), (5, None)]
    shown = chunk_documents(spark.createDataFrame(rows, "doc_id long, text string"), size=5, overlap=2)
    assert "dirty" in shown._jdf.queryExecution().analyzed().toString()
    got = {}
    for r in shown.orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r.doc_id, []).append(r.content)
    assert got == {1: ["ab cd", "cd ef", "ef gh"], 2: ["ab cd", "cd e", "ef"], 4: ["é é é"]}


def test_orders_of_texts_store_no_vectors():
    from grantspark.plans import q_retrieval as Q

    asked = []

    class Stop(Exception):
        pass

    class Frames:
        def stored(self, name, build=None):
            asked.append(name)
            raise Stop

    for query in (Q.reading_order, Q.sliding_windows):
        try:
            query(Frames())
        except Stop:
            pass
    assert asked == ["chunk_keys", "chunk_texts"]


def test_audit_requests_carry_the_headings_of_their_notices(spark, tmp_path):
    import __spark_entry__
    from grantspark.config import FIELDS
    from grantspark.operators import catalogue, retrieval

    # ids that repeat or are null: as many rows as a join by id makes
    rows = [(i, n, t, s, *[f"{n} {c}" for c in FIELDS]) for i, n, t, s in ((1, "a", "x", "f"), (2, "b", "y", "g"), (2, None, "z", None), (2, "b", "y", "g"), (None, "c", "w", "h"))]
    notices = spark.createDataFrame(rows, "id long, numero string, titulo string, fonte string, " + ", ".join(f"{c} string" for c in FIELDS))
    want = retrieval.build_audit_requests(catalogue.audit_targets(notices).where("action = 'audit'"), notices)
    got = retrieval.build_audit_requests(catalogue.audit_targets(retrieval.with_headings(notices), keep=retrieval.HEADINGS).where("action = 'audit'"))
    # one notice and three times three; a timeline without phases is not audited
    assert got.columns == want.columns and got.count() == (1 + 9) * (len(FIELDS) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    orders = "id AS o_orderkey, id % 7 AS o_custkey, 'F' AS o_orderstatus, 1.5D AS o_totalprice, TIMESTAMP '1998-01-02' AS o_orderdate, '1-URGENT' AS o_orderpriority"
    spark.range(20_000).selectExpr(*orders.split(", ")).write.parquet(f"{tmp_path}/orders.parquet")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        plan = __spark_entry__.queries()["build_requests_audit"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    # rows of (notice, field) are made last and never dealt out
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
