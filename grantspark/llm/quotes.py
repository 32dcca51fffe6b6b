"""Quotation linking in conversations (operator 6); DataFrame functions only.

Each line of a message has a quote level, the number of ``>`` marks it begins with. Lines of level 0 are the message's own
text. A passage is a line without its marks; normalised (lower case, single spaces) it is hashed and joined, within its
conversation, to the first message that wrote it. A message answers the earlier message that most of its level-1 passages come
from (ties: the later one); where those have no original, the least deeper level that has one serves. Following answers to their beginning by pointer doubling gives thread and depth, and replies
sorted by thread, depth and turn stand after what they answer, without quotes.

Own lines are reduced to one row per conversation and hash before the join, so a line that everybody repeats stays one row;
no window or group holds a conversation. Every row comes back. Rows with null conversation or turn are left unlinked (root: their
turn, depth 0), as are those with a null or empty text; of rows that repeat a turn, the one with the least text (then role) stands for
it and the others are left unlinked. Blank passages link nothing. Columns but the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import compute
from .common import copies, materialize, query, table

_MARKS = r"^((?:[ \t]*>)*)"


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[^>]", ""))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash) per line that is not blank."""
    lines = messages.select("conv_id", "turn", F.explode(F.split("body", "\n")).alias("line"))
    lines = compute(lines, level=level_of(F.col("line")), passage=normalised(F.col("line"))).filter("passage <> ''")
    return lines.select("conv_id", "turn", "level", F.sha2("passage", 256).alias("hash"))


def own_text(body: Column) -> Column:
    """The body without quoted lines."""
    kept = F.filter(F.split(body, "\n"), lambda s: ~s.rlike(r"^[ \t]*>"))
    return F.regexp_replace(F.array_join(kept, "\n"), r"\s+$", "")


def parents(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, n_quoted): the message each one answers, and how many passages of one level show it."""
    lines = materialize(passages(messages), "passages")
    # stored, so that the join with it has a shuffle on either side, which adaptive execution splits at a frequent line
    written = materialize(lines.filter("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")), "written")
    quoted = lines.filter("level >= 1").groupBy("conv_id", "turn", "level", "hash").agg(F.count("*").alias("n"))
    found = quoted.join(written, ["conv_id", "hash"]).filter("origin < turn").groupBy("conv_id", "turn", "level", "origin").agg(F.sum("n").alias("n"))
    return found.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "n", "origin")).alias("best")).select(
        "conv_id", "turn", F.col("best.origin").alias("parent"), F.col("best.n").alias("n_quoted")
    )


def threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) by pointer doubling over (conv_id, turn, parent); roots have no parent."""
    now = materialize(
        answers.select(
            "conv_id", "turn", F.coalesce("parent", "turn").alias("root"), F.col("parent").isNotNull().cast("int").alias("depth"), F.col("parent").isNull().alias("ended")
        ), "jumps",
    )
    # a message that has reached its beginning rests; only those in longer threads go on
    while not (moving := now.filter("NOT ended")).isEmpty():
        far = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"), F.col("ended").alias("last"))
        moved = moving.join(far, ["conv_id", "root"]).select("conv_id", "turn", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("last").alias("ended"))
        now = materialize(now.filter("ended").union(moved), "jumps")
    return now.drop("ended")


def link(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, root, depth, parent, n_quoted, text) of messages (conv_id, turn, role, body), one per row."""
    rows = materialize(
        messages.select("conv_id", "turn", "role", F.coalesce("body", F.lit("")).alias("body")).groupBy("conv_id", "turn", "role", "body").agg(F.count("*").alias("_n")), "rows"
    )
    keyed = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    messages = materialize(
        keyed.groupBy("conv_id", "turn").agg(F.min(F.struct("body", "role")).alias("m"), F.sum("_n").alias("rows")).select("conv_id", "turn", "m.role", "m.body", "rows"), "messages"
    )
    crowded = messages.filter("rows > 1").select("conv_id", "turn", F.col("role").alias("_role"), F.col("body").alias("_body"))
    stands = F.col("role").eqNullSafe(F.col("_role")) & (F.col("body") == F.col("_body"))
    others = keyed.join(crowded, ["conv_id", "turn"]).withColumn("_n", F.col("_n") - stands.cast("long")).filter("_n > 0")
    alone = copies(others.select(rows.columns).union(rows.filter("conv_id IS NULL OR turn IS NULL")))
    answers = materialize(messages.select("conv_id", "turn").join(parents(messages), ["conv_id", "turn"], "left"), "answers")
    linked = (
        messages.select("conv_id", "turn", "role", own_text(F.col("body")).alias("text"))
        .join(answers, ["conv_id", "turn"]).join(threads(answers), ["conv_id", "turn"])
        .select("conv_id", "turn", "role", "root", "depth", "parent", F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), "text")
    )
    return linked.unionByName(
        alone.select("conv_id", "turn", "role", F.col("turn").alias("root"), F.lit(0).alias("depth"), F.lit(None).cast(messages.schema["turn"].dataType).alias("parent"),
                     F.lit(0).cast("long").alias("n_quoted"), own_text(F.col("body")).alias("text"))
    )


#: Of this many turns, one quotes lines that nobody wrote.
LOST = 5


def as_mail(conversations: DataFrame) -> DataFrame:
    """Turns as mail: each quotes the turn before it, and within that the turn before that one.

    Every fifth turn has the word "lost" before the lines of its first quote, which then have no original. Of rows that
    repeat a turn the least text is quoted; rows with null keys quote nothing.
    """
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    quoted = turns.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))

    def before(k: int, name: str) -> DataFrame:
        return quoted.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(name))

    def marked(name: str, mark: Column) -> Column:
        return F.concat(F.lit("\n"), mark, F.replace(F.col(name), F.lit("\n"), F.concat(F.lit("\n"), mark)))

    both = turns.join(before(1, "one"), ["conv_id", "turn"], "left").join(before(2, "two"), ["conv_id", "turn"], "left")
    first = F.when(F.pmod("turn", F.lit(LOST)) == LOST - 1, "> lost ").otherwise("> ")
    body = F.concat("text", F.coalesce(marked("one", first), F.lit("")), F.coalesce(marked("two", F.lit("> > ")), F.lit("")))
    return both.select("conv_id", "turn", "role", body.alias("body"))


_SQL = r"""
WITH RECURSIVE r AS (SELECT conv_id, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(text, ''), role NULLS FIRST) AS k FROM conversations),
m AS (SELECT conv_id, turn, text FROM r WHERE k = 1 AND conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, turn, s, lower(trim(regexp_replace(s, '\s+', ' ', 'g'))) AS p FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS s FROM m)),
w AS (SELECT conv_id, p, min(turn) AS origin FROM l WHERE p <> '' GROUP BY ALL),
q AS (SELECT conv_id, turn + 1 AS turn, 1 AS level, CASE WHEN (turn + 1) % 5 = 4 THEN lower(trim(regexp_replace('lost '||s, '\s+', ' ', 'g'))) ELSE p END AS p FROM l
    UNION ALL SELECT conv_id, turn + 2, 2, p FROM l),
c AS (SELECT q.conv_id, q.turn, level, origin, count(*) AS n FROM q JOIN m ON m.conv_id = q.conv_id AND m.turn = q.turn JOIN w ON w.conv_id = q.conv_id AND w.p = q.p WHERE q.p <> '' AND origin < q.turn GROUP BY ALL),
a AS (SELECT conv_id, turn, origin AS parent, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, origin DESC) AS k FROM c) WHERE k = 1),
t AS (SELECT m.conv_id, m.turn, m.turn AS root, 0 AS depth FROM m LEFT JOIN a USING (conv_id, turn) WHERE a.parent IS NULL
    UNION ALL SELECT a.conv_id, a.turn, t.root, t.depth + 1 FROM t JOIN a ON a.conv_id = t.conv_id AND a.parent = t.turn)
SELECT t.conv_id, t.turn, t.root, t.depth, a.parent, CAST(coalesce(a.n, 0) AS BIGINT) AS n_quoted, sha256(regexp_replace(m.text, '\s+$', '')) AS text_sha256
FROM t JOIN m USING (conv_id, turn) LEFT JOIN a USING (conv_id, turn)
UNION ALL SELECT conv_id, turn, turn, 0, NULL, 0, sha256(regexp_replace(text, '\s+$', '')) FROM r WHERE k > 1 OR conv_id IS NULL OR turn IS NULL
"""


@query("op6_quotes", _SQL)
def op6_quotes(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return link(as_mail(turns)).select("conv_id", "turn", "root", "depth", "parent", "n_quoted", F.sha2("text", 256).alias("text_sha256"))
