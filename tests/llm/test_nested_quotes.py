"""Quotes of level 2 and deeper (operator 6)."""

from __future__ import annotations

from grantspark.llm import quotes


def test_deeper_levels_serve_where_level_1_has_no_original(spark):
    mail = [
        (1, 0, "user", "Where is the hall?\nSee you"),
        (1, 1, "assistant", "Second street."),
        (1, 2, "user", "own\n> lost reply\n> > Second street.\n>>> Where is the hall?\n>>> See you"),
        (1, 3, "user", "more\n> lost\n>>> where is the hall?"),
        (1, 4, "user", "last\n> Second street.\n>> Where is the hall?\n>> See you"),
        (1, 5, "user", "none\n> lost\n>> lost too"),
    ]
    got = {r.turn: (r.root, r.depth, r.parent, r.n_quoted) for r in quotes.link(spark.createDataFrame(mail, "conv_id long, turn long, role string, body string")).collect()}
    assert got == {0: (0, 0, None, 0), 1: (1, 0, None, 0), 2: (1, 1, 1, 1), 3: (0, 1, 0, 1), 4: (1, 1, 1, 1), 5: (5, 0, None, 0)}
