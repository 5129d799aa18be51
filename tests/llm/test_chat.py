from tallyloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place string, node string"


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "p", "n") for r in rows], SCHEMA)
    got = chat.conversations(frame).collect()
    return {(r["conv_id"], r["turn"]): r for r in got}, got


def test_levels():
    assert chat.quote_level("plain") == (0, "plain")
    assert chat.quote_level(" > > deep one") == (2, "deep one")
    assert chat.quote_level(">>x") == (2, "x")
    body, quoted, own = chat.parsed("> one two three\n>> four five six\n\nmine is this line")
    assert body == "mine is this line" and own == ["mine is this line"]
    assert quoted == [(0, 1, "one two three"), (1, 2, "four five six")]


def test_replies_are_ordered_and_lose_their_quotes(spark):
    got, rows = run(
        spark,
        [
            (1, 0, "user", "How do I sort a list?\nAnd a map by value?"),
            (1, 1, "user", "A new question about something else"),
            (1, 2, "assistant", "> how do i  SORT a list?\nUse the sort function for that"),
            (1, 3, "assistant", "> A new question about something else\nThat depends on many things"),
            (1, 4, "user", "> Use the sort function for that\n>> How do I sort a list?\nThanks, that works very well"),
            (1, 5, "user", "> words that nobody wrote here\nSo they say in town"),
            (2, 0, "user", "> How do I sort a list?\nquoted from another conversation"),
        ],
    )
    order = [r["turn"] for r in sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: r["place"])]
    assert order == [0, 2, 4, 1, 3, 5]
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, None, 0, 1, 2, None]
    assert [got[1, t]["depth"] for t in range(6)] == [0, 0, 1, 1, 2, 0]
    assert got[1, 4]["root_turn"] == 0 and got[1, 4]["body"] == "Thanks, that works very well"
    assert got[1, 4]["n_linked"] == 2 and got[2, 0]["reply_to"] is None


def test_long_chain_and_common_line(spark):
    rows = [(1, 0, "user", "message number 0 is here\nthe very common line of all")]
    rows += [(1, t, "user", f"> message number {t - 1} is here\n> the very common line of all\nmessage number {t} is here\nthe very common line of all") for t in range(1, 40)]
    got, all_rows = run(spark, rows)
    # a passage of two lines: each has one vote, the later message wins
    assert [got[1, t]["depth"] for t in range(40)] == list(range(40))
    assert sorted(r["place"] for r in all_rows) == list(range(40))


def test_nulls_ties_and_empty(spark):
    got, rows = run(spark, [(None, None, None, None), (None, 0, "user", ""), (1, None, "user", "x"), (1, 0, "user", "same"), (1, 0, "user", "same"), (1, 0, "user", "> a b c")])
    assert len(rows) == 6
    assert [r["place"] for r in sorted(rows, key=lambda r: (r["conv_id"] or 0, r["place"]))] == [0, 1, 0, 1, 2, 3]
    assert got[None, None]["body"] is None and got[None, None]["place"] == 1 and got[1, None]["place"] == 3
    assert any(r["body"] == "" and r["n_quoted"] == 1 for r in rows)
    assert chat.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signature_does_not_outvote_the_quoted_message(spark):
    mark = "\nkind regards from all of us\nthe office on main street"
    rows = [(1, t, "user", f"message number {t} is here{mark}") for t in range(80)]
    quote = lambda text: "\n".join(f"> {x}" for x in text.split("\n"))
    rows += [(1, 100, "user", quote(f"message number 5 is here{mark}") + "\nthank you for this one")]
    # not whole: a line between is left out, then one nobody wrote is added
    rows += [(1, 101, "user", "> message number 6 is here\n> the office on main street\nand this one too")]
    rows += [(1, 102, "user", quote(f"message number 7 is here{mark}\nnobody ever wrote this") + "\nand the last one")]
    rows += [(2, 0, "user", "the same words again"), (2, 1, "user", "the same words again"), (2, 2, "user", "> the same words again\nas you both say")]
    got, _ = run(spark, rows)
    assert [got[1, t]["reply_to"] for t in (100, 101, 102)] == [5, 6, 7]
    assert got[2, 2]["reply_to"] == 1


def test_message_with_most_common_lines_wins(spark):
    one, two = "the first common line", "the second common line"
    texts = [f"{one}\n{two}", f"{one}\nmy own words\n{two}"] + [one] * 70 + [two] * 70
    rows = [(1, t, "user", text) for t, text in enumerate(texts)]
    rows += [(None, t, "user", text) for t, text in enumerate(texts)]
    quote = f"> {one}\n> nobody ever wrote this\n> {two}\nmy answer"
    rows += [(1, 200, "user", quote), (1, 201, "user", quote), (None, 200, "user", quote), (1, 202, "user", f"> {one}\n> my own words\n> {two}\n> and some more\nyes")]
    got, _ = run(spark, rows)
    # later messages have one of the two lines each
    assert [got[c, t]["reply_to"] for c, t in ((1, 200), (1, 201), (None, 200), (1, 202))] == [1, 1, 1, 1]


def test_short_and_unspaced_passages_link(spark):
    rows = [(1, 0, "user", "Why?\nplease tell me"), (1, 1, "user", "今天天气怎么样"), (1, 2, "user", "Yes, please"), (1, 3, "user", "> why?\nbecause"),
            (1, 4, "user", "> 今天天气怎么样\n很好"), (1, 5, "user", "> Yes, please\nok")]
    got, _ = run(spark, rows)
    assert [got[1, t]["reply_to"] for t in (3, 4, 5)] == [0, 1, 2]
    short, _ = run(spark, [(1, 0, "user", "ok\nfine by me"), (1, 1, "user", "> ok\n> nobody wrote this\nso"), (1, 2, "user", "> ok\ngood")])
    assert short[1, 1]["reply_to"] is None and short[1, 2]["reply_to"] == 0
