"""Quotation linking against its SQL and hand-made threads."""

import random

import duckdb
import pandas as pd
from pyspark.sql import types as T

from pairgrade.llm.quotes import SQL, in_reply_order, linked_conversations

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def frame(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumn("mark", F.lit("x")).withColumn("depth", F.lit(1))


def case():
    rng = random.Random(8)
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rng.randint(1, 9)):
            lines = [rng.choice(["Yes.", "no  way", "", "See é", f"text {conv} {rng.randint(0, 5)}"])
                     for _ in range(rng.randint(0, 3))]
            for _ in range(rng.randint(0, 2) if said else 0):
                quoted = rng.choice(said).split("\n")
                lines += [rng.choice(["> ", ">", " > "]) + q.upper() for q in quoted] + [f"own {turn}"]
            lines += rng.choice([[], ["> nobody said this"], [">"]])
            said.append("\n".join(lines))
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), said[-1]))
    return rows + [(100, 0, "user", None), (100, 1, "user", ""), (None, 3, "user", "> Yes."), (101, None, "user", "> a"),
                   (101, 0, "user", "a")]


def test_matches_sql(spark):
    rows = case()
    got = linked_conversations(frame(spark, rows)).toPandas()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=SCHEMA.names).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    want = con.sql(SQL).df()
    key = lambda d: sorted(map(
        str, ([None if pd.isna(x) else int(x) if not isinstance(x, str) else x for x in r] for r in d[list(want.columns)].itertuples(index=False))))
    assert key(got) == key(want)
    assert got.reply_to.notna().sum() > 10 and (got.level > 1).any()


def test_threads(spark):
    rows = [(1, 0, "user", "How do I sort?\nAnd merge?"), (1, 1, "user", "What is a heap?"),
            (1, 2, "assistant", "> how do i  SORT?\nUse sorted.\n> And merge?\nUse merge."),
            (1, 3, "assistant", "> What is a heap?\nA tree."),
            (1, 4, "user", "> > How do I sort?\n> Use sorted.\nThanks\n> lost words"),
            (2, 0, "user", "What is a heap?")]
    got = {(r.conv_id, r.turn): r for r in linked_conversations(frame(spark, rows)).collect()}
    assert [got[1, t].reply_to for t in range(5)] == [None, None, 0, 1, 2]
    assert [got[1, t].thread for t in range(5)] == [0, 1, 0, 1, 0]
    assert [got[1, t].level for t in range(5)] == [0, 0, 1, 1, 2]
    assert got[1, 2].text == "Use sorted.\nUse merge." and got[1, 2].n_quotes == 2
    assert got[1, 4].text == "Thanks\n> lost words" and got[1, 4].formatted.startswith("<|user|>\nThanks")


def test_repeated_and_empty(spark):
    rows = [(1, 0, "user", "a")] * 2 + [(1, 1, "user", "> a\nb")] * 3 + [(1, 1, "assistant", "> a\nc")]
    got = linked_conversations(frame(spark, rows)).collect()
    assert len(got) == 6 and sorted(r.text for r in got) == ["a", "a", "b", "b", "b", "c"]
    assert linked_conversations(frame(spark, [])).count() == 0


def test_only_lines_with_a_source_go(spark):
    rows = [(1, 0, "user", "Hello\nThanks,"),
            (1, 1, "user", "> Thanks,\n> a long passage from an outside letter\n>\n> that stands nowhere else\nmy answer"),
            (1, 2, "user", "> Hello\n>\n> Thanks,\nall of it")]
    got = {r.turn: r for r in linked_conversations(frame(spark, rows)).collect()}
    assert got[1].text == "> a long passage from an outside letter\n>\n> that stands nowhere else\nmy answer"
    assert got[1].reply_to == 0 and got[1].n_quotes == 1
    assert got[2].text == "all of it"


def test_reply_order_with_branches(spark):
    """Parent, then each child with all that follows from it, by turn."""
    rng = random.Random(3)
    parent, rows = {0: None, 1: None}, [(5, 0, "user", "line 0"), (5, 1, "user", "line 1")]
    for turn in range(2, 40):
        parent[turn] = rng.randrange(turn)
        rows.append((5, turn, "user", f"> line {parent[turn]}\nline {turn}"))
    children = {}
    for turn, up in parent.items():
        children.setdefault(up, []).append(turn)

    def walk(turn):
        return [turn] + [t for child in children.get(turn, []) for t in walk(child)]

    out = linked_conversations(frame(spark, rows + [(4, 12, "user", "x"), (4, 3, "user", "y")]))
    got = [(r.conv_id, r.turn) for r in in_reply_order(out).collect()]
    assert got == [(4, 3), (4, 12)] + [(5, t) for t in walk(0) + walk(1)]


def test_long_texts(spark):
    long = "\n".join(f"said {n}" for n in range(30_000))
    rows = [(1, 0, "user", long), (1, 1, "user", "\n".join("> " + x for x in long.split("\n")) + "\nyes"),
            (1, 2, "user", "> " + "w" * 300_000 + "\nno")]
    got = {r.turn: r for r in linked_conversations(frame(spark, rows)).collect()}
    assert (got[1].text, got[1].reply_to, got[2].reply_to) == ("yes", 0, None)
