"""Line dedup against SQL, and its edge cases."""

import random

import duckdb
from pyspark.sql import functions as F

from llm.linededup import dedup_lines, dropped_lines, sql

SCHEMA = "doc_id long, text string"


def _rows(df):
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in df.collect()}


def test_recurring_lines_keep_their_first(spark):
    own = ["ab cd ef", "the cat sat there", "one two three four five", "x y z", "so it goes on", "nothing in common"]
    docs = spark.createDataFrame([(i, f"{line}\nAll rights reserved.") for i, line in enumerate(own)], SCHEMA)
    got = _rows(dedup_lines(docs, min_docs=5))
    assert got[0] == ("ab cd ef\nAll rights reserved.", 0)
    assert got[3] == ("x y z", 1)


def test_variable_fields_are_generalised(spark):
    names = "amber birch cedar dahlia elm fir".split()
    docs = spark.createDataFrame(
        [(i, f"posted by the user {n} on page {i} of this very forum") for i, n in enumerate(names)]
        + [(10, "posted by the quick brown foxes over there in our own garden")], SCHEMA)
    got = _rows(dedup_lines(docs, min_docs=5))
    assert [got[i][1] for i in range(6)] == [0, 1, 1, 1, 1, 1]
    assert got[10] == ("posted by the quick brown foxes over there in our own garden", 0)


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "\n\n"), (None, "a b c d\nx"), (5, "a b c d"), (5, "a b c d"), (6, "a b c d"), (7, "a b c d")], SCHEMA
    ).withColumn("n_dropped", F.lit("clash"))
    got = [tuple(r) for r in dedup_lines(docs, min_docs=3).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, None, 0, 0), (2, "", 1, 0), (3, "\n\n", 3, 0), (None, "a b c d\nx", 2, 0), (5, "", 1, 1), (5, "", 1, 1), (6, "", 1, 1), (7, "", 1, 1)],
        key=repr,
    )
    assert dedup_lines(docs.where("false")).count() == 0
    assert dropped_lines(docs.select("doc_id", "text").where("false")).count() == 0


def test_random_texts_equal_sql(spark):
    rng = random.Random(3)
    words = ["ab", "cd", "e7", "fg", "h.", "12", "xyz"]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 7))) for _ in range(30)]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", "", "  tail", " 9"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    mine = dedup_lines(docs, min_docs=4, constant_share=0.6, long_line=6).select("doc_id", "text", "n_lines", "n_dropped")
    theirs = con.execute(sql(4, 0.6, 6)).fetchall()
    assert sorted(map(tuple, mine.collect())) == sorted(theirs)
    assert sum(r[3] for r in theirs) > 50


def test_long_lines_recur_from_two_documents(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    short = "see you all there"
    docs = spark.createDataFrame([(i, f"{passage}\n{short}\nits own {c}") for i, c in enumerate("abc")], SCHEMA)
    assert _rows(dedup_lines(docs)) == {
        0: (f"{passage}\n{short}\nits own a", 0), 1: (f"{short}\nits own b", 1), 2: (f"{short}\nits own c", 1)}


def test_fields_do_not_depend_on_the_number_of_rows(spark):
    def dropped(names, topics, copies):
        lines = [f"posted by the user n{chr(97 + i % 26)}{chr(97 + i // 26)} in t{chr(97 + j % 26)}{chr(97 + j // 26)} on one page of our forum"
                 for i in range(names) for j in range(topics)] * copies
        docs = spark.createDataFrame(list(enumerate(lines)), SCHEMA)
        return docs.count() - dedup_lines(docs).where("n_dropped = 0").count(), len(lines)

    for names, topics, copies in ((10, 10, 1), (30, 10, 1), (30, 30, 1), (10, 10, 10)):
        gone, rows = dropped(names, topics, copies)
        assert gone == rows - 1


def test_very_long_texts(spark):
    lines = [f"line that many share {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} and so on it goes" for i in range(6_000)]
    rows = [(d, "\n".join(x for i, line in enumerate(lines) for x in (line, f"z{d} {i}") if i % 2 or x == line)) for d in range(3)]
    got = dedup_lines(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert got[0]["n_dropped"] <= got[1]["n_dropped"] == got[2]["n_dropped"]
    assert all(r["n_lines"] == 9_000 and len(r["text"].split("\n")) == 9_000 - r["n_dropped"] for r in got)
