"""Cuts against plain slicing, exact restoring, the skip list against prefix sums, and the SQL text."""

import hashlib
import random

import numpy as np
import regex

from shelfspark.llm import fill_in_middle as fim
from shelfspark.llm.oracles import ORACLE_SQL
from shelfspark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, key string, form string, output int, n int"


def test_skip_list_reaches_every_rank():
    rnd = random.Random(5)
    for n in (0, 1, 31, 32, 33, 1024, 1025, 5000):
        widths = np.array([rnd.choice((1, 1, 2, 9)) for _ in range(n)], np.int64)
        lanes, upto = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
        assert lanes.units == n
        for rank in range(n + 1):
            assert lanes.point(rank) == upto[rank]


def test_units_of_a_pattern_cover_the_text():
    text = "  ab c\n\ndef g "
    widths = fim.unit_widths(text, regex.compile(r"\w+"))
    assert widths.tolist() == [2, 2, 1, 1, 2, 3, 1, 1, 1] and widths.sum() == len(text)
    assert fim.unit_widths("", regex.compile(r"\w+")).tolist() == []


def plain(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    text = text or ""
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_against_slicing(spark):
    rnd = random.Random(2)
    signs = "aé漢😀́\n <PSM>\U0001f3fd"
    texts = [None, "", "x", "<P>", "a<M>b", "<P<S", "M>", "<", "<<S", "é" * 70_000] + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 90))) for _ in range(300)]
    rows = [(i, t, "a", "b", "c", 1, 2) for i, t in enumerate(texts)] + [(3, "x y", "a", "b", "c", 1, 2)] * 2 + [(None, "null id", "", "", "", 0, 0)]
    made = fim.transform(spark.createDataFrame(rows, SCHEMA))
    got = made.withColumn("again", fim.restored(made["output"], made["form"])).collect()
    assert sorted(map(repr, [tuple(r)[:6] for r in got])) == sorted(repr(plain(r[0], r[1])) for r in rows)
    assert {"plain", "psm", "spm"} == {r.form for r in got}
    want = {(r[0], r[1] or "") for r in rows}
    assert all((r.doc_id, r.again) in want for r in got)


def test_words_as_units(spark):
    rows = [(i, f"alpha beta  gamma {i} delta, epsilon " * 5, "", "", "", 0, 0) for i in range(40)]
    got = fim.transform(spark.createDataFrame(rows, SCHEMA), pattern=r"\s*\S+").collect()
    for r in got:
        text = rows[r.doc_id][1]
        ends = {0, len(text)} | {m.end() for m in regex.finditer(r"\s*\S+", text)}
        assert r.n == 31 and (r.form == "plain" or ({r.prefix_chars, r.prefix_chars + r.middle_chars} <= ends))


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = QUERIES["op12_fill_in_middle"](spark, sf)
    want = con.execute(ORACLE_SQL["op12_fill_in_middle"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(names).collect()))) == sorted(map(repr, want.fetchall()))
