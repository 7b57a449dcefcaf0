import re
import time
from collections import Counter

import pytest

from grainmill.llm.line_dedup import FANOUT, LineRuns, dedup_lines, without_frequent_lines
from grainmill.llm.oracles import ORACLES
from grainmill.llm.quality import judge, without_common_lines
from grainmill.llm.queries import QUERIES
from tests.oracle import assert_same

S = " \t\n\x0b\x0c\r"
ODD = [(1, None), (2, ""), (3, "\n\n"), (4, " A b \nx\na B"), (4, " A b \nx\na B"), (None, "a b\t\nq\n a b"), (5, "A B\n" * 3000), (6, "É\né"), (7, "a\x00b")]


@pytest.mark.parametrize("name", ["op4_quality_rules", "op7_line_dedup"])
def test_query_equals_its_sql(spark, small, name):
    assert_same(QUERIES[name](spark, small), ORACLES[name], small)


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup_on_odd_rows(spark, batches):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, n_lines string")
    keys = Counter(k for _, t in ODD for k in {low(x.strip(S)) for x in (t or "").split("\n")} if k)
    rows = dedup_lines(docs, 3, batches=batches).collect()
    want = []
    for i, t in ODD:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keys[low(x.strip(S))] < 3]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    whole = without_frequent_lines(docs, 3, batches=batches)
    assert whole.columns == docs.columns and sorted(str(r.text) for r in whole.collect()) == sorted(str(w[3]) if t is not None else "None" for w, (_, t) in zip(want, ODD))
    assert dedup_lines(docs.limit(0), 3).count() == 0


def test_repeated_ids_are_documents_of_their_own(spark, tmp_path):
    """Nine rows hold a line under ids of their own and two more under one of those: eleven documents in code and SQL."""
    own = "one two three four five six seven eight nine ten"
    rows = [(i % 9, f"{own} {i}\nshared", "h") for i in range(11)] + [(20 + i, f"{own} x{i}\nrare", "h") for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert_same(QUERIES["op7_line_dedup"](spark, str(tmp_path)), ORACLES["op7_line_dedup"], str(tmp_path))
    assert_same(QUERIES["op4_quality_rules"](spark, str(tmp_path)), ORACLES["op4_quality_rules"], str(tmp_path))
    assert QUERIES["op7_line_dedup"](spark, str(tmp_path)).where("n_dropped = 1").count() == 11


def test_runs_are_merged_by_level_and_find_every_frequent_key(spark):
    """Keys of which each batch holds a few alone, and keys that become frequent in one batch."""
    runs, want = LineRuns(spark, 7), Counter()
    for b in range(11):
        keys = [k for k in range(40) for _ in range((k * (b + 3)) % 5 == 0 and k % 4)] + [100 + b] * 9 + [200] * (b == 10)
        want.update(keys)
        runs.add(spark.createDataFrame([(k, -k) for k in keys], "k1 long, k2 long"))
        assert all(len(level) < FANOUT for level in runs.levels)
    assert len(runs.levels) == 3
    assert sorted(r.k1 for r in runs.close().collect()) == sorted(k for k, n in want.items() if n >= 7)


@pytest.mark.parametrize("run", [lambda d: dedup_lines(d, 10), judge], ids=["line_dedup", "quality"])
def test_many_distinct_lines_take_time_in_proportion(spark, run):
    took = []
    for n in (1000, 20_000, 80_000):
        docs = spark.createDataFrame([(1, "\n".join(f"line {i}" for i in range(n)), "h")], "doc_id long, text string, source string")
        began = time.perf_counter()
        run(docs).collect()
        took.append(time.perf_counter() - began)
    assert took[2] < 4 * took[1] + 4


def brute(text):
    text = text or ""
    w = re.findall("[^ \t-\r]+", text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(S)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def test_quality_on_odd_rows(spark):
    odd = ODD + [(8, "a b c d e " * 2), (9, "a b c d e f a b c d e"), (10, "q " * 5), (11, "q " * 6), (12, "ab#$ é%\n" * 4000)]
    docs = spark.createDataFrame([(*r, None if k % 3 else "h", 1) for k, r in enumerate(odd)], "doc_id long, text string, source string, kept int")
    rows = judge(docs, max_docs=1).collect()
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows)
    assert got == sorted(str((i, *brute(t))) for i, t in odd)
    assert judge(docs.limit(0)).count() == 0
    assert all(0 <= r.share_left <= 1 for r in rows)


def test_common_lines_deplete_within_a_host_only(spark):
    words = "one two three four five six seven eight nine ten eleven"
    rows = [(i, f"{words} same\nown{i}", "a") for i in range(5)] + [(9, f"{words} same\nown", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in judge(docs, max_docs=4).collect()}
    assert kept == {0: False, 1: False, 2: False, 3: False, 4: False, 9: True}


def test_quality_equals_its_sql_where_lines_pass_the_limit(spark, tmp_path):
    """101 documents of a host hold a line, just above the limit, and 100 of another, at it."""
    own = "one two three four five six seven eight nine ten"
    rows = [(i, f"{own} {i}\n Shared line \nshared LINE" + "\nlong common footer of this host" * (i % 3), "a") for i in range(101)]
    rows += [(200 + i, f"{own} {i}\nshared line", "b") for i in range(100)] + [(900, f"{own}\nshared line", None), (901, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/plain")
    spark.read.parquet(f"{tmp_path}/plain").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert_same(judge(docs), ORACLES["op4_quality_rules"], str(tmp_path))
    assert sum(r.n_lines_removed for r in judge(docs).collect()) == 202


def test_common_lines_are_taken_out_of_the_texts(spark):
    docs = [(*r, "h", 1) for r in ODD] + [(20, "Same\n\nown\n same", None, 2), (21, "same\nx", None, 3), (22, "same\nx", "h", 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, r1 int")
    held = Counter((h, k) for _, t, h, _ in docs for k in {low(x.strip(S)) for x in (t or "").split("\n")} if k)
    cut = lambda t, h: "\n".join(x for x in t.split("\n") if held[h, low(x.strip(S))] < 2)
    got = without_common_lines(df, max_docs=1)
    assert got.columns == df.columns
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str((i, None if t is None else cut(t, h), h, n)) for i, t, h, n in docs)
    removed = {r.doc_id: r.n_lines_removed for r in judge(df, max_docs=1).collect()}
    assert removed[20] == 2 and removed[21] == 1 and removed[22] == 1
