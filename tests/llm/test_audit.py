"""The filter audit against its SQL and against a walk of every document through every order."""

import re
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from contrail.llm import audit
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "de"), (3, PROSE, None), (None, PROSE, "en"), (4, None, None), (5, "", ""), (6, "", "fr"), (7, "a b a b a", "en"),
    (8, "Two Words", "en"), (9, "the the " * 150, "en"), (10, PROSE + " #tag", "de"), (11, "AB é", "de"), (12, "é" * 30 + "A", "de"), (13, "x|y", "en"), (14, " \t\n\x0b ", "en"),
    (15, "word Word WORD word", "en"), (16, " ".join(f"v{i % 99}" for i in range(200)), "en"), (17, " ".join(f"v{i % 100}" for i in range(200)), "en"), (1, PROSE, "en"),
    (18, "long " * 40000, "fr"), (0, "long " * 40000, "fr"),
]
LABELS = [(1, 1, 0), (1, 0, 0), (3, 1, 1), (4, 1, None), (7, 0, 1), (9, 1, 1), (99, 1, 1), (None, 1, 1), (10, None, 1)]


def walked(docs, labels):
    """{(part, order, step): counts} by walking each document through each order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = {}
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {f for f, x in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                                             re.search("[#$%&*|]", text), i is not None and i > least[text])) if x}
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                cell = out.setdefault((lang or "", order, step), [0] * 7)
                earlier = bool(fails & set(order[:step - 1]))
                removed = f in fails and not earlier
                for k, x in enumerate((not fails & set(order[:step]), removed, f in fails and earlier, fails == {f}, removed and i in good, removed and i in toxic)):
                    cell[k] += bool(x)
    for (part, order, step), cell in out.items():
        cell[6] = sum(c[1] for (p, o, s), c in out.items() if p == part and o[s - 1] == order[step - 1])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumns({c: F.lit(9) for c in ("part", "mask", "digest", "first", "good", "n")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit(7))
    return docs, labels


def test_every_order_of_odd_rows(spark, odd):
    got = audit.audit(spark, *odd)
    assert rows_of(got) == walked(ROWS, LABELS) and got.count() == 600 * 4
    assert dict(got.dtypes)["step"] == "int" and {dict(got.dtypes)[c] for c in [*audit.MEASURES, "shapley"]} == {"bigint"}


def test_no_rows_and_no_labels(spark, odd):
    docs, labels = odd
    assert audit.audit(spark, docs.limit(0), labels).count() == 0
    assert rows_of(audit.audit(spark, docs, labels.limit(0))) == walked(ROWS, [])


def test_shares_of_a_part_add_up(spark):
    rows = rows_of(audit.query(spark, SF001))
    for part in {p for p, _, _ in rows}:
        last = {o: c[0] for (p, o, s), c in rows.items() if p == part and s == 5}
        removed = {o: sum(c[1] for (p, q, _), c in rows.items() if p == part and q == o) for o in last}
        assert len(set(last.values())) == 1 and len(set(removed.values())) == 1  # the order changes neither what stays nor what goes
        shares = {o[s - 1]: c[6] for (p, o, s), c in rows.items() if p == part}
        assert sum(shares.values()) == 120 * next(iter(removed.values()))


def test_sql(spark, odd, tmp_dir):
    odd[0].write.parquet(f"{tmp_dir}/documents.parquet")
    odd[1].write.parquet(f"{tmp_dir}/labels.parquet")
    for sf, files in ((SF001, ""), (tmp_dir, "/*.parquet")):
        con = duckdb.connect()
        for t in ("documents", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet{files}')")
        df = audit.query(spark, sf)
        want = con.execute(audit.ORACLE)
        columns = [d[0] for d in want.description]
        assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall()) and sorted(df.columns) == sorted(columns)


def test_plan_has_no_python_and_no_nested_loop(spark):
    plan = audit.query(spark, SF001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
