import random

import duckdb
import pyarrow as pa

from strata.llm.line_dedup import OP5_SQL, drop_recurring_lines
from tests.llm.data import awkward, frame, prose, row


def page(rng, i, lines):
    body = [prose(rng, rng.randrange(10, 30)) for _ in range(4)]
    for x in lines:
        body.insert(rng.randrange(len(body) + 1), x)
    return row(100 + i, "\n".join(body))


def corpus():
    rng = random.Random(6)
    rows = [page(rng, i, ["Accept all cookies to go on", f"Page {i} of 40, read {i * 7} times"]) for i in range(40)]
    names = [prose(rng, 1) for _ in range(40)]
    rows += [page(rng, 50 + i, [f"Copyright notice of the great and good publishing house {n} all rights kept"])
             for i, n in enumerate(names)]
    rows += [page(rng, 100 + i, ["Only nine share this"]) for i in range(9)]
    rows += [row(300 + i, "Accept all cookies to go on\ntwo words") for i in range(3)]    # mostly recurring
    return rows


def duck(rows):
    cols = list(zip(*rows))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(cols[0], pa.int64()), "text": pa.array(cols[1], pa.string())}))
    return sorted((tuple(r) for r in con.execute(
        f"SELECT doc_id, text, n_lines, n_dropped FROM ({OP5_SQL})").fetchall()), key=repr)


def spark_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def test_equals_sql_and_drops_templates(spark):
    rows = corpus() + awkward()
    out = drop_recurring_lines(frame(spark, rows))
    assert spark_rows(out) == duck(rows)
    left = "\n".join(r["text"] for r in out.where("doc_id BETWEEN 100 AND 299").collect())
    assert "cookies" not in left and "Page" not in left          # a fixed line, and one with numbers
    assert "Copyright" not in left                               # one with a name
    assert left.count("Only nine share this") == 9
    assert out.where("doc_id >= 300 AND text LIKE '%cookies%'").count() == 3
    assert out.where("doc_id BETWEEN 100 AND 149").agg({"n_dropped": "min"}).first()[0] == 2


def test_copies_count_once_and_keep_their_text(spark):
    rng = random.Random(7)
    body = "\n".join(prose(rng, 20) for _ in range(5))
    rows = [row(i, body) for i in range(30)]
    assert spark_rows(drop_recurring_lines(frame(spark, rows))) == sorted([(i, body, 5, 0) for i in range(30)], key=repr)


def test_other_columns_pass_through_and_empty_table(spark):
    rows = awkward()
    out = drop_recurring_lines(frame(spark, rows).withColumnRenamed("size", "n_lines"))
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.columns.count("n_lines") == 1
    assert sorted((repr((r["doc_id"], r["text"], r["source"])) for r in out.collect())) == sorted(
        repr((r[0], r[1], r[3])) for r in rows)
    assert drop_recurring_lines(frame(spark, [])).count() == 0
