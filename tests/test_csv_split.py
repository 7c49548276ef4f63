"""Records cut from byte ranges equal those of Spark's reader, which gives a file to one task."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from strata.session import scratch_path
from strata.sources.csv_drops import CSV_OPTIONS, read_drops
from strata.sources.csv_split import inside_after, ranges_of, read_records

HEADER = "Key,Some Text,Other"


def text_of(rng: random.Random, rows: int, end: str = "\n") -> str:
    """Rows with quoted separators, doubled quotes, line breaks, long quoted fields, short and long rows, stray quotes."""
    fields = ("plain", "", '"quoted, twice"', '"a ""name"" of it"', f'"two{end}lines"', f'"{end}{end}"', '""', '6" pipe',
              f'"long {end} ' + f"words without any quote{end}" * 12 + 'end"', "中é")
    out = [HEADER]
    for i in range(rows):
        kind = rng.random()
        own = [str(i), rng.choice(fields), rng.choice(fields)]
        out.append(",".join(own[:2] if kind < 0.1 else own + ["extra"] if kind < 0.2 else own))
        if kind > 0.95:
            out.append("")
    return end.join(out) + (end if rng.random() < 0.5 else "")


@pytest.fixture()
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(df):
    return sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("size", [64, 333, 5000])
def test_equals_the_whole_file_reader(spark, scratch, small_ranges, size):
    root, rng = fx.local(scratch), random.Random(size)
    for i in range(3):
        fx.write(f"{root}/a{i}.csv", text_of(rng, 60))
    fx.write(f"{root}/empty_body.csv", HEADER + "\n")
    fx.write(f"{root}/wide.csv", "Other,Key,New Column\nx,1,y\n\"p\nq\",2,\"z\nz\"\n")
    fx.write(f"{root}/lone.csv", HEADER + '\n1,"x "y" z",w\n2,"x "y\nz",w\n3,"x" y,"p\nq"\n4,"k ""l"" m\n","e"\n5,"a"b",c\n6,p,q\n')
    declared = ["key", "some_text", "other"]
    want = rows_of(read_drops(spark, root, declared=declared, split_above=None))
    small_ranges(size)
    got = read_drops(spark, root, declared=declared, split_above=0)
    assert rows_of(got) == want and len(want) > 180


def test_carriage_returns_and_a_file_of_one_record(spark, scratch, small_ranges):
    root = fx.local(scratch)
    path = os.path.join(root, "crlf.csv")
    os.makedirs(root, exist_ok=True)
    with open(path, "wb") as f:
        f.write(text_of(random.Random(5), 40, "\r\n").encode())
    want = rows_of(read_drops(spark, root, split_above=None))
    small_ranges(100)
    assert rows_of(read_drops(spark, root, split_above=0)) == want
    fx.write(f"{root}/one/open.csv", 'a\n"never closed\n' + "line\n" * 100)
    assert [r["record"] for r in read_records(spark, [f"{root}/one/open.csv"]).collect()] == ['"never closed\n' + "line\n" * 99 + "line"]


def test_one_file_is_many_tasks_and_lines_are_not_shuffled(spark, scratch, small_ranges):
    root = fx.local(scratch)
    fx.write(f"{root}/big.csv", text_of(random.Random(9), 400))
    small_ranges(2000)
    lines = spark.read.option("lineSep", "\n").text(f"{root}/big.csv")
    assert lines.rdd.getNumPartitions() > 10
    raw = lines.select(F.lit(1).cast("long").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                       F.col("value").cast("binary").alias("value"))
    states = {r["range"]: (r["begins"], r["ends"]) for r in ranges_of(raw).collect()}
    assert states[0][0] is False and len(states) > 10
    inside = False
    with open(f"{root}/big.csv", "rb") as f:      # the states, by one walk over the file
        at = 0
        for line in f:
            # a line belongs to the range before its first byte
            begins = [s for s in states if 0 < s and at - len(prior) <= s < at] if at else [0]
            for s in begins:
                assert states[s][0] == inside
            inside, prior, at = inside_after(line.rstrip(b"\n"), inside), line, at + len(line)


@pytest.mark.parametrize("line, outside, inside", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'"a""b"', False, False), (b'a,5" x', False, False), (b'"a" ,"b', True, True),
    (b'"a"b,c', False, False), (b'x""y', False, True), (b'x",y', False, False), (b'x","y', True, True), (b"", False, True)])
def test_state_after_a_line(line, outside, inside):
    assert (inside_after(line, False), inside_after(line, True)) == (outside, inside)
