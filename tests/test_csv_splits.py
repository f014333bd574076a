"""Quoted CSV and JSON documents read by several tasks per file, against readers of whole files."""

import csv
import io
import json
import os
import random

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog import jobs
from plumbtable.session import fresh_path
from plumbtable.sources import readers, writers
from plumbtable.sources.documents import depths
from plumbtable.sources.records import csv_records, line_step, states


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "90b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(spark, texts):
    folder = fresh_path(spark, "csv")
    os.makedirs(folder)
    for k, text in enumerate(texts):
        with open(f"{folder}/part-{k}.csv", "w", newline="") as f:
            f.write(text)
    return folder


def cells(draw, n):
    parts = ["a", "b,c", '"', '""', "\n", "\r\n", " ", "é", ",", 'x"y', "1", "\n\n", '",\n"', "long " * 9]
    return [["".join(draw.choices(parts, k=draw.randint(0, 4))) for _ in range(3)] for _ in range(n)]


def as_csv(rows, ending, quoting):
    out = io.StringIO()
    csv.writer(out, lineterminator=ending, quoting=quoting).writerows([["p", "q\n\n2", "r"], *rows])
    return out.getvalue()


@pytest.mark.parametrize(("ending", "quoting"), [("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL)])
def test_records_over_many_splits(spark, small_splits, ending, quoting):
    draw = random.Random(3)
    files = [cells(draw, 50), cells(draw, 1), cells(draw, 15), []]
    path = write(spark, [as_csv(rows, ending, quoting) for rows in files])
    lines = spark.read.text(path)
    assert lines.rdd.getNumPartitions() > 10
    got = readers.load_csv(spark, path, ["p", "q", "r"], missing=[])
    want = [tuple(c or None for c in row) for rows in files for row in rows]
    filled = [tuple(c or None for c in r) for r in got.collect()]
    assert sorted(map(str, filled)) == sorted(map(str, want))


def test_one_file_is_written_by_several_tasks(spark, small_splits, monkeypatch):
    """The query's file takes each row from the task that has it, and stays one file."""
    text = F.concat(F.lit('a "b",\n'), F.col("id").cast("string"))
    task = F.udf(lambda _: str(TaskContext.get().partitionId())).asNondeterministic()
    rows = spark.range(0, 40, 1, 4).select(F.col("id").alias("doc_id"), text.alias("text"), task("id").alias("source"))
    seen = []
    monkeypatch.setattr(jobs, "table", lambda *_: rows)
    monkeypatch.setattr(jobs, "load_csv", lambda s, path: seen.append(path) or readers.load_csv(s, path))
    got = entry.queries()["csv_one_file_texts"](spark, "").collect()
    assert sorted(map(tuple, got)) == [(k, f'a "b",\n{k}', str(k // 10)) for k in range(40)]
    assert len([f for f in os.listdir(seen[0]) if f.endswith(".csv")]) == 1


def test_one_file_has_the_bytes_of_one_writer(spark):
    draw = random.Random(6)
    rows = [(k, *(c[0] if draw.random() < 0.8 else None for c in (cells(draw, 1)[0], cells(draw, 1)[0]))) for k in range(60)]
    some = spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), 'id int, `p "q"\n2` string, r string')
    path, one = fresh_path(spark, "whole csv"), fresh_path(spark, "one")
    # Empty partitions, at the start too; an earlier output is replaced; no rows.
    for df in (some, some.where("id >= 9 and id not between 20 and 40"), some.where("id < 0")):
        writers.save_csv_file(df, path)
        writers.save_csv(df.coalesce(1), one)
        (want,) = [f for f in os.listdir(one) if f.endswith(".csv")]
        assert [f for f in os.listdir(path) if f[0] not in "._"] == ["whole.csv"] and not os.path.exists(f"{path}/_parts")
        with open(f"{path}/whole.csv", "rb") as a, open(f"{one}/{want}", "rb") as b:
            assert a.read() == b.read()


def test_plain_files_need_no_index(spark, small_splits):
    rows = [[str(k), f'x "{k}", y', ""] for k in range(50)]
    path = write(spark, ["a,b,c\n" + "".join(f'{a},"{b.replace(chr(34), chr(34) * 2)}",{c}\n' for a, b, c in rows)])
    assert csv_records(spark, path) is None
    assert sorted(r["b"] for r in readers.load_csv(spark, path).collect()) == sorted(b for _, b, _ in rows)


def test_odd_quotes_inside_cells_and_an_unclosed_last_cell(spark, small_splits):
    text = 'h,i\n5" pipe,1\na"b"c,"x\ny"\n"closed" tail,"z\n""\nw"\n  \n\n6" rod,2\nlast,"open\nto the, end\n'
    got = [tuple(r) for r in readers.load_csv(spark, write(spark, [text])).collect()]
    assert sorted(got, key=str)[:5] == sorted(
        [('5" pipe', "1"), ('6" rod', "2"), ('"closed" tail', 'z\n"\nw'), ('a"b"c', "x\ny"), got[-1]], key=str
    )[:5] and ('a"b"c', "x\ny") in got and len(got) == 5


def test_line_steps_equal_a_scan_by_character(spark):
    def scan(line, inside):
        """State after the line, one character after the other."""
        state = "quoted" if inside else "start"
        for c in line:
            if state == "quoted":
                state = "after" if c == '"' else "quoted"
            elif state == "after":
                state = "quoted" if c == '"' else "start" if c == "," else "plain"
            else:
                state = "start" if c == "," else "quoted" if c == '"' and state == "start" else "plain"
        return state == "quoted"

    draw = random.Random(5)
    lines = ["".join(draw.choices('"",ab', k=draw.randint(0, 12))) for _ in range(800)] + ['"' * 300_000, '",' * 200_000, "a," * 99_999 + '"']
    frame = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k int, line string")
    got = {r["k"]: r["step"] for r in frame.select("k", line_step(F.col("line")).alias("step")).collect()}
    for k, line in enumerate(lines):
        ends = tuple(bool(states(np.array([got[k]]), e)[0]) for e in (False, True))
        assert ends == (scan(line, False), scan(line, True)), line[:50]


def test_states_compose():
    draw = np.random.default_rng(4)
    for _ in range(50):
        steps = draw.integers(0, 4, int(draw.integers(1, 30)))
        for first in (False, True):
            state, want = first, []
            for s in steps:
                state = {0: state, 1: False, 2: True, 3: not state}[int(s)]
                want.append(state)
            assert states(steps, first).tolist() == want


def json_rows(draw, n):
    texts = ["a", '"', "\\", "}", "{", "]", "[", '"rows": [', "\n", "é", "x" * 30, ",", "\\\\"]
    made = lambda: "".join(draw.choices(texts, k=draw.randint(0, 6)))
    return [{"id": k, "t": made(), "in": {"u": [1, 2, {"v": made()}], "rows": [{"id": -1}]}, "l": [[], {}]} for k in range(n)]


@pytest.mark.parametrize(("shape", "indent"), [("list", None), ("rows", 1), ("members", 1), ("empty", None)])
def test_rows_of_large_documents(spark, small_splits, indent, shape):
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{setting}", "900b")
    rows = json_rows(random.Random(8), 40)
    other = [{"id": -5, "t": "not a row"}]
    document = {
        "list": rows,
        "rows": {"rows": rows},
        "members": {"about": {"rows": other, "n}": 1}, "more": other, "rows": rows, "after": other, "last": {"x": {"y": {}}}},
        "empty": {"rows": [], "after": other * 90},
    }[shape]
    folder = fresh_path(spark, "json")
    os.makedirs(folder)
    for k in range(2):
        with open(f"{folder}/{k}.json", "w") as f:
            json.dump(document, f, indent=indent, ensure_ascii=k == 0)
    assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() > 3
    schema = "id long, t string, `in` struct<u: array<string>, rows: array<struct<id: long>>>, l array<string>"
    got = readers.load_rows_json(spark, folder, schema, lines=False).select("id", "t", "in.u").collect()
    want = [] if shape == "empty" else [(r["id"], r["t"]) for r in rows] * 2
    assert sorted((r["id"], r["t"]) for r in got) == sorted(want)
    assert all(json.loads(r["u"][2])["v"] == rows[r["id"]]["in"]["u"][2]["v"] for r in got)


def test_depths_of_pieces():
    assert depths(b'{"rows": [{"a": 1', False) == (2, 0, 1, 2)
    assert depths(b'], "b": [', False) == (-1, -1, None, -1)
    assert depths(b'x", "c": {', True) == (0, 0, None, 0)
    assert depths(b'all inside {[ "', False) == (2, 0, None, 0)
    assert depths(b"no quote [", True) == (0, 0, None, 0)
