"""CSV files read in splits give the rows of Spark's one-task reader."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.sources import csv_records, files

HEADER = 'id,"a, b",text\n'
#: Cells as they stand in a file.
CELLS = ['plain', '', '""', '"quoted"', '"with, comma"', '"a ""quoted"" word"', '"two\nlines"', '"\n\n"', '"ends with quote"""', '""""', '"""\n"""',
         'stray " quote', 'end"', '5" x 3"', ' "blank first"', '"closed" behind', '"closed, "behind', '  ', '"line, with\n""all"",\n of it"', "é 春天",
         '"É\n"', '"x"",\ny"']


def content(rng, rows, newline="\n"):
    lines = [HEADER.rstrip("\n")] + [f"{i},{rng.choice(CELLS)},{rng.choice(CELLS)}" for i in range(rows)]
    return "\n".join(lines).replace("\n", newline) + newline


def one_task(spark, path):
    return spark.read.options(**files.CELLS).csv(path, header=True, multiLine=True)


def cells_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def written(tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    return str(tmp_path)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_rows_equal_those_of_one_task(spark, tmp_path, small_splits, newline, seed):
    rng = random.Random(seed)
    path = written(tmp_path, content(rng, 60, newline))
    lines = csv_records.lines_of(spark, path)
    assert csv_records.needs_joining(lines)
    assert lines.select("start").distinct().count() > 5
    got = files._text_cells(spark, path, True)
    assert got.columns == one_task(spark, path).columns == ["id", "a, b", "text"]
    assert got.rdd.getNumPartitions() > 5
    assert cells_of(got) == cells_of(one_task(spark, path))


def test_a_cell_longer_than_several_splits(spark, tmp_path, small_splits):
    long = '"' + "".join(f"line {i}, ""more""\n" for i in range(200)) + '"'
    path = written(tmp_path, f'{HEADER}1,{long},x\n2,y,"a\nb"\n\n3,{long},{long}\n4,,', HEADER + "5,plain,text\n6,\"open to the end\nof the file")
    assert cells_of(files._text_cells(spark, path, True)) == cells_of(one_task(spark, path))


def test_a_header_of_several_lines(spark, tmp_path, small_splits):
    head = 'id,"' + "\n".join("long name" for _ in range(60)) + '",b\n'
    path = written(tmp_path, head + '1,"x\ny",z\n2,,\n')
    assert cells_of(files._text_cells(spark, path, True)) == cells_of(one_task(spark, path))


def test_files_of_both_line_ends_and_blank_lines(spark, tmp_path, small_splits):
    rng = random.Random(9)
    path = written(tmp_path, content(rng, 30), content(rng, 30, "\r\n"), HEADER, HEADER + "\n\n1,a,b\n  \n\n2,c,d\n")
    assert cells_of(files._text_cells(spark, path, True)) == cells_of(one_task(spark, path))


def test_single_line_files_are_split_without_joining(spark, tmp_path, small_splits):
    rows = "".join(f'{i},"some ""text"", with comma",{i}\n' for i in range(100))
    path = written(tmp_path, HEADER + rows)
    assert not csv_records.needs_joining(csv_records.lines_of(spark, path))
    got = files._text_cells(spark, path, True)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString() and got.rdd.getNumPartitions() > 5
    assert cells_of(got) == cells_of(one_task(spark, path))


def test_too_many_named_splits_fall_back_to_whole_files(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(csv_records, "MOST_NAMED_SPLITS", 2)
    path = written(tmp_path, content(random.Random(1), 60, "\r\n"))
    assert cells_of(files._text_cells(spark, path, True)) == cells_of(one_task(spark, path))


def test_lines_left_without_quotes_never_end_inside_a_cell(spark):
    """The look that spares the joining is on the safe side of the exact rule, over all short lines."""
    rng = random.Random(3)
    lines = ["".join(rng.choices('",a', k=rng.randint(0, 9))) for _ in range(20_000)]
    left = F.regexp_replace(F.replace("value", F.lit('""'), F.lit("")), csv_records.WHOLE_CELL_SQL, "$1")
    found = spark.createDataFrame([(x,) for x in lines], "value string").select("value", F.contains(left, F.lit('"')).alias("odd")).toArrow()
    opened, _ = csv_records._open_at_end(found.column("value").combine_chunks())
    odd = found.column("odd").to_numpy()
    assert not (opened & ~odd).any() and (~odd).sum() > 1000


def test_states_follow_a_plain_reading():
    import pyarrow as pa

    def plain(line, inside):
        at, start = 0, not inside
        while at < len(line):
            c = line[at]
            if inside:
                if c == '"' and line[at + 1:at + 2] == '"':
                    at += 1
                elif c == '"':
                    inside, start = False, False
            elif c == '"' and start:
                inside = True
            else:
                start = c == ","
            at += 1
        return inside

    rng = random.Random(8)
    lines = ["".join(rng.choices('"",a', k=rng.randint(0, 8))) for _ in range(3000)]
    outside, inside = csv_records._open_at_end(pa.array(lines))
    assert outside.tolist() == [plain(x, False) for x in lines] and inside.tolist() == [plain(x, True) for x in lines]
    for first in (False, True):
        states, state = [first], first
        for x in lines:
            state = plain(x, state)
            states.append(state)
        assert np.array_equal(csv_records._states(outside, inside, first), states)
