"""CSV scanning: quoting, ragged rows, encodings, part files, splitting."""

import csv
import io
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.csv_files import (
    has_quoted_line_breaks, list_csv, open_quote, read_header, scan_csv, table_name, write_text,
)
from tradewind.sources.load import SPARK_ERRORS, read_typed_csv
from tradewind.sources.records import physical_lines, with_effect


def write(folder, name, content):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def scanned(spark, path, **options):
    return [tuple(r) for r in scan_csv(spark, path, **options).rows.collect()]


def test_rows(spark, tmp_path):
    path = write(tmp_path, "t.csv", b'id,name,note\n1,"A ""q"", x",\n2\n3,b,c,extra\n\n4,caf\xe9,""\n')
    assert not has_quoted_line_breaks(spark, path)
    expected = [("1", 'A "q", x', None), ("2", None, None), ("3", "b", "c"), ("4", "caf�", None)]
    assert scanned(spark, path) == expected
    assert scanned(spark, path, multiline=True) == expected


def test_quoted_line_break(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'id,name\n1,"two\nlines"\n2,x\n')
    assert has_quoted_line_breaks(spark, path)
    assert scanned(spark, path) == [("1", "two\nlines"), ("2", "x")]


def test_header(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'a,"b\nc","d ""e"""\n1,2,3\n')
    assert read_header(spark, path) == ["a", "b\nc", 'd "e"']
    assert scan_csv(spark, path).names == ["a", "b_c", "d_e"]
    long = "line\n" * 25
    assert read_header(spark, write(tmp_path, "l.csv", f'a,"{long}",b\n1,2,3\n')) == ["a", long, "b"]
    assert scan_csv(spark, write(tmp_path, "empty.csv", "")) is None
    assert scanned(spark, write(tmp_path, "bare.csv", "a,b\n")) == []


def test_open_quote_never_misses_one(spark):
    """Every line over the alphabet up to length 8: not open means complete for the csv module."""
    lines = ["".join(p) for n in range(9) for p in itertools.product('a",', repeat=n)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    closed = {r.line for r in df.filter(~open_quote(F.col("line"))).collect()}

    def runs_on(line):
        return len(list(csv.reader([line + "\n", "z\n"]))) < 2

    assert not [x for x in closed if x and runs_on(x)]
    well_formed = ['"a"', '"a","a"', '""', 'a,"a,a"', '"a""a"', '""""']
    assert not [x for x in well_formed if x not in closed]


@pytest.mark.parametrize("breaks", [False, True])
def test_same_rows_as_the_csv_module(spark, tmp_path, breaks):
    """Any well-formed table, quoted at random, reads as the csv module reads it."""
    rng = random.Random(breaks)
    pieces = ["a", "é", '"', '""', ",", " ", "  x ", "\\", "#", "'", "0", ";", "\t", "null", "日本"]
    pieces += ["\n", "\n\n"] if breaks else []
    table = [[str(i)] + ["".join(rng.choices(pieces, k=rng.randrange(4))) for _ in range(4)] for i in range(500)]
    buffer = io.StringIO(newline="")
    for row in [["id", "b", "c", "d", "e"], *table]:
        style = rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
        csv.writer(buffer, quoting=style, lineterminator="\n").writerow(row)
    path = write(tmp_path, "t.csv", buffer.getvalue())
    assert has_quoted_line_breaks(spark, path) == breaks
    expected = [tuple(v or None for v in row) for row in table]
    assert sorted(scanned(spark, path)) == sorted(expected)


@pytest.fixture
def small_splits(spark):
    """Splits of some records, so that records are cut by their borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("600", "100")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


CELLS = ("x", "", '"q"', '"a\nb"', '"a,b"', '"say ""hi"""', '"""start"', '"end"""', '""', '5" pipe', '"l1\nl2\n\nl4"', '"\n"', '"""\n"""', '"é\n😀"', " sp ")


def random_csv(seed, rows):
    rng = random.Random(seed)
    lines = [",".join(rng.choices(CELLS, k=rng.choice((1, 2, 3, 3, 3, 4)))) + "\n" * rng.choice((1, 1, 1, 2)) for _ in range(rows)]
    return "a,b,c\n" + "".join(lines)


def by_one_task(spark, path):
    rows = spark.read.csv(path, schema="a string, b string, c string", header=True, multiLine=True, quote='"', escape='"')
    return Counter(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("content", [
    random_csv(1, 150), random_csv(2, 150).rstrip("\n"), random_csv(3, 120).replace("\n", "\r\n"),
    'a,b,c\n1,"' + "over many splits\n" * 300 + '",2\n' + "1,2,3\n" * 40 + '4,"' + "z\n" * 500 + '",5\n',
    '"a","b\n\nb",c\n' + '1,2,3\n' * 200 + '"x\ny",2,3\n'], ids=["lf", "no end", "crlf", "long records", "header"])
def test_files_are_read_in_splits(spark, tmp_path, small_splits, content):
    path = write(tmp_path, "t.csv", content)
    scan = scan_csv(spark, path)
    assert not scan.multiline and physical_lines(spark, path).rdd.getNumPartitions() > 3
    assert Counter(tuple(r) for r in scan.rows.collect()) == by_one_task(spark, path)


@pytest.mark.parametrize("content", [
    "a,b,c\n" + '1,"x" y,2\n' * 100 + '"p\nq",2,3\n', "a,b,c\n" + '1,2,"x\ny"\n' * 80 + '1,2,"never\ncloses\n' + "1,2,3\n" * 50,
    "a,b,c\n" + '1,"x\ny",2\r\n' * 80, "a,b,c\n" + '1, "x\ny",2\n' * 80], ids=["text behind", "unclosed", "both breaks", "blank before"])
def test_unusual_quotes_are_left_to_one_task(spark, tmp_path, small_splits, content):
    path = write(tmp_path, "t.csv", content)
    scan = scan_csv(spark, path)
    assert scan.multiline and Counter(tuple(r) for r in scan.rows.collect()) == by_one_task(spark, path)


def test_part_files_are_read_in_splits(spark, tmp_path, small_splits):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for k in range(3):
        write(folder, f"part-{k}.csv", random_csv(10 + k, 60))
    scan = scan_csv(spark, str(folder))
    assert not scan.multiline and Counter(tuple(r) for r in scan.rows.collect()) == by_one_task(spark, str(folder))
    write(folder, "part-9.csv", "a,c,b\n" + '1,"x\ny",2\n' * 80)
    with pytest.raises(csv.Error):
        scan_csv(spark, str(folder))


def test_every_line_has_the_csv_modules_effect(spark):
    """Every line over the alphabet up to length 7 that fits the grammar, begun outside and inside of a quoted cell."""
    lines = ["".join(p) for n in range(8) for p in itertools.product('a",', repeat=n)]
    found = with_effect(spark.createDataFrame([(x,) for x in lines], "line string")).collect()

    def runs_on(*lines):
        return len(list(csv.reader([*(line + "\n" for line in lines), "z\n"]))) < 2

    assert not [r.line for r in found if not r.odd_outside and r.outside != runs_on(r.line)]
    assert not [r.line for r in found if not r.odd_inside and r.inside != runs_on('"', r.line)]
    fits = {r.line for r in found if not r.odd_outside}
    assert {'"a"', '"a","a"', '""', 'a,"a,a"', '"a""a"', '""""', '"a', 'a,"', 'a"a', 'a",a'} <= fits


def test_folder_of_part_files(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.range(100).select(F.col("id"), F.lit('x "y"').alias("n")).repartition(4).write.csv(
        path, header=True, escape='"')
    assert scan_csv(spark, path).rows.agg(F.count("*"), F.sum("id"), F.min("n")).first() == (100, 4950, 'x "y"')


def test_part_files_with_other_header_fail(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write(folder, "part-0.csv", "a,b\n1,2\n")
    write(folder, "part-1.csv", "b,a\n1,2\n")
    with pytest.raises(SPARK_ERRORS):
        scan_csv(spark, str(folder)).rows.collect()


def test_listing_and_names(spark, tmp_path):
    for name in ("b.csv", "A.CSV", "c.txt"):
        write(tmp_path, name, "x\n1\n")
    assert [p.rsplit("/", 1)[-1] for p in list_csv(spark, str(tmp_path))] == ["A.CSV", "b.csv"]
    assert table_name("/x/Préços 2024.csv") == "precos_2024"
    with pytest.raises(FileNotFoundError):
        list_csv(spark, str(tmp_path / "missing"))


def test_odd_file_names(spark, tmp_path):
    write(tmp_path, "a[1] {x}*.csv", 'id,n\n1,"a\nb"\n')
    (path,) = list_csv(spark, str(tmp_path))
    assert table_name(path) == "a_1_x" and scanned(spark, path) == [("1", "a\nb")]


def test_typed_scan(spark, tmp_path):
    path = write(tmp_path, "orders.csv", "id,placed_at,other\n1,2024-01-05 10:00:00,x\n2,bad,y\n")
    schema = T.StructType.fromDDL("id int, placed_at timestamp_ntz, total decimal(18,2)")
    df = read_typed_csv(spark, path, schema)
    assert df.schema == schema
    assert [(r.id, str(r.placed_at), r.total) for r in df.collect()] == [
        (1, "2024-01-05 10:00:00", None), (2, "None", None)]


def test_write_text(spark, tmp_path):
    write_text(spark, "-- é\n", str(tmp_path / "schema.sql"))
    assert (tmp_path / "schema.sql").read_text() == "-- é\n"
