"""CSV files with all their faults, and URLs."""

import bz2
import gzip
import io
import random
import zlib

import pytest

from sealframe.layout import FLOWERS
from sealframe.operators.rows import filter_category, preview, project_columns
from sealframe.sources import csv
from sealframe.sources.csv import CHUNK, _first_lines, _open, _reached, _through_spark, first_lines, lines_of, scan_csv, scan_csv_headerless
from sealframe.sources.urls import url_manifest

HEADER = "sepal_length,sepal_width,petal_length,petal_width,species\n"
ROWS = "5.1,3.5,1.4,0.2,Iris-setosa\n4.9,3.0,1.4,0.2,Iris-setosa\n7.0,3.2,4.7,1.4,Iris-versicolor\n"
FAULTS = (
    "1.0,2.0,3.0,4.0, Iris-setosa\n"  # leading blank
    "abc,2.0,3.0,4.0,Iris-setosa\n"  # text in a measure
    "1.0,2.0\n"  # short
    "1.0,2.0,3.0,4.0,Iris-setosa,extra\n"  # long
    ",2.0,3.0,4.0,Iris-setosa\n"  # empty measure
    "1.0,2.0,3.0,4.0,iris-setosa\n"  # other case
)


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_faulty_rows(spark, tmp_path):
    frame = scan_csv(spark, write(tmp_path, "a.csv", HEADER + FAULTS), FLOWERS)
    assert rows(frame) == sorted([
        (1.0, 2.0, 3.0, 4.0, " Iris-setosa"), (None, 2.0, 3.0, 4.0, "Iris-setosa"), (1.0, 2.0, None, None, None),
        (1.0, 2.0, 3.0, 4.0, "Iris-setosa"), (None, 2.0, 3.0, 4.0, "Iris-setosa"), (1.0, 2.0, 3.0, 4.0, "iris-setosa"),
    ], key=repr)
    assert filter_category(frame, "species", "Iris-setosa").count() == 3


def test_headers_are_found_file_by_file(spark, tmp_path):
    """With or without a header, every file gives the rows it gives once a header is there."""
    bodies = {
        "windows.csv": ROWS.replace("\n", "\r\n"), "windows_headed.csv": (HEADER + ROWS).replace("\n", "\r\n"),
        "plain.csv": ROWS, "faults.csv": FAULTS, "headed.csv": HEADER + ROWS, "shouting.csv": "  " + HEADER.upper() + ROWS,
        "twice.csv": HEADER + HEADER + ROWS, "inside.csv": ROWS + HEADER, "blank.csv": "\n" + ROWS, "late.csv": "\n" + HEADER + ROWS,
        "short.csv": "1.0,2.0\n", "no_newline.csv": "6.0,1.0,1.0,1.0,Iris-setosa", "only_header.csv": HEADER, "empty.csv": "",
        "tabbed.csv": "\t\u00a0" + HEADER + ROWS, "blank_tab.csv": " \t\n\n" + ROWS, "blank_lines.csv": "\n\n\n",
    }
    # By hand: whose first line, blanks apart, begins with the first column's name.
    with_header = {"windows_headed.csv", "headed.csv", "shouting.csv", "twice.csv", "only_header.csv", "tabbed.csv"}
    expected = []
    for name, body in bodies.items():
        write(tmp_path, name, body)
        folder = tmp_path / f"fixed-{name}"
        folder.mkdir()
        headed = name in with_header
        expected += rows(scan_csv(spark, write(folder, name, body if headed else HEADER + body), FLOWERS))
    got = rows(scan_csv_headerless(spark, [str(tmp_path / n) for n in bodies], FLOWERS))
    assert got == sorted(expected, key=repr)


def test_first_lines_of_files_cut_into_many_splits(spark, tmp_path):
    body = "".join(f"{i}.5,1.0,1.0,1.0,c{i % 3}\n" for i in range(20000))
    paths = [write(tmp_path, "a.csv", body), write(tmp_path, "b.csv", HEADER + body), write(tmp_path, "c.csv", "9.5,1.0,1.0,1.0,c\n")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        frame = scan_csv_headerless(spark, paths, FLOWERS)
        assert frame.count() == 40001
        assert frame.where("sepal_length = 0.5").count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_compressed_files(spark, tmp_path):
    """Each codec with and without a header, and one whose first lines are blank."""
    for name, opened in {"gz": gzip.open, "bz2": bz2.open}.items():
        for kind, text in {"bare": ROWS, "headed": HEADER + ROWS, "blank": "\n \t\n" + ROWS, "empty": ""}.items():
            with opened(tmp_path / f"{kind}.csv.{name}", "wt") as file:
                file.write(text)
    (tmp_path / "deflated.csv.deflate").write_bytes(zlib.compress(ROWS.encode()))
    frame = scan_csv_headerless(spark, str(tmp_path), FLOWERS)
    assert frame.count() == 7 * 3 and frame.where("species IS NULL OR sepal_length IS NULL").count() == 0


def test_a_store_that_only_spark_reads(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.cars.link./in", tmp_path.as_uri())
    write(tmp_path, "a.csv", ROWS)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write(HEADER + ROWS)
    assert scan_csv_headerless(spark, "viewfs://cars/in", FLOWERS).count() == 6
    assert scan_csv_headerless(spark, ["viewfs://cars/in/a.csv", "viewfs://cars/in/b*"], FLOWERS).count() == 6


def test_paths_with_marks(spark, tmp_path):
    paths = [write(tmp_path, name, ROWS) for name in ("a,b.csv", "c d%20.csv", "\u00fc;=.csv")]
    assert scan_csv_headerless(spark, paths, FLOWERS).count() == 9
    (tmp_path / "below").mkdir()
    write(tmp_path / "below", "unread.csv", ROWS)
    write(tmp_path, "_hidden.csv", ROWS)
    assert first_lines(spark, str(tmp_path)).count() == 3
    assert first_lines(spark, f"{tmp_path}/{{a,c}}*").count() == 2


class Counted(io.BytesIO):
    """Counts the bytes that are asked for."""

    asked = 0

    def read(self, n=-1):
        got = super().read(n)
        self.asked += len(got)
        return got


def test_flags_read_the_beginning_of_a_file_only():
    body = b"1.0,2.0,3.0,4.0,a\n" * 400_000
    file = Counted(body)
    assert _first_lines(file) == ("1.0,2.0,3.0,4.0,a",) * 2
    assert file.asked <= CHUNK
    long = Counted(b"x" * (3 * CHUNK) + b"\r\n" + body)
    assert _first_lines(long) == ("x" * (3 * CHUNK),) * 2 and long.asked <= 5 * CHUNK


def test_first_lines_over_chunk_edges():
    for gap in range(CHUNK - 3, CHUNK + 3):
        assert _first_lines(io.BytesIO(b" " * gap + b"\r\n\r\na,b\r\nc")) == (" " * gap, "a,b")
        assert _first_lines(io.BytesIO(b"y" * gap + b"\r\n")) == ("y" * gap,) * 2
    assert _first_lines(io.BytesIO(b"")) == ("", None)
    assert _first_lines(io.BytesIO(b"\ra\r")) == ("", "a")


def test_a_codec_is_inflated_no_further_than_needed(tmp_path):
    """The rest of the file may even be broken."""
    packed = gzip.compress(random.Random(1).randbytes(3_000_000).hex().replace("0", "\n").encode())
    (tmp_path / "a.csv.gz").write_bytes(packed[:400_000] + b"broken" * 1000)
    with _open(f"file:{tmp_path}/a.csv.gz") as file:
        assert _first_lines(file)[0]


@pytest.mark.parametrize("chunk", [1, 2, 3, 65_536])
def test_lines(monkeypatch, chunk):
    monkeypatch.setattr(csv, "CHUNK", chunk)
    cases = {b"": [], b"a": [b"a"], b"a\n": [b"a"], b"a\r\nb": [b"a", b"b"], b"\r\r\n\n": [b"", b"", b""], b"\ra\r": [b"", b"a"], b"a\n\r\nb\r": [b"a", b"", b"b"]}
    for text, lines in cases.items():
        assert list(lines_of(io.BytesIO(text))) == lines
    assert _first_lines(io.BytesIO(b" \r\n\r\na,b\r\nc")) == (" ", "a,b")
    assert _first_lines(io.BytesIO(b"")) == ("", None)


def test_stores():
    assert _reached("/a") and _reached(["file:/a", "file:///b"])
    assert not _reached("viewfs://a/b") and not _reached(["/a", "unheardof://x"])


def test_both_ways_agree(spark, tmp_path):
    """Arrow's reading of beginnings and Spark's reading of all lines."""
    texts = {"a": ROWS, "b": HEADER + ROWS, "c": "\n \t\r\n" + ROWS, "d": "\n\n", "e": "x", "f": "\u00fc" * 70_000 + "\r\rz"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
        with gzip.open(tmp_path / f"{name}2.csv.gz", "wt", encoding="utf-8", newline="") as file:
            file.write(text)
    one, other = (sorted(map(tuple, f(spark, str(tmp_path)).collect()), key=str) for f in (first_lines, _through_spark))
    assert one == other and len(one) == 12


def test_one_scan_of_all_files_and_no_list_of_paths(spark, tmp_path):
    for n in range(5):
        write(tmp_path, f"{n} [x].csv", (HEADER if n < 2 else "") + ROWS)
    assert first_lines(spark, str(tmp_path)).count() == 5
    frame = scan_csv_headerless(spark, str(tmp_path), FLOWERS)
    assert frame.count() == 15
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "[x].csv" not in plan and "Exchange" not in plan


def test_files_are_opened_as_told(spark, tmp_path):
    path = write(tmp_path, "a.csv", ROWS)
    assert scan_csv_headerless(spark, path, FLOWERS, lambda name: io.BytesIO(HEADER.encode())).count() == 2


def test_filter_reaches_the_scan(spark, tmp_path):
    frame = filter_category(scan_csv(spark, write(tmp_path, "a.csv", HEADER + ROWS), FLOWERS), "species", "Iris-setosa")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(species,Iris-setosa)" in plan and "Exchange" not in plan
    assert preview(frame, 2, ["sepal_length"]).first().sepal_length == 4.9
    assert project_columns(frame, ["species", "petal_width"]).columns == ["species", "petal_width"]


# By hand: URL, file name, error.
MANIFEST = [
    ("https://h.org/d/iris.csv", "iris.csv", None), ("HTTPS://h.org/x/", "", "no_file_name"), ("http://h.org/a.csv", "a.csv", "not_https"),
    ("https://h.org/b.csv;rm -rf", "b.csv", None), ("https://h.org/b;rm -rf.csv", "b", None), ("https://h.org/q%20x.csv?y=1#z", "q_20x.csv", None),
    ("https://h.org", "", "no_file_name"), ("https://h.org/../../etc/passwd", "passwd", None), ("https://h.org/blå bær.csv", "bl__b_r.csv", None),
    ("https://h.org/a;b/c;d;e", "c", None), ("https://h.org/a?x=/b/c.csv", "a", None), ("https://h.org/a#/b.csv", "a", None),
    ("ftp://h.org/a.csv", "a.csv", "not_https"), ("https://", "", "no_file_name"), ("https:///only/path.csv", "path.csv", None),
    ("https://h.org/a\tb.csv", "ab.csv", None), ("https://h.org/a\nb.csv", "ab.csv", None), ("https://h.org/$(id).csv", "__id_.csv", None),
    ("https://h.org/;", "", "no_file_name"), ("https://h.org/.", ".", None), (None, None, "not_https"),
]


def test_urls(spark):
    frame = url_manifest(spark.createDataFrame([(u,) for u, _, _ in MANIFEST], "`u.rl` string"), "u.rl")
    assert rows(frame) == sorted([(u, bool(u) and u.lower().startswith("https:"), name, error) for u, name, error in MANIFEST], key=repr)


def test_any_url_gives_a_safe_name(spark):
    random.seed(5)
    urls = ["https://h.org/" + "".join(random.choice("ab/;?#._-%& é") for _ in range(12)) for _ in range(500)]
    allowed = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._-")
    for r in url_manifest(spark.createDataFrame([(u,) for u in urls], "url string")).collect():
        assert set(r.file_name) <= allowed and (r.error == "no_file_name") == (r.file_name == "")
        # Nothing of the query or fragment, and no more than the last segment.
        path = r.url.removeprefix("https://h.org").split("?")[0].split("#")[0]
        assert len(r.file_name) <= len(path.split("/")[-1])
