import csv
import io
import random

import pytest

from scrubline.sources import csv_files, quoted_lines

COLUMNS = ["name", "code", "note"]


def random_file(seed, rows=25, end="\n"):
    """A CSV text whose cells hold breaks, commas and quotes, with some loose quotes in plain cells."""
    rnd = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(COLUMNS)
    piece = lambda: rnd.choice(["a", "bé", ",", '"', "\n", "\r\n", "x y", " ", '""', "\n\n"])
    for i in range(rows):
        cells = ["".join(piece() for _ in range(rnd.randint(0, 6))) for _ in range(2)]
        if rnd.random() < 0.2:
            out.write(f'{i}5" pipe,plain "quoted" text,"closed" and more{end}')
        else:
            writer.writerow([f"k{i}", *cells])
    return out.getvalue()


@pytest.fixture
def small_blocks(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def whole_reader(spark, path):
    read = spark.read.option("multiLine", True).option("quote", '"').option("escape", '"').option("header", True)
    return [tuple(r) for r in read.csv(path).collect()]


@pytest.mark.parametrize("seed, block, end", [(1, 60, "\n"), (2, 25, "\n"), (3, 100, "\r\n"), (4, 10**6, "\n")])
def test_blocks_of_any_size_give_the_same_records(spark, tmp_path, small_blocks, seed, block, end):
    files = [tmp_path / f"{k}.csv" for k in range(2)]
    wanted = []
    for k, file in enumerate(files):
        file.write_bytes(random_file(10 * seed + k, end=end).encode())
        wanted += whole_reader(spark, str(file))
    small_blocks(block)
    paths = [str(f) for f in files]
    found = quoted_lines.records(spark, paths)
    if block < 1000:
        assert quoted_lines.raw_lines(spark, paths).rdd.getNumPartitions() > 10
    assert found.where("first").count() == 2
    group = csv_files.Group(tuple(COLUMNS), "utf-8", True)
    rows = csv_files._raw_rows(spark, paths, group).collect()
    assert sorted(((r.c0, r.c1, r.c2) for r in rows), key=str) == sorted(wanted, key=str)
    # Positions sort in file order.
    placed = [r.c0 for r in sorted(rows, key=lambda r: r.source) if r.source.file.endswith("0.csv")]
    assert placed == [r[0] for r in whole_reader(spark, paths[0])]


def test_states_of_blocks(spark):
    rows = [("f", 0, True, True), ("f", 10, False, True), ("f", 20, True, False), ("f", 30, True, False), ("f", 40, False, False), ("f", 50, True, False)]
    ends = spark.createDataFrame(rows, "path string, block long, out boolean, in boolean")
    states = {r.block: r.inside for r in quoted_lines.block_states(ends).collect()}
    assert states == {0: False, 10: True, 20: True, 30: False, 40: True, 50: False}


@pytest.mark.parametrize(
    "line, from_outside, from_inside",
    [
        (b"a,b", False, True),
        (b'a,"b', True, False),
        (b'a","b', True, True),
        (b'"a ""b"" c', True, False),
        (b'5" pipe,x', False, False),
        (b'a,"b" c,"d', True, True),
        (b'"', True, False),
        (b'""', False, True),
        (b'",""', True, False),
    ],
)
def test_the_state_after_a_line(line, from_outside, from_inside):
    assert quoted_lines.ends_inside(line, False) == from_outside
    assert quoted_lines.ends_inside(line, True) == from_inside


def test_a_file_of_many_blocks_in_windows_1252_with_rejects(spark, tmp_path, small_blocks):
    lines = ["name,code,note"] + [f'"Café {i}\nnext €",C{i},{"x,y" if i % 5 == 0 else "z"}' for i in range(50)]
    (tmp_path / "s.csv").write_bytes("\n".join(lines).encode("cp1252"))
    small_blocks(64)
    kept = csv_files.read_suppliers(spark, str(tmp_path), bad_rows="skip").collect()
    assert {(r.name, r.supplier_code) for r in kept} == {(f"Café {i}\nnext €", f"C{i}") for i in range(50) if i % 5}
    assert csv_files.csv_rejects(spark, str(tmp_path)).count() == 10
