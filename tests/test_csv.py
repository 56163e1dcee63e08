"""CSV in and out: multi-line records, and files cut between tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from larder.schema import RECIPES, all_strings
from larder.sources import raw_csv
from larder.sources.raw_csv import ROW_INDEX, land_csv, scan_csv
from larder.sources.tables import load_csv, write_csv

PIECES = ["a", "é", '"', ",", "\n", " ", "\\", "'", '""', "\n\n", '",', ',"', "\r\n", "x\r\ny"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_table(rng, n):
    def value():
        kind = rng.random()
        if kind < 0.1:
            return ""
        return "".join(rng.choices(PIECES, k=rng.randrange(0, 9))).strip("\r")

    return [[str(i), value(), value(), value()] for i in range(n)]


def python_csv(path, rows, header, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture
def tiny_splits(conf):
    """Cut files every 200 bytes."""
    conf("spark.sql.files.maxPartitionBytes", "200b")
    conf("spark.sql.files.openCostInBytes", "0")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_equals_multiline_scan(spark, tmp_path, tiny_splits, seed, end):
    rng = random.Random(seed)
    python_csv(tmp_path / "a.csv", random_table(rng, 150), ["id", "p", "q", "r"], end)
    path = str(tmp_path / "a.csv")
    want = rows_of(scan_csv(spark, path))
    assert len(want) == 150
    out = str(tmp_path / "out")
    groups = raw_csv.file_headers(spark, path)
    assert not raw_csv._land_split(spark, path, out, groups, chunk_lines=5)
    assert rows_of(spark.read.parquet(out)) == want


@pytest.mark.parametrize("seed", range(2))
def test_ragged_rows(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    rows = [r[: rng.randrange(1, 5)] + ["more"] * rng.randrange(3) for r in random_table(rng, 80)]
    rows += [["  "], ["\t", ""], ["", "", "", ""], ["", "x"]]
    python_csv(tmp_path / "a.csv", rows, ["id", "p", "q", "r"])
    out = str(tmp_path / "out")
    want = rows_of(scan_csv(spark, str(tmp_path / "a.csv")))
    groups = raw_csv.file_headers(spark, str(tmp_path / "a.csv"))
    assert not raw_csv._land_split(spark, str(tmp_path / "a.csv"), out, groups, chunk_lines=4)
    assert rows_of(spark.read.parquet(out)) == want


def test_split_over_many_files(spark, tmp_path, tiny_splits):
    rng = random.Random(5)
    (tmp_path / "in").mkdir()
    for i in range(4):
        python_csv(tmp_path / f"in/{i}.csv", random_table(rng, 40), ["id", "p", "q", "r"])
    path = str(tmp_path / "in")
    want = rows_of(scan_csv(spark, path))
    assert len(want) == 160
    landed = land_csv(spark, path, str(tmp_path / "out"), split_above=0, chunk_lines=3)
    assert rows_of(landed) == want


def test_file_that_is_not_rfc_4180_takes_the_scan(spark, tmp_path, tiny_splits):
    body = "".join(f'{i},5" pipe {i},x\n' for i in range(51))
    (tmp_path / "a.csv").write_text("id,p,q\n" + body)
    want = rows_of(scan_csv(spark, str(tmp_path / "a.csv")))
    assert len(want) == 51
    landed = land_csv(
        spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), split_above=0, chunk_lines=5
    )
    assert rows_of(landed) == want


def test_quote_that_never_closes_is_seen_before_grouping(spark, tmp_path, monkeypatch):
    body = "".join(f"{i},pipe,x\n" for i in range(500))
    (tmp_path / "a.csv").write_text('id,p,q\n-1,5" pipe,x\n' + body)
    path = str(tmp_path / "a.csv")
    lines = raw_csv._numbered_lines(spark, path, 20)
    assert raw_csv._open_files(raw_csv._chunks(lines), 1_000).count() == 1
    assert raw_csv._open_files(raw_csv._chunks(lines), 1_000_000).isEmpty()
    monkeypatch.setattr(raw_csv, "OPEN_FIELD_BYTES", 1_000)
    want = rows_of(scan_csv(spark, path))
    assert len(want) == 501
    assert rows_of(land_csv(spark, path, str(tmp_path / "o"), 0, 20)) == want


def test_header_only_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,p\n")
    assert land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0).count() == 0
    (tmp_path / "b.csv").write_text('id,p\n\n1,"x\n\ny"\n\n')
    landed = land_csv(spark, str(tmp_path / "b.csv"), str(tmp_path / "o2"), 0)
    assert rows_of(landed) == [("1", "x\n\ny")]


def test_multi_line_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"p\nq"\n1,2\n')
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0)
    assert landed.columns == ["id", "p\nq"]
    assert rows_of(landed) == [("1", "2")]


def test_long_fields_do_not_overflow_the_matcher(spark, tmp_path):
    long = 'x""' * 60_000 + "y" * 200_000
    (tmp_path / "a.csv").write_text(f'id,p,q\n1,"{long}",z\n')
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0)
    assert landed.select(F.length("p")).collect()[0][0] == 2 * 60_000 + 200_000


@pytest.mark.parametrize("end", ["\r", "\n\r", "\r\n"])
def test_odd_line_ends(spark, tmp_path, end):
    (tmp_path / "a.csv").write_bytes(f"id,p{end}1,x{end}2,y{end}".encode())
    want = rows_of(scan_csv(spark, str(tmp_path / "a.csv")))
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0)
    assert rows_of(landed) == want


@pytest.mark.parametrize(
    "content",
    [
        b"\xef\xbb\xbfid,p\n1,x\n",
        b'id,p\n1,"x\ny"',
        b"id,p\n1,x",
        b'id,p\n1,"x\n2,y\n',
        b'id,p\n1,"x"y\n2,"z" \n',
        b'id,p\n1,x "quoted" y\n2,"a ""b"" c"\n',
        b"id,p\n\xff\xfe,caf\xc3\xa9\n",
    ],
    ids=["bom", "open end", "no last line end", "open quote", "after quote", "inner", "not utf-8"],
)
def test_odd_files(spark, tmp_path, content):
    (tmp_path / "a.csv").write_bytes(content)
    scanned = scan_csv(spark, str(tmp_path / "a.csv"))
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0)
    assert landed.columns == scanned.columns
    assert rows_of(landed) == rows_of(scanned)


def test_mixed_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,p\n1,"x\r\ny"\r\n2,z\n3,"q"\r\n')
    want = rows_of(scan_csv(spark, str(tmp_path / "a.csv")))
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), 0)
    assert rows_of(landed) == want


def test_small_files_use_the_scan(spark, tmp_path):
    python_csv(tmp_path / "a.csv", [["1", "x\ny"]], ["", "p"])
    landed = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"))
    assert landed.columns == [ROW_INDEX, "p"]
    assert rows_of(landed) == [("1", "x\ny")]


def test_sink_reads_back(spark, tmp_path):
    rows = [(1, 'He said ""hi""\nline2'), (2, ""), (3, None), (4, "  pad "), (5, "\\'\""), (6, ",")]
    df = spark.createDataFrame(rows, "id long, p string")
    write_csv(df, str(tmp_path / "out"))
    back = load_csv(spark, str(tmp_path / "out"), df.schema)
    assert rows_of(back) == rows


def test_single_file(spark, tmp_path):
    df = spark.range(1000).repartition(5)
    write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    write_csv(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("part-*.csv"))) > 1


def test_single_file_whatever_the_size(spark, tmp_path):
    write_csv(spark.range(100_000).repartition(5), str(tmp_path / "big"), single_file=True)
    assert len(list((tmp_path / "big").glob("part-*.csv"))) == 1


def test_load_matches_by_name(spark, tmp_path):
    python_csv(
        tmp_path / "a.csv",
        [["s", "7", "", "2020-01-05", "T", "bad", "3"], ["s", "x", "4", "bad", "", "", ""]],
        ["source", "recipe_id", "minutes", "submitted", "title", "n_steps", "n_ingredients"],
    )
    got = load_csv(spark, str(tmp_path / "a.csv"), RECIPES)
    assert got.columns == RECIPES.names
    assert [str(f.dataType) for f in got.schema] == [str(f.dataType) for f in RECIPES]
    by_id = {r.recipe_id: r for r in got.collect()}
    assert by_id[7].minutes is None and by_id[7].n_steps is None
    assert by_id[7].submitted.isoformat() == "2020-01-05"
    assert by_id[None].minutes == 4 and by_id[None].submitted is None


ODD_FILES = {
    "blanks": "\n\nid,p\n1,2\n",
    "blanks_crlf": '\r\n\r\nid,p\r\n1,"x\r\ny"\r\n',
    "mark": "\ufeffid,p\n1,2\n",
    "mark_blank": "\ufeff\nid,p\n1,2\n",
    "ragged": "id,p\n1\n2,3,4\n,\n",
    "line_ends": 'id,p\n1,"a\n\nb"\n\n2,"c\n"\n',
    "no_final_end": "id,p\n1,2\n3,4",
    "blank_tail": "id,p\n1,2\n\n\n",
    "mixed_ends": "id,p\r\n1,2\n3,4\r\n",
    "quoted_header": '\n"id","p"\n"1",""\n',
}


@pytest.mark.parametrize("name", ODD_FILES)
def test_odd_files_read_alike(spark, tmp_path, tiny_splits, name):
    (tmp_path / "a+b %20.csv").write_bytes(ODD_FILES[name].encode())
    path = str(tmp_path / "a+b %20.csv")
    want = scan_csv(spark, path)
    landed = land_csv(spark, path, str(tmp_path / "o"), split_above=0, chunk_lines=2)
    assert landed.columns == want.columns and rows_of(landed) == rows_of(want)


def test_odd_files_together(spark, tmp_path, tiny_splits):
    (tmp_path / "in").mkdir()
    for name, text in ODD_FILES.items():
        (tmp_path / "in" / f"{name} 1.csv").write_bytes(text.encode())
    want = scan_csv(spark, str(tmp_path / "in"))
    landed = land_csv(spark, str(tmp_path / "in"), str(tmp_path / "o"), 0, 2)
    assert landed.columns == want.columns and rows_of(landed) == rows_of(want)
    alone = [rows_of(scan_csv(spark, str(tmp_path / "in" / f"{n} 1.csv"))) for n in ODD_FILES]
    assert rows_of(landed) == sorted((r for rows in alone for r in rows), key=repr)


def test_only_loose_files_are_scanned(spark, tmp_path, tiny_splits):
    (tmp_path / "in").mkdir()
    for i in range(5):
        body = "".join(f'{i}{k},"a\nb"\n' for k in range(20))
        (tmp_path / f"in/{i}.csv").write_text("id,p\n" + body)
    (tmp_path / "in/loose.csv").write_text('id,p\n7,5" pipe\n8,x\n')
    path = str(tmp_path / "in")
    groups = raw_csv.file_headers(spark, path)
    loose = raw_csv._land_split(spark, path, str(tmp_path / "o"), groups, 5)
    assert [f.rsplit("/", 1)[-1] for f in loose] == ["loose.csv"]
    assert rows_of(spark.read.parquet(str(tmp_path / "o"))) == rows_of(scan_csv(spark, path))


@pytest.mark.parametrize("split_above", [0, 1 << 30])
def test_headers_in_other_orders(spark, tmp_path, split_above):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("recipe_id,title\n1,one\n")
    (tmp_path / "in/b.csv").write_text("title,recipe_id\nthree,3\n")
    (tmp_path / "in/c.csv").write_text("minutes,recipe_id\n5,4\n")
    landed = land_csv(spark, str(tmp_path / "in"), str(tmp_path / "o"), split_above)
    assert landed.columns == ["recipe_id", "title", "minutes"]
    assert rows_of(landed) == [("1", "one", None), ("3", "three", None), ("4", None, "5")]


def test_load_by_name_over_other_orders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    names = RECIPES.fieldNames()
    (tmp_path / "in/a.csv").write_text(",".join(names) + "\n1,one,2,3,4,2020-01-31,x\n")
    back = names[::-1]
    (tmp_path / "in/b.csv").write_text(",".join(back) + "\ny,2020-02-29,4,3,2,three,3\n")
    loaded = load_csv(spark, str(tmp_path / "in"), RECIPES)
    assert [(r["recipe_id"], r["title"], r["source"]) for r in loaded.orderBy("recipe_id").collect()] == [
        (1, "one", "x"),
        (3, "three", "y"),
    ]


@pytest.mark.parametrize("split_above", [0, 1 << 30])
def test_file_names_stay_out_of_plans(spark, tmp_path, split_above, capsys):
    """Many files under two headers: no plan lists them, and headers alone reach the driver."""
    (tmp_path / "in").mkdir()
    for i in range(10_000):
        head, row = ("id,p", f"{i},x") if i % 2 else ("p,id", f"y,{i}")
        (tmp_path / f"in/piece{i}.csv").write_text(f"{head}\n{row}\n")
    path = str(tmp_path / "in")
    headers = raw_csv.file_headers(spark, path)
    assert len(headers.schemas) == 2 and headers.of_file.count() == 10_000
    scan_csv(spark, path).explain("extended")
    assert "piece" not in capsys.readouterr().out.replace("piece0.csv", "")
    landed = land_csv(spark, path, str(tmp_path / "o"), split_above=split_above)
    assert rows_of(landed.select("id", "p")) == sorted(
        ((str(i), "x" if i % 2 else "y") for i in range(10_000)), key=repr
    )
