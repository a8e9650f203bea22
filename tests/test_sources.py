import gzip

import pytest

from chronoweave.sources import readers


def test_discovery_prefers_parquet_and_falls_back_to_one_prefix(spark, tmp_path):
    (tmp_path / "hosp").mkdir()
    for name in ("a.csv", "a.parquet", "b.csv.gz", "hosp/c.csv", "d_0.csv", "e_0.csv", "e_1.csv", "a.b.csv", "notes.txt"):
        (tmp_path / name).write_text("x")
    got = readers.find_data(spark, tmp_path, ["a", "b", "hosp/c", "d", "e"])
    assert {k: v.rpartition("/")[2] for k, v in got.items()} == {"a": "a.parquet", "b": "b.csv.gz", "hosp/c": "c.csv", "d": "d_0.csv"}
    with pytest.raises(FileNotFoundError):
        readers.find_data(spark, tmp_path, ["zzz"])


def test_metadata_discovery(spark, tmp_path):
    for name in ("lab.csv", "labs_x.csv", "other.csv.gz", "other.csv"):
        (tmp_path / name).write_text("x")
    assert [p.rpartition("/")[2] for p in readers.find_metadata(spark, tmp_path, "lab")] == ["lab.csv", "labs_x.csv"]
    assert [p.rpartition("/")[2] for p in readers.find_metadata(spark, tmp_path, "other")] == ["other.csv.gz"]


def test_csv_types_and_gzip(spark, tmp_path):
    text = 'i,f,b,s,e,d\n1,1.5,true,"a ""q"", b",,2020-01-01\n2,,false,3x,,2020-01-02\n'
    (tmp_path / "t.csv").write_text(text)
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write(text)
    for name in ("t.csv", "t.csv.gz"):
        df = readers.read_table(spark, tmp_path / name)
        assert dict(df.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "s": "string", "e": "string", "d": "string"}
        assert sorted(r.s for r in df.collect()) == ["3x", 'a "q", b']
    assert dict(readers.read_metadata(spark, [tmp_path / "t.csv"]).dtypes)["i"] == "string"


def test_unsupported_and_empty(spark, tmp_path):
    (tmp_path / "t.json").write_text("{}")
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, tmp_path / "t.json")
    (tmp_path / "h.csv").write_text("a,b\n")
    df = readers.read_table(spark, tmp_path / "h.csv")
    with pytest.raises(ValueError, match="no rows.*begins with .'a,b'"):
        readers.require(df, ["a"], "h", tmp_path / "h.csv")
    with pytest.raises(ValueError, match="lacks columns z"):
        readers.require(df, ["z"], "h")


def test_metadata_files_must_agree(spark, tmp_path):
    (tmp_path / "m_0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "m_1.csv").write_text("b,a\n3,4\n")
    (tmp_path / "m_2.csv").write_text("a\n1\n")
    two = readers.read_metadata(spark, [tmp_path / "m_0.csv", tmp_path / "m_1.csv"])
    assert sorted((r.a, r.b) for r in two.collect()) == [("1", "2"), ("4", "3")]
    with pytest.raises(ValueError, match="differ"):
        readers.read_metadata(spark, [tmp_path / "m_0.csv", tmp_path / "m_2.csv"])


def test_tables_in_folders_and_literal_names(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS k", "cast(id % 3 AS string) AS s")
    rows.repartition(3).write.parquet(str(tmp_path / "labs.parquet"))
    rows.repartition(2).write.csv(str(tmp_path / "hosp" / "vitals"), header=True)
    rows.coalesce(1).write.parquet(str(tmp_path / "[0-10).parquet"))
    (tmp_path / "hosp" / "vitals" / "notes.txt").write_text("x")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        got = readers.find_data(spark, root, ["labs", "hosp/vitals", "[0-10)"])
        assert sorted(got) == ["[0-10)", "hosp/vitals", "labs"]
        for path in got.values():
            df = readers.read_table(spark, path)
            assert df.count() == 20 and dict(df.dtypes)["k"] == "bigint"
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, tmp_path / "hosp")


def test_quoted_line_breaks(spark, tmp_path):
    """Line breaks, separators and doubled quotes inside fields; a stray quote; only files that need it are read as a whole."""
    texts = ["plain", "two\nlines", 'he said ""no"", and\n\nleft', "", "a,b", "last\n"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t/p0.csv").write_text("k,s,n\n" + "".join(f'{i},"{t}",{i}\n' for i, t in enumerate(texts)))
    (tmp_path / "t/p1.csv").write_text('k,s,n\n10,x,1\n\n11,"a ""q""",2\n12,,\n')
    (tmp_path / "t/p2.csv").write_text('k,s,n\n20,5" pipe,1\n21,y,2\n')
    got = {r.k: (r.s, r.n) for r in readers.read_table(spark, tmp_path / "t").collect()}
    want = {i: (t.replace('""', '"') or None, i) for i, t in enumerate(texts)}
    assert got == want | {10: ("x", 1), 11: ('a "q"', 2), 12: (None, None), 20: ('5" pipe', 1), 21: ("y", 2)}
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write((tmp_path / "t/p0.csv").read_text())
    assert {r.k: (r.s, r.n) for r in readers.read_table(spark, tmp_path / "z.csv.gz").collect()} == want
    meta = readers.read_metadata(spark, [tmp_path / "t/p0.csv"])
    assert {r.s for r in meta.collect()} == {s for s, _ in want.values()}


def test_parts_that_differ(spark, tmp_path):
    """Other column order, an added column and other types, in CSV and in Parquet."""
    (tmp_path / "c").mkdir()
    for name, text in {"p0": "id,x,y\n1,a,10\n", "p1": "id,y,x\n2,20,b\n", "p2": "y,z,id,x\n30,new,3,c\n", "p3": "id,x,y\n4,d,forty\n"}.items():
        (tmp_path / f"c/{name}.csv").write_text(text)
    df = readers.read_table(spark, tmp_path / "c", row_index="n")
    assert dict(df.dtypes) == {"id": "bigint", "x": "string", "y": "string", "z": "string", "n": "bigint"}
    assert [tuple(r) for r in df.select("id", "x", "y", "z", "n").orderBy("n").collect()] == [(1, "a", "10", None, 0), (2, "b", "20", None, 1), (3, "c", "30", "new", 2), (4, "d", "forty", None, 3)]
    (tmp_path / "p").mkdir()
    for i, sql in enumerate(["1 AS id, cast(10 AS int) AS y, 'a' AS x", "'b' AS x, 2 AS id, cast(20 AS bigint) AS y", "3 AS id, 'thirty' AS y, 'c' AS x, 1.5D AS z", "4 AS id, cast(40 AS int) AS y, 'd' AS x"]):
        spark.sql(f"SELECT {sql}").coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        next((tmp_path / f"w{i}").glob("*.parquet")).rename(tmp_path / f"p/p{i}.parquet")
    df = readers.read_table(spark, tmp_path / "p", row_index="n")
    assert dict(df.dtypes) == {"id": "int", "x": "string", "y": "string", "z": "double", "n": "bigint"}
    assert [tuple(r) for r in df.select("id", "x", "y", "z", "n").orderBy("n").collect()] == [(1, "a", "10", None, 0), (2, "b", "20", None, 1), (3, "c", "thirty", 1.5, 2), (4, "d", "40", None, 3)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2 * 3  # one scan for each of three footers, numbered


def test_a_text_table_is_scanned_once(spark, tmp_path):
    """Gzipped CSV is decoded by the one write of its columnar copy; types and rows come from that."""
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("a,b\n" + "".join(f"{i},{i / 2}\n" for i in range(100)))
    df = readers.read_table(spark, tmp_path / "t.csv.gz")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan
    assert dict(df.dtypes) == {"a": "bigint", "b": "double"} and df.count() == 100


def test_row_numbers(spark, tmp_path):
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.csv(str(tmp_path / "t"), header=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = readers.read_table(spark, tmp_path / "t", row_index="n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 1000 and all(r.id == r.n for r in got)
    assert sorted(r.id for r in readers.row_range(readers.read_table(spark, tmp_path / "t", row_index="n"), "n", 10, 20).collect()) == list(range(10, 20))
    first, last = readers.ends_of(spark.range(30), 2)
    assert [r.id for r in first + last] == [0, 1, 28, 29]


def test_quoted_line_breaks_by_many_tasks(spark, tmp_path):
    """A file with line breaks inside fields is read block by block, with the same rows in the same order as read whole."""
    texts = ["x" * 50 + "\n\n" + 'say ""no"", ' * (i % 4) + "\nend," * (i % 7) for i in range(300)] + ["\r\nodd\rbreaks\r\n", '""', "a,b\n" * 400]
    (tmp_path / "t.csv").write_bytes(("k,s,n\n" + "".join(f'{i},"{t}",{i}\n' for i, t in enumerate(texts))).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        records = readers._records(spark, [str(tmp_path / "t.csv")], None)
        assert records.where(readers._well_quoted("__record__")).count() == len(texts)
        df = readers.read_table(spark, tmp_path / "t.csv", row_index="n_row")
        got = sorted(map(tuple, df.select("n_row", "k", "s", "n").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, i, t.replace('""', '"'), i) for i, t in enumerate(texts)]
