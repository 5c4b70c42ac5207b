from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.sources import landing
from quarrystone.sources.landing import Source, land_all, land_csv, land_jsonl, row_counts
from quarrystone.sources.tables import adhoc_sql, export_csv, materialize_table, read_table, table_exists, write_table


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_lands_every_row_as_text(spark, tmp_path):
    df = land_csv(spark, _file(tmp_path, "in.csv", "a,b\n1,x\n2,\n3,z\n"))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert _rows(df) == [("1", "x"), ("2", ""), ("3", "z")]


def test_csv_short_long_quoted_and_null_words(spark, tmp_path):
    text = 'a,b,c\n1,x\n2\n3,"q,""r""",7\n4,1,2,3\n5,NULL,null\n6,""," s "\n7,,\n8,"u,v",\n'
    assert _rows(land_csv(spark, _file(tmp_path, "in.csv", text))) == [
        ("1", "x", None),
        ("2", None, None),
        ("3", 'q,"r"', "7"),
        ("4", "1", "2"),
        ("5", "NULL", "null"),
        ("6", "", " s "),
        ("7", "", ""),
        ("8", "u,v", ""),
    ]


def test_csv_line_break_in_a_quoted_field_must_be_declared(spark, tmp_path):
    path = _file(tmp_path, "in.csv", 'a,b\n1,"x\ny"\n2,z\n')
    assert _rows(land_csv(spark, path, multiline=True)) == [("1", "x\ny"), ("2", "z")]
    with pytest.raises(Exception, match="declare the source multiline"):
        land_csv(spark, path).collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_keeps_lines_of_spaces_stray_quotes_and_repeated_headers(spark, tmp_path, multiline):
    text = 'a,b\n1,x\n   \n\n2\n3,y,z\n4,\na,b\n5,"q,""r"""\n'
    rows = [("1", "x"), ("   ", None), ("2", None), ("3", "y"), ("4", ""), ("a", "b"), ("5", 'q,"r"')]
    assert _rows(land_csv(spark, _file(tmp_path, "1.csv", text), multiline)) == sorted(rows, key=str)
    stray = land_csv(spark, _file(tmp_path, "2.csv", text + '6,5" pipe\n7" pipe\n'), multiline)
    assert _rows(stray) == sorted([*rows, ("6", '5" pipe'), ('7" pipe', None)], key=str)


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_split_over_tasks_is_read_once_and_whole(spark, conf, tmp_path, multiline):
    conf({"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"})
    for f in range(3):
        _file(tmp_path, f"d/{f}.csv", "k,v\n" + "".join(f"{f}-{i},v{i}\n" for i in range(700)))
    df = land_csv(spark, str(tmp_path / "d"), multiline)
    assert df.select("k").distinct().count() == df.count() == 2100
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_windows_lines(spark, tmp_path, multiline):
    path = _file(tmp_path, "in.csv", "a,b\r\n1,x\r\n2,\r\n")
    assert _rows(land_csv(spark, path, multiline)) == [("1", "x"), ("2", "")]


def _whole_reader(spark, path, names):
    """Spark's own reader of whole files, by one task each."""
    schema = ", ".join(f"{n} string" for n in names)
    reader = spark.read.options(header=True, escape='"', emptyValue="", multiLine=True).schema(schema)
    return sorted((tuple("" if v is None else v for v in r) for r in reader.csv(path).collect()), key=str)


@pytest.mark.parametrize("size", [257, 1000, 100_000])
def test_csv_records_over_block_edges(spark, conf, tmp_path, size):
    """Line breaks, doubled quotes and delimiters in quoted fields, stray quotes in others, cut anywhere into blocks."""
    rng = random.Random(size)
    for f in range(2):
        rows = []
        for i in range(100):
            long = "".join(rng.choice(['line\n', '""', ",", "x", "\n\n", "\r\n", " "]) for _ in range(rng.choice((0, 3, 20, 200))))
            rows.append(rng.choice([f'{f}-{i},"{long}",z', f'"{long}k{i}",y,"{long}"', f'{i},5" pipe,7"', f'{i},"",""""']))
        _file(tmp_path, f"d/{f}.csv", "a,b,c\n" + "\n".join(rows) + "\n")
    conf({"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"})
    df = land_csv(spark, str(tmp_path / "d"), multiline=True)
    assert _rows(df) == _whole_reader(spark, str(tmp_path / "d"), "abc")
    assert df.count() == 200


def test_csv_break_on_the_edge_of_a_block_and_field_over_many_blocks(spark, conf, tmp_path):
    text = 'a,b\n1,"' + "x" * 56 + '\ny"\n2,"' + "long\n" * 200 + '"\n3,z\n4,"no end\n'
    path = _file(tmp_path, "in.csv", text)
    assert text.index("\ny") == 63
    conf({"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"})
    lines = land_csv(spark, path, multiline=True)
    assert _rows(lines)[:3] == [("1", "x" * 56 + "\ny"), ("2", "long\n" * 200), ("3", "z")]
    assert lines.count() == 4
    assert lines.select(F.spark_partition_id()).distinct().count() > 1


def test_csv_header_only_is_empty_and_no_header_raises(spark, tmp_path):
    assert land_csv(spark, _file(tmp_path, "h.csv", "a,b\n")).count() == 0
    with pytest.raises(ValueError, match="no header"):
        land_csv(spark, _file(tmp_path, "e.csv", ""))


def test_csv_files_of_one_folder_must_share_their_header(spark, tmp_path):
    _file(tmp_path, "d/1.csv", "a,b\n1,x\n")
    _file(tmp_path, "d/2.csv", "a,b\n2,y\n")
    assert _rows(land_csv(spark, str(tmp_path / "d"))) == [("1", "x"), ("2", "y")]
    _file(tmp_path, "d/3.csv", "b,a\nz,3\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        land_csv(spark, str(tmp_path / "d")).collect()


def test_jsonl_every_record_names_columns(spark, tmp_path):
    text = '{"a": 1, "b": "x"}\n\n{"a": 2.50}\n{"b": null, "a": true}\n{"a": {"k": 1}, "z": 3}\n'
    df = land_jsonl(spark, _file(tmp_path, "in.jsonl", text))
    assert df.columns == ["a", "b", "z"]
    assert _rows(df) == [("1", "x", ""), ("2.50", "", ""), ("true", "", ""), ('{"k": 1}', "", "3")]
    assert _rows(land_jsonl(spark, str(tmp_path / "in.jsonl"), ["b"])) == [("",), ("",), ("",), ("x",)]


def test_jsonl_keeps_a_key_of_one_file_only(spark, tmp_path):
    _file(tmp_path, "j/1.jsonl", '{"x": 1}\n' * 50)
    _file(tmp_path, "j/2.jsonl", '{"x": 2, "y": 3}\n')
    assert ("2", "3") in _rows(land_jsonl(spark, str(tmp_path / "j")))


def test_jsonl_with_too_many_keys_must_be_declared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MOST_KEYS", 20)
    path = _file(tmp_path, "k.jsonl", "".join(f'{{"k{i}": {i}}}\n' for i in range(21)))
    with pytest.raises(ValueError, match="declare the columns"):
        land_jsonl(spark, path)
    assert land_jsonl(spark, path, ["k3"]).where("k3 = '3'").count() == 1


def test_jsonl_empty_and_malformed_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="is empty"):
        land_jsonl(spark, _file(tmp_path, "e.jsonl", "\n\n"))
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        land_jsonl(spark, _file(tmp_path, "m.jsonl", '{"a": 1}\n{bad\n')).collect()


def test_missing_source_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_all(spark, str(tmp_path), [Source("raw_t", "no/such.csv")])


def test_counts_of_all_sources(spark, tmp_path):
    _file(tmp_path, "c/a.csv", "a\n1\n2\n")
    _file(tmp_path, "j/b.jsonl", '{"x": 1}\n')
    landed = land_all(spark, str(tmp_path), [Source("raw_a", "c/a.csv"), Source("raw_b", "j/b.jsonl", "jsonl")])
    assert _rows(row_counts(landed)) == [("raw_a", 2), ("raw_b", 1)]


def test_export_round_trip_keeps_spaces_quotes_and_breaks(spark, tmp_path):
    rows = [(" 1 ", 'a"b', ""), ("2", "x\ny", "u,v")]
    path = str(tmp_path / "out")
    assert export_csv(spark.createDataFrame(rows, "a string, b string, c string"), path) == 2
    assert _rows(land_csv(spark, path, multiline=True)) == sorted(rows)


def test_export_replaces_and_has_a_header(spark, tmp_path):
    path = tmp_path / "out"
    export_csv(spark.createDataFrame([(9, "z")], "a int, b string"), str(path))
    assert export_csv(spark.createDataFrame([(1, "b")], "a int, b string").coalesce(1), str(path)) == 1
    (part,) = path.glob("*.csv")
    assert part.read_text().splitlines() == ["a,b", "1,b"]


def test_export_writes_doubles_without_exponent(spark, tmp_path):
    sizes = [m * 10.0**e for e in range(-7, 21) for m in (1, -1, 1.2345678901234567, -9.87)]
    values = [0.1, 5.0, 12345678.9, -98765432101.25, 1e15, 0.0, *sizes, 5e-324, 1.7976931348623157e308, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    export_csv(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.csv")
    texts = part.read_text().split("\n")[1:-1]
    assert texts[:5] == ["0.1", "5.0", "12345678.9", "-98765432101.25", "1000000000000000.0"]
    assert [float(t) for t in texts if t.strip("\"")] == values[:-1]
    assert not any("e" in t.lower() for t in texts)


def test_export_of_many_doubles_compiles(spark, conf, tmp_path):
    """Generated code that fails to compile would raise here, instead of being replaced by slower evaluation."""
    conf({"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"})
    wide = spark.range(20).select("id", *[(F.col("id") * 10.0 ** (i - 20)).alias(f"d{i}") for i in range(60)], F.lit("t").alias("texts"))
    assert export_csv(wide, str(tmp_path / "out")) == 20
    back = land_csv(spark, str(tmp_path / "out"))
    assert back.columns == wide.columns
    assert sorted([float(x) for x in r[1:-1]] for r in back.collect()) == sorted(list(r[1:-1]) for r in wide.collect())


def test_partitioned_table_keeps_types_and_order(spark, tmp_path):
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2), (None, 3)], "m string, x int")
    path = str(tmp_path / "t")
    assert write_table(df, path, "m") == 3
    back = read_table(spark, path, like=df)
    assert back.dtypes == df.dtypes
    assert _rows(back) == _rows(df)


def test_table_exists_and_adhoc_sql(spark, tmp_path):
    assert not table_exists(spark, "nope_t")
    df = spark.range(50).withColumnRenamed("id", "x")
    materialize_table(df, "some_t", str(tmp_path / "t"))
    assert table_exists(spark, "some_t")
    assert adhoc_sql(spark, "SELECT x FROM some_t WHERE x >= :low ORDER BY x", {"low": 5}).count() == 45
    assert [r.x for r in adhoc_sql(spark, "SELECT x FROM some_t ORDER BY x", limit=2).collect()] == [0, 1]


def test_only_rows_that_begin_a_file_part_become_python_objects():
    import tracemalloc

    import pyarrow as pa

    def batch(rows):
        values, files, starts = zip(*rows) if rows else ((), (), ())
        kinds = pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((values, files, starts), kinds)], names=["value", "file", "start"])

    def kept(*batches):
        return [v for out in landing._without_headers(["a", "b"])(iter(batches)) for v in out.column(0).to_pylist()]

    head, more = ("a,b", "f", 0), ("a,b", "f", 0)
    parts = [head, more, ("1,2", "f", 9), ("a,b", "f", 9), ("a,b", "g", 0)]
    assert kept(batch([]), batch(parts), batch([("a,b", "g", 0), ("a,b", "h", 0)])) == ["a,b", "1,2", "a,b", "a,b"]
    with pytest.raises(ValueError, match="h has the header"):
        kept(batch([head, ("x,y", "h", 0)]))
    many = batch([("1,2", "some/long/path/to/a/file", 128)] * 100_000)
    tracemalloc.start()
    list(landing._without_headers(["a", "b"])(iter([many])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000


def test_rows_that_are_alike_are_neighbours_in_a_stored_table(spark, tmp_path):
    # in no order they took a third more bytes in the shuffle before writing.
    rows = spark.range(0, 3000, 1, 1).selectExpr("concat('k', id % 50) AS k", "id", "concat('2024-0', 1 + id % 2) AS m")
    assert write_table(rows, str(tmp_path / "t"), "m", side_by_side=("k",)) == 3000
    for folder in (tmp_path / "t").glob("m=*"):
        (file,) = folder.glob("*.parquet")
        keys = [r.k for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert len(keys) == 1500
        assert sum(a != b for a, b in zip(keys, keys[1:])) == len(set(keys)) - 1


def test_sample_files_are_landed_from_compressed_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    # the landing zone held plain text, more bytes than all stored tables together.
    from quarrystone.sources.landing import land_all
    from workload import jobs
    from workload.sample_feeds import sample_feeds

    monkeypatch.setitem(jobs.LANDED, "maxRecordsPerFile", 400)
    monkeypatch.setattr(jobs, "scratch_dir", lambda spark, label: str(tmp_path / label))
    sf = "/root/testdata/sf0.001"
    root, feeds = jobs._landing_zone(spark, sf), sample_feeds(spark, sf)
    files = [f for f in (tmp_path / "landing").rglob("part-*") if f.is_file()]
    assert files and all(f.suffix == ".gz" for f in files)
    assert len([f for f in files if "order_lines" in str(f)]) >= feeds["raw_order_lines"].count() / 400
    for name, landed in land_all(spark, root).items():
        expected = feeds[name].na.fill("").collect()
        assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, expected))
