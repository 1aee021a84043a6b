import pytest

from moldwise.sources import isolation as iso
from moldwise.sources import manifest as mf
from moldwise.sources import readers as rd

HEADER = "machine_def,timestamp,variable_name,value\n"


def name(path):
    return path.rsplit("/", 1)[-1]


@pytest.fixture
def files(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    whole = "".join(f"M1-10,2024-01-0{i} 01:00:00,Cushion,{i}.5\n" for i in range(1, 6))
    (d / "good.csv").write_text(HEADER + whole)
    (d / "turned.csv").write_text('value,"variable_name",machine_def,timestamp\n2.5,Cushion,M2-10,2024-01-02 01:00:00\n')
    (d / "bad_time.csv").write_text(HEADER + "M3-10,2024-01-01 01:00:00,Cushion,1\n\nM3-10,soon,Cushion,1\nM3-10,NaN,Cushion,1\n")
    (d / "no_value.csv").write_text("machine_def,timestamp,variable_name\nM4-10,2024-01-01 01:00:00,Cushion\n")
    (d / "wide.csv").write_text(HEADER + "M5-10,2024-01-01 01:00:00,Cushion,1,surplus\nM5-10,2024-01-02 01:00:00,Cushion,1\n")
    (d / "header_only.csv").write_text(HEADER)
    (d / "empty.csv").write_text("")
    (d / "note.txt").write_text("not a table\n")
    return str(d)


def test_manifest_has_every_header(spark, files):
    rows = {name(r["source_file"]): (r["size"], r["header"]) for r in mf.file_manifest(spark, files, "*.csv").collect()}
    columns = HEADER.strip().split(",")
    assert sorted(rows) == ["bad_time.csv", "good.csv", "header_only.csv", "no_value.csv", "turned.csv", "wide.csv"]
    assert rows["good.csv"][1] == columns and rows["no_value.csv"][1] == columns[:3]
    assert rows["turned.csv"][1] == ["value", "variable_name", "machine_def", "timestamp"] and rows["header_only.csv"][0] == len(HEADER)
    found = mf.layouts(mf.file_manifest(spark, files, "*.csv"))
    assert found[0] == (columns, 4) and sum(n for _, n in found) == 6


def test_header_names():
    assert mf.header_names('﻿a,"b, c",,d') == ["a", "b, c", "_c2", "d"] and mf.header_names("") == []


def test_manifest_reads_only_the_first_lines(spark, tmp_path):
    (tmp_path / "big.csv").write_text("\n  \na,b\n" + "1,2\n" * 400_000)
    apart = mf.file_manifest(spark, str(tmp_path))
    assert [r["header"] for r in apart.collect()] == [["a", "b"]]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "16"  # this session's settings stay


def test_whole_files_are_kept_apart(spark, files):
    good, bad = iso.read_isolated(spark, files, "machine_def string, timestamp timestamp, variable_name string, value double", "*.csv")
    assert sorted({name(r["source_file"]) for r in good.collect()}) == ["good.csv", "turned.csv"]
    assert good.count() == 6 and good.where("machine_def = 'M2-10'").first()["value"] == 2.5
    got = sorted((name(r["source_file"]), r["line"], r["column"], r["reason"], r["text"]) for r in bad.collect())
    assert [g[:4] for g in got] == [("bad_time.csv", 3, "timestamp", "not a timestamp"), ("no_value.csv", 1, "value", "the header lacks it"),
                                    ("wide.csv", 2, None, "more fields than the header has")]
    assert got[0][4] == "soon" and got[2][4].endswith("1,surplus")


def test_single_rows_are_kept_apart(spark, files):
    good, bad = iso.read_isolated(spark, files, "machine_def string, timestamp timestamp, value double", "*.csv", whole_files=False)
    rows = sorted((name(r["source_file"]), str(r["timestamp"])) for r in good.collect())
    assert [r[0] for r in rows] == ["bad_time.csv", "bad_time.csv"] + ["good.csv"] * 5 + ["turned.csv", "wide.csv"]
    assert rows[1][1] == "None" and bad.count() == 3  # a missing time isn't a fault


def test_lines_across_blocks_of_a_file(spark, tmp_path):
    lines = [f"M{i},{i if i % 701 else 'x'}" for i in range(1, 30_000)]
    (tmp_path / "long.csv").write_text("machine,qty\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        bad = iso.read_isolated(spark, str(tmp_path), "machine string, qty long", whole_files=False).quarantine.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["line"] for r in bad) == [i + 1 for i in range(701, 30_000, 701)]


def test_error_only_when_nothing_is_good(spark, tmp_path):
    (tmp_path / "a.csv").write_text("machine,qty\nM1,x\n")
    with pytest.raises(ValueError, match="nothing could be read: a.csv line 2: qty: not a bigint"):
        iso.read_isolated(spark, str(tmp_path), "machine string, qty long")
    with pytest.raises(ValueError, match="nothing could be read"):
        iso.read_isolated(spark, str(tmp_path), "machine string, qty long", glob="*.none")
    (tmp_path / "b.csv").write_text("machine,qty\nM1,3\n")
    assert iso.read_isolated(spark, str(tmp_path), "machine string, qty long").good.count() == 1


def test_machine_features_of_whole_files(spark, files):
    feats, bad = iso.machine_features(spark, files, variables=["Cushion"])
    assert sorted({r["machine_def"] for r in feats.collect()}) == ["M1-10", "M2-10"] and bad.count() == 3


def test_layouts_without_a_broadcast(spark, files, monkeypatch):
    want = sorted(map(tuple, rd.read_text_columns(spark, files, glob="*.csv").collect()), key=str)
    plan = rd.read_text_columns(spark, files, glob="*.csv")._jdf.queryExecution().toString()
    assert "Union" not in plan  # one scan for all layouts
    monkeypatch.setattr(rd, "MANIFEST_TO_SEND", 1)
    columns = rd.read_text_columns(spark, files, glob="*.csv").columns
    got = rd.read_text_columns(spark, files, glob="*.csv").select(*rd.read_text_columns(spark, files, glob="*.csv").columns)
    assert sorted(map(tuple, got.collect()), key=str) == want and columns == ["machine_def", "timestamp", "variable_name", "value"]
