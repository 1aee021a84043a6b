import pytest

from moldwise.sources import readers as rd


def test_read_readings_glob_and_machine_from_file(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    header = "machine_def,timestamp,variable_name,value,variable_attribute\n"
    (d / "M_117_Jan.csv").write_text(header + "M117-10,2024-01-05 01:00:00,Cushion,1.5,\n")
    (d / "M-612 Jan.csv").write_text(header + "M612-33,2024-01-05 02:00:00,Cushion,2.5,\n")
    (d / "notes.txt").write_text("not a csv\n")
    df = rd.read_readings(spark, str(d), glob="*.csv", machine_from_file=True)
    got = {r["machine_def"]: r["machine_id"] for r in df.collect()}
    assert got == {"M117-10": "M-117", "M612-33": "M-612"}
    assert rd.require_columns(df, ["variable_name", "value"]) and not rd.require_columns(df, ["nope"])


def test_filter_machine_and_write(spark, tmp_path):
    df = spark.createDataFrame([("M-105", 1), ("M 105", 2), ("M-106", 3)], "machine_nr string, v int")
    assert sorted(r["v"] for r in rd.filter_machine(df, "M-105").collect()) == [1, 2]
    assert rd.filter_machine(df, "M-105", "missing").count() == 0
    rd.write_dataset(df, str(tmp_path / "out"), partition_by=["machine_nr"])
    back = spark.read.parquet(str(tmp_path / "out")).where("machine_nr = 'M-106'")
    assert [r["v"] for r in back.collect()] == [3]
    rd.write_sample(df, str(tmp_path / "sample"), n=2)
    assert rd.read_csv(spark, str(tmp_path / "sample")).count() == 2


def test_columns_by_name_rare_decimals_and_missing_marks(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("machine,qty,note\n" + "".join(f"M{i},{i},x\n" for i in range(5000)) + "M5000,0.5,y\n")
    (raw / "b.csv").write_text("qty,machine\n7,M-b\nNaN,M-c\n,M-d\n")
    df = rd.read_production(spark, str(raw))
    assert dict(df.dtypes) == {"machine": "string", "qty": "double", "note": "string"}
    got = {r["machine"]: (r["qty"], r["note"]) for r in df.collect()}
    assert got["M5000"] == (0.5, "y") and got["M-b"] == (7.0, None) and got["M-c"][0] is None and got["M-d"][0] is None and len(got) == 5004


def test_readings_with_a_reordered_header_and_a_missing_column(spark, tmp_path):
    (tmp_path / "r.csv").write_text("timestamp,machine_def,value,variable_name\n2024-01-05 01:00:00,M117-10,1.5,Cushion\n")
    row = rd.read_readings(spark, str(tmp_path)).first()
    assert (row["machine_def"], row["variable_name"], row["value"], row["variable_attribute"]) == ("M117-10", "Cushion", "1.5", None)


def test_schema_is_strict(spark, tmp_path):
    (tmp_path / "p.csv").write_text("qty,day\n3,1/5/2024\n4.0,2024-01-06\nmany,2024-01-07\n")
    with pytest.raises(Exception, match="cannot parse 'many'"):
        rd.read_csv(spark, str(tmp_path), "qty long, day date").collect()
    got = [(r["qty"], str(r["day"])) for r in rd.read_csv(spark, str(tmp_path), "qty long, day date", strict=False).collect()]
    assert got == [(3, "2024-01-05"), (4, "2024-01-06"), (None, "2024-01-07")]
    assert rd.read_csv(spark, str(tmp_path), glob="*.none").count() == 0
