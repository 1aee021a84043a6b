from pyspark.sql import functions as F

from moldwise.functions import columns as fn


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_duration_seconds(spark):
    assert _one(spark, fn.duration_seconds, "02:43:19") == 9799.0
    assert _one(spark, fn.duration_seconds, "00:01:30") == 90.0
    assert _one(spark, fn.duration_seconds, " 1:30 ") == 90.0
    assert _one(spark, fn.duration_seconds, "0:00:01.5") == 1.5
    assert _one(spark, fn.duration_seconds, "abc") is None
    assert _one(spark, fn.duration_seconds, "1:2:3:4") is None
    assert _one(spark, fn.duration_seconds, None) is None


def test_to_number(spark):
    assert _one(spark, fn.to_number, " 12.5 ") == 12.5
    assert _one(spark, fn.to_number, "1e3") == 1000.0
    assert _one(spark, fn.to_number, "1.0d") is None   # Spark alone would accept it
    assert _one(spark, fn.to_number, "5f") is None
    assert _one(spark, fn.to_number, "0A000") is None
    assert _one(spark, fn.to_number, "NaN") is None


def test_machine_keys(spark):
    assert _one(spark, lambda c: fn.machine_key(c, "strip"), "M-221") == "M221"
    assert _one(spark, lambda c: fn.machine_key(c, "strip"), "M 22-1") == "M221"
    assert _one(spark, lambda c: fn.machine_key(c, "digits3"), "M612-33") == "M612"
    assert _one(spark, lambda c: fn.machine_key(c, "digits3"), "Mx") == "Unknown"
    assert _one(spark, lambda c: fn.machine_key(c, "hyphen"), "M231-11") == "M-231"
    assert _one(spark, lambda c: fn.machine_key(c, "hyphen"), "M-231") == "M-231"
    assert _one(spark, fn.production_core, "M-221") == "221"
    assert _one(spark, fn.sensor_core, "M221-10") == "221"


def test_machine_key_from_path(spark):
    assert _one(spark, fn.machine_key_from_path, "/data/raw/M_117_Jan.csv") == "M-117"
    assert _one(spark, fn.machine_key_from_path, "/data/raw/m-612 jan.csv") == "M-612"
    assert _one(spark, fn.machine_key_from_path, "/data/raw/other.csv") == "Unknown"


def test_classify_variable(spark):
    names = ["Cyl_tmp_z2", "Time_on_machine", "Machine_status", "Shot_counter", "Scrap_counter", "Cushion"]
    got = [_one(spark, fn.classify_variable, n) for n in names]
    assert got == ["excluded", "time_duration", "categorical", "counters", "counters", "numeric"]


def test_risk_status(spark):
    assert _one(spark, lambda c: fn.risk_status(c, 100.0), 100.5, "double") == "HIGH RISK"
    assert _one(spark, lambda c: fn.risk_status(c, 100.0), 100.0, "double") == "NORMAL"
