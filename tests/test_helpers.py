import json

from moldwise.operators import joins as jn
from moldwise.operators import quality as ql
from moldwise.operators import summaries as sm
from moldwise.session import cluster_conf

READ = "machine_def string, timestamp string, variable_name string, value string, variable_attribute string"
PROD = "order_id long, machine_id string, date string, actual_scrap_qty double"


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 1024 ** 4, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(1024, executor_cores=4, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 16          # at least twice the task slots
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_report_json_structure(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0)], "k int, s string, v double")
    issues = ql.validate_production(df, target="v", key_columns=["k"], dataset="D")
    doc = json.loads(ql.report_json(ql.validation_report(issues, df, "D"), issues, sm.column_stats(df)).first()["json"])
    assert doc["dataset"] == "D" and doc["row_count"] == 2 and doc["is_valid"] is False
    assert {i["issue_type"] for i in doc["issues"]} >= {"insufficient_data", "missing_values", "duplicates"}
    assert {c["column"] for c in doc["column_stats"]} == {"k", "s", "v"}


def test_build_ml_dataset(spark):
    readings = spark.createDataFrame([("M221-10", "2024-01-05 01:00:00", "Cushion", "2.0", None),
                                      ("M221-10", "2024-01-05 03:00:00", "Cushion", "4.0", None)], READ)
    prod = spark.createDataFrame([(1, "M-221", "05-01-2024", 3.0), (2, "M-999", "05-01-2024", 1.0)], PROD)
    rows = {r["order_id"]: r for r in jn.build_ml_dataset(readings, prod).collect()}
    assert rows[1]["Cushion_mean"] == 3.0 and rows[1]["machine_key"] == "M221-10"
    assert rows[2]["Cushion_mean"] is None


def test_checkpoint_dir_requires_shared_folder_on_a_cluster():
    import pytest

    from moldwise.session import checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Session:
        conf = _Conf()
        sparkContext = _Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session())
