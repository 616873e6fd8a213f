import csv
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shop import cart, checkout, nested_shop, order, shop, view
from sluicebox import job, session
from sluicebox.operators.session_filter import dashboard_filter, filter_sessions
from sluicebox.plans import reports
from sluicebox.plans.mart import fct_sessions
from sluicebox.plans.quality import check_duplicate_traffic
from sluicebox.plans.staging import stg_traffic
from sluicebox.session import partitions_for, size_shuffles, unsized_shuffles
from sluicebox.sources.event_log import EVENTS_SCHEMA, load_event_log, shop_tables, stage_event_log, tagged_events
from sluicebox.sources.raw import SCHEMAS, load_raw, read_parquet
from sluicebox.sources.models import register_sql_models
from sluicebox.sources.scratch import new_folder
from sluicebox.sources.sinks import (
    read_mart,
    read_published,
    remove_old_versions,
    write_csv_file,
    write_mart,
    write_parquet,
    write_report_csv,
)
from sluicebox.sources.sql import query, run_sql_file

# By folder: rows of the four tables.
EVENT_LOG_ROWS = {"sf0.001": (391, 211, 201, 202), "sf0.01": (4052, 2038, 2014, 1981), "sf0.1": (40738, 20235, 19810, 20084)}
# By folder: sessions by funnel stage, then gross revenue and discount.
HEADLINE = {
    "sf0.001": (257, 82, 88, 82, 4691.99, 140.124),
    "sf0.01": (2640, 804, 852, 805, 47078.90, 1297.343),
    "sf0.1": (26585, 8072, 8735, 8423, 496614.23, 12685.851),
}


@pytest.mark.parametrize("folder", EVENT_LOG_ROWS)
def test_event_log(spark, folder):
    raw = load_event_log(spark, f"/root/testdata/{folder}")
    assert tuple(df.count() for _, df in raw.items()) == EVENT_LOG_ROWS[folder]
    for name, df in raw.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SCHEMAS[name]]
    row = reports.headline(fct_sessions(raw)).first()
    counts = (row.product_view_sessions, row.add_to_cart_sessions, row.checkout_sessions, row.purchase_sessions)
    assert (*counts, row.gross_revenue, row.discount) == HEADLINE[folder]


def _raw_rows():
    return {
        "traffic_logs": [view("s1", "2024-01-01 23:30:00.123456"), view("s2", "2024-01-02 00:30:00.000001", source=None)],
        "cart_actions": [cart("s1")],
        "checkout_events": [checkout("s1")],
        "orders": [order("s1", gross=20.0, discount=1.5)],
    }


@pytest.mark.parametrize("unit", ["ns", "us"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_raw_files_written_by_pandas(spark, tmp_path, unit, zone):
    """UTC timestamps of either unit are read as UTC wall-clock time in any session time zone."""
    for name, rows in _raw_rows().items():
        frame = pd.DataFrame(rows)
        frame["timestamp"] = pd.to_datetime(frame["timestamp"], utc=True, format="ISO8601").astype(f"datetime64[{unit}, UTC]")
        frame.to_parquet(tmp_path / f"{name}.parquet", index=False)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        mart = fct_sessions(load_raw(spark, str(tmp_path)))
        rows = mart.orderBy("session_id").collect()
        days = [row.day for row in reports.daily_trend(mart).collect()]
        kept = [r.session_id for r in filter_sessions(mart, "2024-01-02", "2024-01-02").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row.first_seen_at for row in rows] == [datetime(2024, 1, 1, 23, 30, 0, 123456), datetime(2024, 1, 2, 0, 30, 0, 1)]
    assert [row.traffic_source for row in rows] == ["Meta", "Unknown"]
    assert rows[0].net_revenue == 18.5
    assert days == [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    assert kept == ["s2"]


def test_a_missing_column_is_not_read_as_null(spark, tmp_path):
    shop(spark, [view("s1")]).traffic_logs.drop("device").write.parquet(f"{tmp_path}/traffic_logs.parquet")
    table = read_parquet(spark, f"{tmp_path}/traffic_logs.parquet", SCHEMAS["traffic_logs"])
    assert "device" not in table.columns
    with pytest.raises(AnalysisException):
        table.select("device")


def test_a_missing_table_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        load_raw(spark, f"{tmp_path}/nowhere")


def test_stored_mart_is_the_mart_and_filters_skip_partitions(spark, tmp_path):
    raw = shop(spark, [view("a", "2024-01-01 23:59:59"), view("b", "2024-01-02 00:00:00"), view("c", "2024-01-03 00:00:00")])
    mart = fct_sessions(raw)
    write_mart(mart, f"{tmp_path}/mart")
    stored = read_mart(spark, f"{tmp_path}/mart")
    assert sorted(stored.drop("first_seen_date").collect()) == sorted(mart.collect())
    kept = filter_sessions(stored, "2024-01-02", "2024-01-02")
    assert [row.session_id for row in kept.collect()] == ["b"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "first_seen_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(p.name for p in Path(f"{tmp_path}/mart").glob("version-*/first_seen_date=*")) == [
        "first_seen_date=2024-01-01",
        "first_seen_date=2024-01-02",
        "first_seen_date=2024-01-03",
    ]


def _csv(folder):
    (path,) = Path(folder).glob("*.csv")
    with path.open(encoding="utf-8", newline="") as file:
        return list(csv.reader(file))


def test_sinks_and_sql(spark, tmp_path):
    report = spark.createDataFrame([("b", None, ""), ("a", 1.5, 'say "x", y')], "name string, value double, text string")
    write_report_csv(report, f"{tmp_path}/deep/report")
    assert _csv(f"{tmp_path}/deep/report") == [["name", "value", "text"], ["b", "", ""], ["a", "1.5", 'say "x", y']]
    write_parquet(report, f"{tmp_path}/deep/table")
    assert read_published(spark, f"{tmp_path}/deep/table").count() == 2
    report.createOrReplaceTempView("report")
    assert query(spark, "SELECT name FROM report WHERE value > :least", {"least": 1}).first().name == "a"
    sql = tmp_path / "count.sql"
    sql.write_text("-- rows\nSELECT count(*) AS n FROM report;\n", encoding="utf-8")
    assert run_sql_file(spark, sql).first().n == 2


def test_job(spark, tmp_path):
    raw = nested_shop(spark)
    figures = {row.Figure: row.Value for row in job.run(spark, raw, str(tmp_path)).collect()}
    assert figures["Purchase sessions"] == "3" and figures["Incremental revenue"] == "$4.50"
    quality = _csv(f"{tmp_path}/data_quality_report")
    assert quality[0] == ["Metric", "Value", "Unit", "Status", "Detail"] and len(quality) == 10
    assert [row[0] for row in quality[1:3]] == ["Duplicate traffic rows", "Duplicate cart rows"]
    assert _csv(f"{tmp_path}/funnel_validation")[-1] == ["Purchase sessions", "3", "60.00%", "15.00%"]
    assert len(_csv(f"{tmp_path}/headline_report")) == 15
    assert read_mart(spark, f"{tmp_path}/fct_sessions").count() == 20


def test_shuffle_partitions_grow_with_the_input(spark):
    tebibyte = 1024**4
    assert partitions_for(1000, at_least=8) == 8
    assert partitions_for(tebibyte, at_least=200) == 4096
    assert partitions_for(100 * tebibyte, at_least=200) == 100_000
    assert size_shuffles(spark, "/root/testdata/sf0.001") == 8
    unsized_shuffles(spark)


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_loaders_size_shuffles_by_the_tables_they_read(spark, tmp_path, monkeypatch):
    """Other files of the folder do not count, each load replaces the last number, and one set by hand stays."""
    monkeypatch.setattr(session, "PARTITION_BYTES", 1_000)
    for name, df in nested_shop(spark).items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    load_raw(spark, str(tmp_path))
    sized = int(spark.conf.get(INITIAL))
    assert sized > 8
    (tmp_path / "other.bin").write_bytes(b"x" * 1_000_000)
    load_raw(spark, str(tmp_path))
    assert int(spark.conf.get(INITIAL)) == sized
    load_event_log(spark, "/root/testdata/sf0.01")
    assert int(spark.conf.get(INITIAL)) > sized
    unsized_shuffles(spark)
    assert spark.conf.get(INITIAL, None) is None
    spark.conf.set(INITIAL, "33")
    load_raw(spark, str(tmp_path))
    unsized_shuffles(spark)
    assert spark.conf.get(INITIAL) == "33"
    spark.conf.unset(INITIAL)


def test_events_of_unknown_types_are_traffic(spark):
    rows = [(i, datetime(2024, 1, 1), i, kind, 1.0, "{k: 1}") for i, kind in enumerate(["view", "refund", None, "click"], 1)]
    raw = shop_tables(spark.createDataFrame(rows, EVENTS_SCHEMA))
    assert [df.count() for _, df in raw.items()] == [3, 1, 0, 0]


def test_events_within_a_microsecond_are_no_copies(spark, tmp_path):
    frame = pd.DataFrame([view("s1"), view("s1"), view("s1")])
    frame["timestamp"] = pd.to_datetime([1_704_103_200_000_000_001, 1_704_103_200_000_000_002, 1_704_103_200_000_000_002])
    frame.to_parquet(tmp_path / "traffic_logs.parquet", index=False)
    traffic = read_parquet(spark, f"{tmp_path}/traffic_logs.parquet", SCHEMAS["traffic_logs"])
    staged = stg_traffic(traffic)
    assert staged.count() == 2 and "timestamp_nanos" not in staged.columns
    assert check_duplicate_traffic(traffic).first().Value == 1


def test_a_failed_write_leaves_the_last_mart(spark, tmp_path):
    mart = fct_sessions(shop(spark, [view("a")]))
    write_mart(mart, f"{tmp_path}/mart")
    broken = mart.withColumn("first_seen_at", F.raise_error(F.lit("broken")).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="broken"):
        write_mart(broken, f"{tmp_path}/mart")
    assert [row.session_id for row in read_mart(spark, f"{tmp_path}/mart").collect()] == ["a"]
    write_mart(fct_sessions(shop(spark, [view("b")])), f"{tmp_path}/mart")
    assert [row.session_id for row in read_mart(spark, f"{tmp_path}/mart").collect()] == ["b"]


def test_filters_take_lists_and_no_text(spark):
    mart = fct_sessions(shop(spark, [view("a")]))
    for build in (lambda: filter_sessions(mart, sources="Meta"), lambda: dashboard_filter(mart, devices="mobile")):
        with pytest.raises(TypeError):
            build()


def test_date_filters_read_the_days_that_can_match(spark, tmp_path):
    views = [view(f"s{day}{hour}", f"2024-01-0{day} {hour}:00:00") for day in (1, 2, 3) for hour in ("01", "23")]
    write_mart(fct_sessions(shop(spark, views)), f"{tmp_path}/mart")
    stored = read_mart(spark, f"{tmp_path}/mart")

    def days(start, end):
        kept = filter_sessions(stored, start, end)
        kept.collect()
        plan = kept._jdf.queryExecution().executedPlan()
        scan = plan.collectLeaves().head()
        return scan.metrics().apply("numPartitions").value(), kept.count()

    assert days("2024-01-02", "2024-01-02") == (1, 2)
    assert days("2024-01-02 12:00:00", "2024-01-02 12:00:00") == (2, 2)


def test_job_command_on_an_event_log(spark, tmp_path, capfd):
    job.main(["/root/testdata/sf0.001", str(tmp_path), "--event-log", "--relative-improvement", "0.5"])
    figures = {row[1]: row[2] for row in _csv(f"{tmp_path}/headline_report")[1:]}
    assert figures["Product-view sessions"] == "257" and figures["Target rate"] == "100.00%"
    assert read_mart(spark, f"{tmp_path}/fct_sessions").count() == 257


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_one_row_per_session_on_the_event_log(spark, folder):
    mart = fct_sessions(load_event_log(spark, f"/root/testdata/{folder}"))
    assert mart.count() == mart.select("session_id").distinct().count()


def test_a_failed_write_leaves_the_last_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    rows = spark.range(10)
    write_parquet(rows, path)
    with pytest.raises(Exception, match="broken"):
        write_parquet(rows.select(F.when(F.col("id") == 9, F.raise_error(F.lit("broken"))).alias("id")), path)
    assert read_published(spark, path).count() == 10
    write_parquet(rows.limit(3), path)
    assert read_published(spark, path).count() == 3


def test_old_versions_are_removed_but_not_the_last(spark, tmp_path):
    path = f"{tmp_path}/table"
    for n in (1, 2, 3):
        write_parquet(spark.range(n), path)
    versions = {folder.name for folder in Path(path).glob("version-*")}
    assert len(versions) == 3 and remove_old_versions(spark, path, timedelta(hours=1)) == []
    removed = remove_old_versions(spark, path, timedelta(seconds=-5))
    assert len(removed) == 2 and set(removed) < versions
    assert {folder.name for folder in Path(path).glob("version-*")} == versions - set(removed)
    assert read_published(spark, path).count() == 3


def test_a_report_as_one_file(spark, tmp_path):
    path = tmp_path / "deep" / "report.csv"
    for n in (2, 1):
        write_csv_file(spark.range(n).selectExpr("id", "'a, b' AS text"), str(path))
    assert path.read_text().splitlines() == ["id,text", '0,"a, b"']
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["report.csv"]


def _models(folder, **files):
    folder.mkdir()
    for name, sql in files.items():
        (folder / f"{name}.sql").write_text(sql, encoding="utf-8")
    return folder


def test_sql_models_in_any_order(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("numbers")
    spark.range(99).createOrReplaceTempView("b_even")  # an old view that the folder replaces
    folder = _models(
        tmp_path / "models",
        a_sum="-- last\nSELECT sum(id) AS s FROM c_both;\n",
        b_even="SELECT id FROM numbers WHERE id % 2 = 0",
        c_both="SELECT id FROM b_even UNION ALL SELECT id FROM numbers",
    )
    assert register_sql_models(spark, folder) == ["b_even", "c_both", "a_sum"]
    assert spark.table("a_sum").first().s == 6 + 10
    assert register_sql_models(spark, folder) == ["b_even", "c_both", "a_sum"]
    assert register_sql_models(spark, _models(tmp_path / "none")) == []


def test_sql_models_that_cannot_be_built(spark, tmp_path):
    circle = _models(tmp_path / "circle", x1="SELECT * FROM x2", x2="SELECT * FROM x1", x3="SELECT 1 AS one")
    with pytest.raises(ValueError, match="circle: x1, x2"):
        register_sql_models(spark, circle)
    with pytest.raises(ValueError, match="circle: y"):
        register_sql_models(spark, _models(tmp_path / "own", y="SELECT * FROM y"))
    with pytest.raises(AnalysisException, match="nowhere"):
        register_sql_models(spark, _models(tmp_path / "missing", z1="SELECT * FROM z2", z2="SELECT * FROM nowhere"))
    with pytest.raises(AnalysisException, match="no_such_column"):
        register_sql_models(spark, _models(tmp_path / "wrong", w="SELECT no_such_column FROM range(1)"))


def test_staged_event_log_is_the_event_log_from_one_pass(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    plan = tagged_events(read_parquet(spark, f"{path}/events.parquet", EVENTS_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    staged = stage_event_log(spark, path, f"{tmp_path}/raw")
    for (name, table), (_, expected) in zip(staged.items(), load_event_log(spark, path).items(), strict=True):
        assert table.schema.simpleString() == expected.select(*table.columns).schema.simpleString(), name
        assert sorted(table.collect(), key=str) == sorted(expected.select(*table.columns).collect(), key=str), name
    assert "PartitionFilters: [isnotnull(raw_table" in staged.orders._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("master", ["local", "local[2]", "local[*]"])
def test_scratch_folders_without_a_setting(master):
    def session(name, setting=None):
        conf = SimpleNamespace(get=lambda key, default: setting or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=name, applicationId=f"app-{name}"))

    one, other = new_folder(session(master), "a"), new_folder(session(master), "a")
    assert one != other and Path(one).parent == Path(other).parent and Path(one).parent.is_dir()
    assert new_folder(session("spark://x", "hdfs://shared/"), "a").startswith("hdfs://shared/a-")
    for cluster in ("spark://x", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            new_folder(session(cluster), "a")
