import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch import surrogates as src
from tidewatch.operators import checks, cleaning
from tidewatch.plans import jobs, reports
from tidewatch.sinks import tables
from tidewatch.sources import files, pings

DAY = "2024-01-10"


@pytest.fixture(scope="module")
def archive(spark, sf_dir, tmp_path_factory):
    """Cleaned pings laid out by date."""
    base = str(tmp_path_factory.mktemp("archive"))
    rows_ = src.fleet_pings(spark, sf_dir).withColumn("BaseDateTime", F.col("BaseDateTime").cast("timestamp"))
    tables.overwrite_by_date(rows_.withColumn("date", F.to_date("BaseDateTime")), base, "date")
    return base


def test_daily_kpis_job_is_repeatable(spark, archive, tmp_path):
    out = str(tmp_path / "out")
    first = jobs.daily_kpis(spark, archive, out, DAY)
    again = jobs.daily_kpis(spark, archive, out, DAY)
    jobs.daily_kpis(spark, archive, out, "2024-01-11")
    assert first == again and all(n > 0 for n in first.values())
    for name, n in first.items():
        day = files.read_day(spark, f"{out}/{name}", DAY, "kpi_date")
        assert day.count() == n
        if name in schemas.SERVING_KEYS:
            assert checks.uniqueness_violations(day, schemas.SERVING_KEYS[name]).isEmpty()
    pings_of_day = files.read_day(spark, archive, DAY).count()
    assert files.read_day(spark, f"{out}/route_density_grid", DAY, "kpi_date").agg(F.sum("ping_count")).first()[0] == pings_of_day
    with pytest.raises(checks.CheckFailed):
        jobs.daily_kpis(spark, archive, out, "1999-01-01")


def test_cluster_job_stores_result_and_model(spark, archive, tmp_path):
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    stamp = dt.datetime(2024, 2, 1)
    summary = jobs.cluster_day(spark, archive, out, models, DAY, run_ts=stamp)
    stored = files.read_day(spark, f"{out}/vessel_behavior_clusters", DAY, "kpi_date")
    assert summary.agg(F.sum("total_vessels")).first()[0] == stored.count() > 0
    assert stored.filter("point NOT LIKE 'POINT(%'").isEmpty()
    assert len(PipelineModel.load(f"{models}/date={DAY}").stages) == 3
    jobs.daily_kpis(spark, archive, out, DAY)
    assert jobs.verify_day(spark, out, DAY)["vessel_behavior_clusters"] == stored.count()
    with pytest.raises(checks.CheckFailed):
        jobs.verify_day(spark, out, "2024-01-11")
    again = jobs.cluster_day(spark, archive, str(tmp_path / "again"), models, DAY, run_ts=stamp, model_day=DAY)
    assert rows(again, *summary.columns) == rows(summary, *summary.columns)
    jobs.cluster_day(spark, archive, out, models, "2024-01-12", run_ts=stamp, model_day=DAY)
    assert not (tmp_path / "models" / "date=2024-01-12").exists() and files.read_day(spark, f"{out}/vessel_behavior_clusters", "2024-01-12", "kpi_date").count()


def test_days_run_one_after_the_other_whatever_fails(spark, archive, tmp_path):
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    with pytest.raises(checks.CheckFailed, match="^1 of 2 days failed: 1999-01-01: no rows in "):
        jobs.run_days(spark, archive, out, models, ["1999-01-01", DAY], k=3)
    counts = jobs.verify_day(spark, out, DAY)
    assert all(n > 0 for n in counts.values()) and (tmp_path / "models" / f"date={DAY}").exists()


def test_days_are_tried_again(spark, monkeypatch, capsys):
    tried = []

    def kpis_of(spark, archive, out, day):
        tried.append(day)
        if tried.count(day) < {"2024-02-29": 2, "2024-03-01": 9}.get(day, 0):
            raise RuntimeError(f"lost {day}\nmore")

    monkeypatch.setattr(jobs, "daily_kpis", kpis_of)
    monkeypatch.setattr(jobs, "cluster_day", lambda *a, **options: tried.append(options))
    monkeypatch.setattr(jobs, "verify_day", lambda spark, out, day: {"t": 1})
    assert jobs.run_days(spark, "a", "o", "m", jobs.days_between("2024-02-28", "2024-02-29"), k=4) == {"2024-02-28": {"t": 1}, "2024-02-29": {"t": 1}}
    assert tried == ["2024-02-28", {"k": 4, "pct": 95.0}, "2024-02-29", "2024-02-29", {"k": 4, "pct": 95.0}]
    with pytest.raises(checks.CheckFailed, match="^1 of 2 days failed: 2024-03-01: lost 2024-03-01$"):
        jobs.run_days(spark, "a", "o", "m", jobs.days_between("2024-03-01", "2024-03-02"))
    assert tried.count("2024-03-01") == 2 and tried[-2] == "2024-03-02"
    common = ["--archive", "a", "--out", "o", "--models", "m", "--retries", "0"]
    jobs.main(["days", "--from-date", "2024-02-28", "--to-date", "2024-02-28", *common])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"2024-02-28": {"t": 1}}


def test_empty_day_replaces_the_rows_before(spark, tmp_path):
    base = str(tmp_path / "t")
    full = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "kpi_date date, v int")
    tables.replace_days(full, base, ["2024-01-01", "2024-01-02"])
    tables.replace_day(full.limit(0), base, "2024-01-01")
    assert rows(spark.read.parquet(base), "v") == [(2,)]


def test_history_job_from_messages(spark, sf_dir, tmp_path):
    messages = src.messages_of(src.table(spark, sf_dir, "events"))
    jobs.clean_history(messages.select("value"), str(tmp_path / "out"), str(tmp_path / "rejects"))
    got = files.read_all(spark, str(tmp_path / "out"))
    parsed = cleaning.parse_json(messages.select("value"))
    assert got.count() == cleaning.clean(parsed, cleaning.BATCH)[0].count()
    assert files.read_all(spark, str(tmp_path / "rejects")).groupBy("reject_reason").count().count() >= 4


def test_command_line(spark, archive, tmp_path, capsys):
    out = str(tmp_path / "out")
    jobs.main(["daily-kpis", "--exec-date", DAY, "--archive", archive, "--out", out])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["fleet_daily_kpis"] > 0


def test_database_flags_and_voyages(spark, archive, tmp_path, monkeypatch):
    out, asked, exported = str(tmp_path / "out"), [], {}
    monkeypatch.setattr(jobs.reference, "jdbc_ports", lambda s, url, properties: asked.append((url, properties)) or schemas.ports(s))
    monkeypatch.setattr(jobs.tables, "jdbc_append", lambda rows, url, table, properties: exported.update({table: (rows.count(), url, properties)}))
    jobs.main([
        "daily-kpis", "--exec-date", DAY, "--archive", archive, "--out", out, "--ports-url", "jdbc:p", "--ports-property", "user=u",
        "--ports-property", "password=a=b", "--export-url", "jdbc:x", "--export-property", "driver=d", "--voyages", str(tmp_path / "voyages"),
    ])
    assert asked == [("jdbc:p", {"user": "u", "password": "a=b"})] and set(exported) == set(jobs.KPI_TABLES)
    visits = files.read_day(spark, f"{out}/port_dwell_times", DAY, "kpi_date").count()
    assert exported["port_dwell_times"] == (visits, "jdbc:x", {"driver": "d"})
    assert spark.read.parquet(str(tmp_path / "voyages")).count() == visits
    with pytest.raises(SystemExit):
        jobs.main(["daily-kpis", "--exec-date", DAY, "--archive", archive, "--out", out, "--export-property", "novalue"])


def test_legacy_csv_job(spark, tmp_path):
    (tmp_path / "in.csv").write_text("mmsi,timestamp,lat,lon,sog,cog\n1,t,1,2,3,4\n1,t,1,2,3,4\n2,t,95,2,3,4\n3,t,1,2,,4\n")
    jobs.clean_csv_legacy(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), "2024-12-25")
    got = files.read_all(spark, str(tmp_path / "out"))
    assert rows(got, "mmsi", "speed_kmh") == [("1", pytest.approx(5.556))] and "run_date" in got.columns


def test_ragged_csv_replay(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'MMSI,BaseDateTime,LAT,LON\n 1 , t1 ,1.0,2.0\nMMSI,BaseDateTime,LAT,LON\n2,t2\n,t3,1,2\n3,t4,1,2,EXTRA\n4,"a,b",1,2\n'
    )
    rows_ = files.read_ragged_csv(spark, str(tmp_path / "a.csv"))
    messages = [(r["key"], json.loads(r["value"])) for r in pings.to_messages(rows_).orderBy("key").collect()]
    assert [m[0] for m in messages] == ["1", "2", "3", "4"]
    assert messages[0][1] == {"MMSI": "1", "BaseDateTime": "t1", "LAT": "1.0", "LON": "2.0"}
    assert messages[1][1] == {"MMSI": "2", "BaseDateTime": "t2", "LAT": "", "LON": ""}
    assert messages[3][1]["BaseDateTime"] == "a,b"
    assert files.read_ragged_csv(spark, str(tmp_path / "a.csv"), max_rows=2).count() == 2
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    assert files.read_ragged_csv(spark, str(tmp_path / "b.csv")).count() == 0


def test_ragged_csv_reads_each_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MMSI,BaseDateTime,LAT,LON\n1,t1,1.0,2.0\n2,t2,3.0,4.0\n")
    (tmp_path / "b.csv").write_text("BaseDateTime,MMSI,LON,LAT,Port\nt3,3,9.0,8.0,Suez\nt4,4,7.0,6.0,Suez\n")
    (tmp_path / "c.csv").write_text("BaseDateTime,LAT\nt5,1.0\n")
    (tmp_path / "d.csv").write_text("")
    read = files.read_ragged_csv(spark, str(tmp_path))
    assert rows(read, "MMSI", "BaseDateTime", "LAT", "LON") == [
        ("1", "t1", "1.0", "2.0"), ("2", "t2", "3.0", "4.0"), ("3", "t3", "8.0", "9.0"), ("4", "t4", "6.0", "7.0"),
    ]
    messages = {r["key"]: json.loads(r["value"]) for r in pings.to_messages(read).collect()}
    assert messages["3"]["Port"] == "Suez" and "Port" not in messages["1"]
    assert rows(files.read_ragged_csv(spark, str(tmp_path), max_rows=1), "MMSI") == [("1",), ("3",)]


def test_delimited_and_column_reads(spark, tmp_path):
    (tmp_path / "bank.csv").write_text('"age";"job";"marital";"education";"default";"balance"\n30;"a b";"single";"x";"no";17\n25;"c";"married";"y";"no";5\n')
    schema = "age int, job string, marital string, education string, defaulted string, balance int"
    bank = files.read_delimited(spark, str(tmp_path / "bank.csv"), schema, ["age", "job", "marital", "education", "balance"])
    assert rows(bank) == [(25, "c", "married", "y", 5), (30, "a b", "single", "x", 17)]
    assert rows(reports.counts_below(bank, "age", 30)) == [(25, 1)]
    assert rows(reports.counts_where(bank, "age", F.col("marital") == "single")) == [(30, 1)]
    for year in (98, 99):
        (tmp_path / f"f{year}.csv").write_text(f"Year,Month,Carrier\n19{year},1,AA\n19{year},2,BB\n19{year},2,BB\n")
    flights = files.read_csv_columns(spark, [str(tmp_path / "f98.csv"), str(tmp_path / "f99.csv")], "Year int, Month int, Carrier string", ["Year", "Carrier"])
    best = reports.best_groups(flights, "Carrier", schemas.inline_rows(spark, [("BB", "Bee")], ("Carrier", "name")))
    assert rows(best, "Carrier", "n", "name") == [("BB", 4, "Bee")]
    files.write_csv(bank, str(tmp_path / "copy"))
    assert spark.read.option("header", True).csv(str(tmp_path / "copy")).count() == 2


def test_dwell_layout_and_sample(spark, sf_dir, tmp_path):
    visits = src.dwell(spark, sf_dir)
    tables.write_dwell(visits, str(tmp_path / "v"))
    got = files.read_all(spark, str(tmp_path / "v"))
    assert got.count() == visits.count() and {"voyage_date", "port"} <= set(got.columns)
    assert tables.console_sample(src.pings(spark, sf_dir)).count() == 20


def test_months_of_every_year(spark):
    days = [("1995-02-01",)] * 57 + [("1996-02-01",)] * 58 + [("2001-12-31",)] * 31 + [(None,)]
    orders = spark.createDataFrame(days, "d string").select(F.to_date("d").alias("d"))
    counts = reports.month_year_counts(orders, "d")
    assert rows(counts, "month", "year", "n") == [(12, 2001, 31), (2, 1995, 57), (2, 1996, 58), (None, None, 1)]
    assert rows(reports.month_year_per_day(counts), "month_name", "year", "per_day") == [
        ("Dec", 2001, 1), ("Feb", 1995, 2), ("Feb", 1996, 2), (None, None, None),
    ]


def test_pivot_covers_every_block_of_years(spark):
    days = [("1995-02-01",)] * 57 + [("1996-02-01",)] * 58 + [("1998-02-01",)] * 30 + [("2001-12-31",)] * 31 + [(None,)]
    orders = spark.createDataFrame(days, "d string").select(F.to_date("d").alias("d"))
    pivot = reports.month_pivot(orders, "d")
    assert rows(pivot, "from_year", "month_name", "year_1", "year_2", "year_3") == [(1995, "Feb", 57, 58, 0), (1998, "Feb", 30, 0, 0), (2001, "Dec", 31, 0, 0)]
    assert rows(reports.average_per_day(pivot), "from_year", "year_1", "year_2", "year_3") == [(1995, 2, 2, 0), (1998, 1, 0, 0), (2001, 1, 0, 0)]
    assert reports.month_pivot(orders.limit(0), "d").count() == 0
    assert reports.month_pivot(orders, "d", 7).columns == ["from_year", "month", "month_name", *[f"year_{k}" for k in range(1, 8)]]
