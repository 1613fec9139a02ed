"""File sources (S1–S6), the build from files, zip archives and the stream."""

import tempfile
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from punctuo.plans.build import build_from_files
from punctuo.sources import files as S

FLIGHTS = (
    "﻿Identifier,STD,STA_STD_ltc,ATA_ATD_ltc,FLT,LSV,TAR,GAT,DL1,IX1,DL2,IX2,ACT,RWY,RWC,Org/Des\n"
    "01/01/2019 22:45 EZY1,01/01/2019,22:45:00,00:05:00,EZY1, S ,A1,-,-,-,-,-,A320,28,-,LFPG\n"
    "01/01/2019 10:00 LX92,01/01/2019,10:00:00,10:20:00,LX92,L,A2,B3,93,-,-,-,A321,14,2,BER\n"
    "01/01/2019 10:00 LX92,01/01/2019,10:00:00,10:20:00,LX92,L,A2,B3,93,-,-,-,A321,14,2,BER\n"
    "02/01/2019 11:00 A3850,02/01/2019,11:00:00,-,A3850,S,A3,-,-,-,-,-,B738,16,-,#N/A\n"
    "02/01/2019 12:00 LX1,02/01/2019,12:00:00,12:30:00,LX1,S,A3,-,-,-,-,-,B738,16,-,QQQQ\n"
)
AIRPORTS = (
    '1,"Zurich Airport","Zurich","Switzerland","ZRH","LSZH",47.464699,8.54917,1416,1,"E","Europe/Zurich","airport","OurAirports"\n'
    '2,"Charles de Gaulle","Paris","France","CDG","LFPG",49.012798,2.55,392,1,"E","Europe/Paris","airport","OurAirports"\n'
    '3,"Berlin Brandenburg","Berlin","Germany","BER",\\N,52.351389,13.493889,157,1,"E","Europe/Berlin","airport","OurAirports"\n'
    '4,"Paris duplicate","Paris","France",\\N,"LFPG",0,0,0,1,"E","x","airport","x"\n'
)
WEATHER = ("date,tavg,tmin,tmax,prcp,snow,tsun,wspd,wpgt,pres\n"
           "2019-01-01,1.5,-2.0,4.0,0.0,,,10.0,35.0,1020.0\n"
           "2019-01-02,3.0,1.0,6.0,2.5,,,12.0,61.0,1012.0\n")


@pytest.fixture(scope="module")
def files():
    d = Path(tempfile.mkdtemp(prefix="punctuo-src-"))
    (d / "flights").mkdir()
    (d / "flights" / "schedule.csv").write_text(FLIGHTS, encoding="utf-8")
    (d / "airports.csv").write_text(AIRPORTS, encoding="utf-8")
    (d / "weather.csv").write_text(WEATHER, encoding="utf-8")
    (d / "zips").mkdir()
    with zipfile.ZipFile(d / "zips" / "schedule.zip", "w") as zf:
        zf.writestr("schedule.csv", FLIGHTS.encode("utf-8"))
    return d


def test_read_flights_all_strings_bom(spark, files):
    df = S.read_flights(spark, str(files / "flights"))
    assert df.columns[0] == "Identifier" and all(t == "string" for _, t in df.dtypes)
    assert df.count() == 5


def test_zip_equals_plain(spark, files):
    a = S.read_flights(spark, str(files / "flights"))
    z = S.read_flights(spark, str(files / "zips" / "schedule.zip"))
    assert z.columns == a.columns
    clean = lambda df: sorted(tuple(r) for r in S.X.null_tokens(S.X.trim_strings(df)).collect())
    assert clean(a) == clean(z)


def test_read_airports(spark, files):
    a = S.read_airports(spark, str(files / "airports.csv"))
    r = {x.Airport_ID: x for x in a.collect()}
    assert r["3"].ICAO is None and r["1"].Latitude == pytest.approx(47.464699) and r["1"].Name == "Zurich Airport"
    assert dict(a.dtypes)["Latitude"] == "double"


def test_build_from_files(spark, files):
    out_dir = tempfile.mkdtemp(prefix="punctuo-fact-")
    fact = build_from_files(spark, str(files / "flights"), str(files / "airports.csv"), str(files / "weather.csv"),
                            path=out_dir + "/fact")
    rows = {r.flight_no: r for r in fact.collect()}
    assert len(rows) == 4                                   # exact duplicate removed
    assert rows["EZY1"].delay_min == 80 and rows["EZY1"].Name == "Charles de Gaulle"   # lowest id wins
    assert rows["EZY1"].frost is True and rows["EZY1"].hour_load == 1
    assert rows["LX92"].Name == "Berlin Brandenburg" and rows["LX92"].matched_by == "key_b"
    assert rows["A3850"].place_code is None and rows["A3850"].delay_min is None and rows["A3850"].is_late is False
    assert rows["LX1"].Name is None and rows["LX1"].is_late is True
    assert rows["EZY1"].distance_km == pytest.approx(476.3, abs=1) and rows["EZY1"].area == "europe and around"
    written = spark.read.parquet(out_dir + "/fact")
    assert written.count() == 4 and "year" in written.columns


def test_weather_bad_period(spark, files):
    w = S.clean_weather(S.read_weather(spark, str(files / "weather.csv")), "2019-01-02")
    got = {r.day.day: r.prcp for r in w.collect()}
    assert got == {1: 0.0, 2: None} and "snow" not in w.columns


def test_stream_ingest(spark, files):
    from punctuo.plans.build import airport_dimension
    from punctuo.streaming.ingest import start_ingest
    base = Path(tempfile.mkdtemp(prefix="punctuo-stream-"))
    src = base / "in"
    src.mkdir()
    (src / "day1.csv").write_text(FLIGHTS, encoding="utf-8")
    cols = S.read_flights(spark, str(files / "flights")).columns
    dim = airport_dimension(S.read_airports(spark, str(files / "airports.csv")), "LSZH")
    q = start_ingest(spark, str(src), cols, dim, str(base / "fact"), str(base / "ckpt"),
                     place_attrs=("Name", "distance_km"), key_a="ICAO", key_b="IATA", order=("_order",), found="Name")
    q.awaitTermination(120)
    out = spark.read.parquet(str(base / "fact"))
    assert out.count() == 4 and out.filter(F.col("Name") == "Berlin Brandenburg").count() == 1


def test_jobs_build_and_report(spark, files):
    from punctuo.plans import jobs
    out = Path(tempfile.mkdtemp(prefix="punctuo-job-"))
    jobs.build(spark, type("A", (), {"flights": str(files / "flights"), "airports": str(files / "airports.csv"),
                                    "weather": str(files / "weather.csv"), "out": str(out / "fact"), "home": "LSZH"})())
    args = type("A", (), {"fact": str(out / "fact"), "out": str(out / "rep"), "year": 2019, "direction": None,
                          "airline": None, "aircraft": None, "min_n": 1, "approx": False})()
    jobs.report(spark, args)
    assert spark.read.parquet(str(out / "rep" / "by_direction_hour")).count() >= 1
    assert spark.read.parquet(str(out / "fact")).count() == 4


def test_stream_daily_timeline(spark, files):
    from punctuo.streaming.timeline import start_daily_timeline
    base = Path(tempfile.mkdtemp(prefix="punctuo-tl-"))
    src = base / "in"
    src.mkdir()
    late_day = FLIGHTS + "09/01/2019 09:00 LX5,09/01/2019,09:00:00,09:30:00,LX5,S,A1,-,-,-,-,-,A320,28,-,LFPG\n"
    (src / "f.csv").write_text(late_day, encoding="utf-8")
    cols = S.read_flights(spark, str(files / "flights")).columns
    q = start_daily_timeline(spark, str(src), cols, str(base / "out"), str(base / "ckpt"), lateness="1 day")
    q.awaitTermination(120)
    out = {(r.bucket.day, r.series): r for r in spark.read.parquet(str(base / "out")).collect()}
    # days 1 and 2 are closed by the watermark (day 9 advances it); day 9 stays open
    assert out[(1, "arrival")].n == 2 and out[(1, "departure")].n == 1
    assert out[(2, "departure")].n == 2 and out[(2, "departure")].late_pct == 50.0
    assert not any(day == 9 for day, _ in out)


def test_stream_ingest_dedups_across_batches(spark, files):
    from punctuo.plans.build import airport_dimension
    from punctuo.streaming.ingest import start_ingest
    base = Path(tempfile.mkdtemp(prefix="punctuo-stream2-"))
    src = base / "in"
    src.mkdir()
    (src / "a.csv").write_text(FLIGHTS, encoding="utf-8")
    (src / "b.csv").write_text(FLIGHTS, encoding="utf-8")        # the same rows again, in a later batch
    cols = S.read_flights(spark, str(files / "flights")).columns
    dim = airport_dimension(S.read_airports(spark, str(files / "airports.csv")), "LSZH")
    q = start_ingest(spark, str(src), cols, dim, str(base / "fact"), str(base / "ckpt"),
                     place_attrs=("Name",), key_a="ICAO", key_b="IATA", order=("_order",), found="Name",
                     max_files_per_trigger=1, lateness="30 days")
    q.awaitTermination(180)
    assert spark.read.parquet(str(base / "fact")).count() == 4


def test_jobs_report_approx(spark, files):
    from punctuo.plans import jobs
    out = Path(tempfile.mkdtemp(prefix="punctuo-job2-"))
    jobs.build(spark, type("A", (), {"flights": str(files / "flights"), "airports": str(files / "airports.csv"),
                                    "weather": str(files / "weather.csv"), "out": str(out / "fact"), "home": None})())
    args = type("A", (), {"fact": str(out / "fact"), "out": str(out / "rep"), "year": None, "direction": "departure",
                          "airline": None, "aircraft": None, "min_n": 1, "approx": True})()
    jobs.report(spark, args)
    by_year = spark.read.parquet(str(out / "rep" / "by_year")).collect()
    assert len(by_year) == 1 and by_year[0].n == 3
    assert spark.read.parquet(str(out / "rep" / "by_weekday_hour")).count() == 7


def test_zip_members_with_other_columns(spark, tmp_path):
    """Columns besides the wanted ones pass through; a column that only a later member has is an error, not dropped."""
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as zf:
        zf.writestr("one.csv", "a,b\n1,2\n")
    got = S.read_flights_zip(spark, str(tmp_path / "a.zip"), ["b"])
    assert got.columns == ["b", "a"] and [tuple(r) for r in got.collect()] == [("2", "1")]
    with pytest.raises(ValueError, match="missing"):
        S.read_flights_zip(spark, str(tmp_path / "a.zip"), ["z"])
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as zf:
        zf.writestr("one.csv", "a,b\n1,2\n")
        zf.writestr("two.csv", "b,a,c\n4,3,5\n")
    with pytest.raises(Exception, match="columns that the first archive lacks"):
        S.read_flights_zip(spark, str(tmp_path / "b.zip")).collect()
