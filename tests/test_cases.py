import random
from datetime import date, timedelta

import pytest
from conftest import column

from tallycast.functions.dates import day_of, parse_date
from tallycast.operators import aggregates as A
from tallycast.operators import shape as P
from tallycast.operators import windows as X
from tallycast.plans import covid_daily
from tallycast.sources import reports as R
from pyspark.sql import functions as F

DAY = [date(2020, 3, d) for d in range(1, 10)]


def reports(spark, rows):
    return spark.createDataFrame(rows, "Country_Region string, date date, Confirmed double, Deaths double, Recovered double")


def test_change_with_a_null(spark):
    df = reports(spark, [("A", DAY[i], v, 0.0, 0.0) for i, v in enumerate([1.0, 3.0, None, 9.0])])
    assert column(X.with_daily_change(df), "New_Confirmed") == [0, 2, 0, 0]
    assert column(X.with_daily_change(df, fill=None), "New_Confirmed") == [None, 2, None, None]


def test_reset_below_zero_is_kept(spark):
    df = reports(spark, [("A", DAY[0], 5.0, 0.0, 0.0), ("A", DAY[1], 4.0, 0.0, 0.0)])
    assert column(X.with_daily_change(df), "New_Confirmed") == [0, -1]


def test_changes_sum_to_last_minus_first(spark, series):
    df = X.with_daily_change(series(a=[3, 8, 2, 11]), "series", ["value"])
    assert df.agg(F.sum("New_value")).first()[0] == 8


def test_daily_reports_from_folders(spark, tmp_path):
    """Old and new header, a missing country, bad numbers and a date from the folder."""
    for day, head, rows in [
        ("2020-03-01", "Country_Region,Confirmed,Deaths,Recovered,date,Other", ["Spain,10,1,abc,03-01-2020,x", "Spain,5,,2,03-01-2020,x", "France,9,9,9,03-01-2020,x"]),
        ("2020-03-02", "Id,Country/Region,Confirmed,Deaths,Recovered,date", ["7,Spain,20,1,3,03-02-2020", "8,Chile,4,0,0,"]),
    ]:
        folder = tmp_path / f"extract_date={day}"
        folder.mkdir()
        (folder / "part.csv").write_text("\n".join([head, *rows]) + "\n")
    out = covid_daily(spark, str(tmp_path), {"Spain": 4, "Chile": 2})
    rows = {(r.Country_Region, str(r.date)): r for r in out.collect()}
    assert len(rows) == 4
    spain = rows["Spain", "2020-03-01"]
    assert (spain.Confirmed, spain.Deaths, spain.Recovered, spain.Active) == (15, 1, 2, 12)
    assert rows["Chile", "2020-03-01"].Confirmed == 0
    assert rows["Chile", "2020-03-02"].New_Confirmed == 4
    again = covid_daily(spark, str(tmp_path), {"Spain": 4, "Chile": 2}, history=out)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_mixed_headers(spark, tmp_path):
    (tmp_path / "new.csv").write_text("FIPS,Country_Region,Confirmed,Deaths,Recovered,date\n1,Spain,1,2,3,03-01-2020\n")
    (tmp_path / "old.csv").write_text('Country/Region,date,Recovered,Confirmed,Deaths\nChile,03-02-2020,6,4,\n"Korea, South",03-02-2020,0,1,0\n')
    df = R.select_measures(R.read_drifting_reports(spark, str(tmp_path)))
    assert sorted(map(tuple, df.collect())) == [
        ("Chile", "03-02-2020", 4.0, None, 6.0), ("Korea, South", "03-02-2020", 1.0, 0.0, 0.0), ("Spain", "03-01-2020", 1.0, 2.0, 3.0)
    ]
    with pytest.raises(Exception, match="CSV header does not conform"):
        R.read_reports(spark, str(tmp_path)).select("Deaths").collect()


def test_folder_date(spark, tmp_path):
    folder = tmp_path / "extract_date=2021-12-31"
    folder.mkdir()
    (folder / "a.csv").write_text("Country_Region\nSpain\n")
    assert R.with_extract_date(R.read_reports(spark, str(tmp_path))).first().date == "12-31-2021"


def test_bad_dates_are_null(spark):
    df = spark.createDataFrame([("02-30-2020",), ("2020-01-01",), ("12-31-2020",)], "t string")
    assert [r[0] for r in df.select(parse_date("t")).collect()] == [None, None, date(2020, 12, 31)]
    assert spark.range(1).select(day_of(F.lit("2020-05-06T01:02:03.000Z"))).first()[0] == date(2020, 5, 6)


def test_numeric_text(spark):
    df = spark.createDataFrame([("+1,234",), ("N/A",), ("",), (" 5 ",)], "x string")
    assert [r.x for r in P.clean_numeric(df, ["x"]).collect()] == [1234.0, None, None, 5.0]


def test_mortality_without_population(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0)], "TotalDeaths double, Population double")
    assert [r.Mortality for r in P.with_mortality(df).collect()] == [None, 0.5]


def test_fill_keeps_existing_nulls(spark):
    df = reports(spark, [("A", DAY[0], None, 1.0, 1.0), ("A", DAY[2], 2.0, 1.0, 1.0)])
    out = P.fill_missing_days(df, ["Country_Region"], "2020-03-01", "2020-03-03")
    assert column(out, "Confirmed") == [None, 0.0, 2.0]


def test_map_values_keeps_the_rest(spark):
    df = spark.createDataFrame([("AR",), ("CH",), ("CL",), ("7",), ("xx",)], "c string")
    from tallycast.constants import CODE_IDS

    assert [r.c for r in P.map_values(df, "c", CODE_IDS, "int").collect()] == [1, 2, 2, 7, None]


def test_outliers_and_clamp(spark, series):
    df = series(a=[1, 2, 3, 100, -5])
    assert column(X.repair_outliers(df, 50.0), "value") == [1, 2, 3, 2, -5]
    assert column(X.repair_outliers(df, 1000.0), "value") == [1, 2, 3, 100, -5]
    assert column(P.clamp(df), "value") == [1, 2, 3, 100, 0]


def test_two_zeros_in_a_row(spark, series):
    good = [7, 14, 21, 28, 35, 42, 49]
    df = X.repair_zeros(series(a=[*good, 0, 0], b=[1, 2, 0, 4, 5, 6, 7, 8, 9]))
    rows = {k: column(df.filter(F.col("series") == k), "value", "zero_status") for k in "ab"}
    assert rows["a"][7] == (28.0, "repaired")
    assert rows["a"][8] == (pytest.approx((sum(good) - 7 + 28) / 7), "repaired")
    assert rows["b"][2] == (0.0, "left")


def test_zeros_against_a_plain_loop(spark):
    r = random.Random(12)
    rows = []
    for k in ["a", "b", "c", None]:
        for n in range(400):
            if r.random() < 0.97:
                rows.append((k, date(2020, 1, 1) + timedelta(days=n), r.choice([0.0, 0.0, None, *range(1, 30)]) if k != "c" else 5.0, f"x{n}"))
    rows.append(("a", None, 0.0, "no date"))
    want = []
    for k in {x[0] for x in rows}:
        known = {}
        for _, d, v, x in sorted((x for x in rows if x[0] == k), key=lambda x: (x[1] is None, x[1])):
            before = [known.get(d - timedelta(days=i)) for i in range(1, 8)] if d else [None]
            status = "kept" if v != 0 else "left" if None in before else "repaired"
            if status == "repaired":
                v = sum(before) / 7
            if d and v is not None:
                known[d] = v
            want.append((k, d, None if v is None else round(v, 9), x, status))
    df = X.repair_zeros(spark.createDataFrame([(k, d, None if v is None else float(v), x) for k, d, v, x in rows], "series string, date date, value double, _p string"))
    assert "Python" not in df._jdf.queryExecution().toString()
    got = [(x.series, x.date, None if x.value is None else round(x.value, 9), x._p, x.zero_status) for x in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(x[4] == "repaired" for x in got) > 10


def test_start_at_without_hit_keeps_all(spark, series):
    df = series(a=[1, 150, 3], b=[1, 2, 3])
    assert column(A.start_at(df), "series", "value", order=("series", "date")) == [("a", 150), ("a", 3), ("b", 1), ("b", 2), ("b", 3)]
    assert column(A.start_at(series(c=[0, 0, 4, 0]), ge=None), "value") == [4, 0]


def test_zero_observation_in_mape(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0)], "k string, observed double, forecast double")
    row = A.score(df, ["k"]).first()
    assert row.mape == pytest.approx((1 / 2.220446049250313e-16 + 0.5) / 2)
    assert (row.mae, row.rmse, row.r2) == (1, 1, 0)


def test_best_takes_first_on_tie_and_skips_nan(spark):
    df = spark.createDataFrame([("a", 0, float("nan")), ("a", 1, 2.0), ("a", 2, 2.0), ("b", 0, None), ("b", 1, 5.0)], "k string, grid_id int, m double")
    assert sorted((r.k, r.grid_id) for r in A.best(df, ["k"], "m").collect()) == [("a", 1), ("b", 1)]


def test_split_and_minmax(spark, series):
    df = series(a=range(10))
    assert column(X.split(df, share=0.7), "part").count("train") == 7
    flat = A.minmax(series(c=[5, 5, 5]))
    assert column(flat, "scaled") == [0, 0, 0]
