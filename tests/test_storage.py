from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallycast.operators import sinks as K
from tallycast.operators.joins import flag_intervals, lookup
from tallycast.session import drop_scratch, scratch_path, task_count
from tallycast.sources.reports import read_drifting_reports
from tallycast.sources.dims import dim_calendar, dim_countries, dim_happiness, dim_lockdowns
from tallycast.streaming import ingest_new_days, merge_days

DAYS = [date(2020, 3, d) for d in range(1, 6)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "Country_Region string, date date, Confirmed double")


def test_dimensions(spark):
    assert dim_calendar(spark).count() == 2191
    assert (dim_countries(spark).count(), dim_happiness(spark).count(), dim_lockdowns(spark).count()) == (5, 20, 4)
    assert dim_lockdowns(spark).filter(F.datediff("data_fim", "data_inicio") != F.col("total_dias")).count() == 0


def test_history_forms(spark):
    old = frame(spark, [("A", DAYS[0], 1.0), ("A", DAYS[1], 2.0)])
    same = K.merge_history(old, old)
    assert same.count() == 2
    revised = frame(spark, [("A", DAYS[1], 3.0)])
    assert K.merge_history(revised, old).count() == 3
    rows = sorted(map(tuple, K.upsert(revised, old, ["Country_Region", "date"]).collect()))
    assert rows == [("A", DAYS[0], 1.0), ("A", DAYS[1], 3.0)]
    late = K.upsert(revised, old, ["Country_Region", "date"], ["Confirmed"])
    assert sorted(map(tuple, late.collect())) == rows


def test_quoted_lines(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", you', 1, 2.5), (None, None, None)], "a string, b int, c double")
    K.export_csv_quoted(df.coalesce(1), str(tmp_path / "q"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "q")).collect()]
    assert lines == ['"a","b","c"', '"say ""hi"", you",1,2.5', '"","",""']


def test_surrogate_ids_tell_keys_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|", "b", ""), ("a", "|b", "")], "x string, y string, z string")
    assert K.with_id(df, ["x", "y", "z"]).select("ID").distinct().count() == 4


def test_fact_loads(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(1, d, f, 1.0 * i) for i, (d, f) in enumerate([(DAYS[0], DAYS[1]), (DAYS[0], DAYS[2]), (DAYS[1], DAYS[2])])]
    df = spark.createDataFrame(rows, "country int, forecast_date date, forecasted_date date, forecast double")
    first = F.lit("2020-03-01").cast("date")
    K.load_gold(df, "PREVISAO_CASOS", path, first)
    assert K.read_fact(spark, path).count() == 2
    K.load_gold(df, "PREVISAO_CASOS", path, F.lit("2020-03-02").cast("date"))
    K.load_gold(df.withColumn("forecast", F.lit(9.0)), "PREVISAO_CASOS", path, first)
    found = K.read_fact(spark, path)
    assert sorted(r.casos_previstos for r in found.collect()) == [2.0, 9.0, 9.0]
    assert found.select("ID").distinct().count() == 3
    K.load_gold(df, "PREVISAO_CASOS", path)
    assert K.read_fact(spark, path).count() == 3


def test_fact_columns_by_name(spark):
    df = spark.createDataFrame([("t", 0.1, 0.2, 0.7, 0.5, 1, DAYS[0])], "texto string, neg double, pos double, neu double, compound double, country int, date date")
    row = K.to_fact(df, "SENTIMENTOS").first()
    assert (row.negativo, row.positivo, row.neutro, row.composto) == (0.1, 0.2, 0.7, 0.5)


def test_keys(spark):
    fact = spark.createDataFrame([(1, DAYS[0]), (7, DAYS[0]), (1, date(2030, 1, 1)), (None, DAYS[0])], "PAISES_ID int, CALENDARIO_data date")
    bad = K.check_keys(fact, {"PAISES_ID": (dim_countries(spark), "ID"), "CALENDARIO_data": (dim_calendar(spark), "data")})
    assert sorted((r.PAISES_ID, r.missing) for r in bad.collect()) == [(1, "CALENDARIO_data"), (7, "PAISES_ID")]


def test_overlapping_intervals_do_not_double(spark, series):
    spans = spark.createDataFrame([("a", DAYS[0], DAYS[2], "x"), ("a", DAYS[1], DAYS[3], "y"), ("b", DAYS[0], DAYS[4], "z")], "series string, start date, end date, label string")
    out = flag_intervals(series(a=[1, 2, 3, 4, 5]), spans, label="label").orderBy("date").collect()
    assert [r.inside for r in out] == [True, True, True, True, False]
    assert out[1].labels == ["x", "y"]


def test_lookup_keeps_unmatched(spark):
    fact = spark.createDataFrame([(1,), (9,)], "id int")
    assert sorted((r.id, r.pais) for r in lookup(fact, dim_countries(spark), {"id": "ID"}, ["pais"]).collect() if r.id == 1) == [(1, "Argentina")]
    assert lookup(fact, dim_countries(spark), {"id": "ID"}, ["pais"]).count() == 2


def write_day(folder, day, rows):
    d = folder / f"extract_date={day}"
    d.mkdir(exist_ok=True)
    name = len(list(d.iterdir()))
    head = "Country_Region,Confirmed,Deaths,Recovered,date"
    if name % 2:
        head, rows = "Id,Country/Region,Confirmed,Deaths,Recovered,date", [f"7,{r}" for r in rows]
    (d / f"{name}.csv").write_text("\n".join([head, *rows]) + "\n")


def test_ingest(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    table, state = str(tmp_path / "table"), str(tmp_path / "state")

    def run():
        ingest_new_days(spark, str(src), table, state)
        return {(r.Country_Region, str(r.date)): r.Confirmed for r in spark.read.parquet(table).collect()}

    write_day(src, "2020-03-01", ["A,1,0,0,03-01-2020", "A,2,0,0,03-01-2020", "B,5,0,0,03-01-2020"])
    assert run() == {("A", "2020-03-01"): 3, ("B", "2020-03-01"): 5}
    assert run() == {("A", "2020-03-01"): 3, ("B", "2020-03-01"): 5}
    # A second file of the same folder adds to its day; a later folder revises a day.
    write_day(src, "2020-03-01", ["A,4,0,0,03-01-2020"])
    write_day(src, "2020-04-02", ["A,9,0,0,04-02-2020", "B,6,0,0,03-01-2020"])
    want = {("A", "2020-03-01"): 7, ("B", "2020-03-01"): 6, ("A", "2020-04-02"): 9}
    assert run() == want
    assert run() == want


def test_merge_is_the_same_twice(spark, tmp_path):
    new = frame(spark, [("A", DAYS[0], 1.0), ("B", DAYS[1], 2.0)]).withColumn("extract_date", F.col("date"))
    for _ in range(2):
        merge_days(new, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_scratch_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    path = scratch_path(spark, "x")
    assert path.startswith(f"{base}/x-") and path != scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_scratch(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert task_count(spark) >= 8


def test_merge_keeps_rows_without_a_date(spark, tmp_path):
    for name in "AB":
        merge_days(frame(spark, [(name, None, 1.0), (name, DAYS[0], 2.0)]).withColumn("extract_date", F.col("date")), str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t")).select("Country_Region", "date").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(n, d) for n in "AB" for d in (None, DAYS[0])], key=repr)


def test_stray_file_fails_the_batch(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "stray.csv").write_text("Country_Region,Confirmed,Deaths,Recovered,date\nA,1,0,0,03-01-2020\n")
    with pytest.raises(Exception, match="outside the extract_date"):
        ingest_new_days(spark, str(src), str(tmp_path / "table"), str(tmp_path / "state"))


def test_headers_of_any_width(spark, tmp_path):
    wide = ",".join([f"c{i}" for i in range(120)] + ["Country/Region", "Confirmed", "date"])
    (tmp_path / "wide.csv").write_text(f"{wide}\n" + ",".join(["7"] * 120 + ['"Korea, South"', "3", "03-01-2020"]) + "\n")
    (tmp_path / "new.csv").write_text("\n\ufeffCountry_Region,Deaths\nCountry_Region,4\nCountry_Region,Deaths\n")
    got = sorted((r.Country_Region, r.Confirmed, r.Deaths, r.date) for r in read_drifting_reports(spark, str(tmp_path)).collect())
    assert got == [("Country_Region", None, "4", None), ("Korea, South", "3", None, "03-01-2020")]
    (tmp_path / "bad.csv").write_text("Nation,Confirmed\nA,1\nCountry_Region,2\n")
    with pytest.raises(Exception, match="no country column"):
        read_drifting_reports(spark, str(tmp_path)).collect()


def test_upsert_joins_the_history(spark):
    cols = "k int, v int, o int"
    old = spark.createDataFrame([(1, 10, 5), (2, 20, 5), (3, 30, 5), (None, 40, 5)], cols)
    new = spark.createDataFrame([(1, 11, 4), (2, 21, 5), (2, 22, 4), (4, 41, None), (None, 42, 6)], cols)
    got = K.upsert(new, old, ["k"], ["o"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 10, 5), (2, 21, 5), (3, 30, 5), (4, 41, None), (None, 42, 6)], key=repr)
    wide = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("o"))
    merged = K.upsert(new, wide, ["k"], ["o"])
    assert merged.count() == 1001
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the history is joined with the batch, never sorted or grouped
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


@pytest.mark.parametrize("grain,want", [("day", DAYS[1]), ("month", DAYS[0]), ("year", date(2020, 1, 1))])
def test_grain(spark, grain, want):
    assert K.with_grain(frame(spark, [("A", DAYS[1], 1.0)]), "date", grain).first().part == want
