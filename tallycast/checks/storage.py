"""Everything that is written and read back. Each run writes to a new folder
under the shared scratch path."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import sinks as K
from ..operators.shape import with_country
from ..plans.covid import case_series, covid_daily, forecast_gold, jhons_gold
from ..plans.energy import energy_load
from ..session import scratch_path
from ..sources import reports as R
from ..streaming import ingest_new_days
from . import forecasts, joined, texts  # noqa: F401  their queries feed the fact tables
from .cases import _IDS, daily_change
from .registry import G, ORACLES, QUERIES, query, status_reports, table


@query("csv_round_trip", """
SELECT o_orderpriority AS Country_Region, CAST(o_orderkey AS DOUBLE) AS Confirmed, o_totalprice AS Deaths, NULL::DOUBLE AS Recovered,
  CAST(o_orderdate AS DATE) AS date FROM orders""")
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Country_Region"), F.col("o_orderkey").alias("Confirmed"), F.col("o_totalprice").alias("Deaths"),
        F.lit(None).cast("string").alias("Recovered"), F.date_format("o_orderdate", "MM-dd-yyyy").alias("date"),
    ).write.option("header", True).csv(path)
    rows = R.select_measures(R.read_reports(spark, path, R.REPORT_SCHEMA))
    return rows.withColumn("date", F.try_to_date("date", "MM-dd-yyyy"))


@query("csv_folders", """
SELECT o_orderkey, o_orderpriority AS Country_Region, strftime(date_trunc('month', o_orderdate), '%m-%d-%Y') AS date FROM orders""")
def csv_folders(spark, sf):
    """Collected folders by month; the date comes from the folder name."""
    path = scratch_path(spark, "folders")
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("Country_Region"), F.trunc("o_orderdate", "month").alias("extract_date")
    )
    K.export_csv(o, path, "extract_date")
    return R.with_extract_date(
        R.read_reports(spark, path, "o_orderkey bigint, Country_Region string"), F.regexp_extract("_metadata.file_path", r"extract_date=(\d{4}-\d{2}-\d{2})", 1)
    ).select("o_orderkey", "Country_Region", "date")


@query("drifting_headers", """
SELECT o_orderpriority AS "Country_Region", CAST(o_orderkey AS DOUBLE) AS "Confirmed",
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_totalprice END AS "Deaths", NULL::DOUBLE AS "Recovered",
  strftime(o_orderdate, '%m-%d-%Y') AS date FROM orders""")
def drifting_headers(spark, sf):
    """Three header layouts in one folder, read as one table; in one of them the named columns stand behind 110 others."""
    path = scratch_path(spark, "drift")
    o = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    day, n = F.date_format("o_orderdate", "MM-dd-yyyy").alias("date"), F.col("o_orderkey").alias("Confirmed")
    old = o.filter(early).select(day, n, F.col("o_orderpriority").alias("Country/Region"))
    late = F.col("o_orderdate") >= F.lit("1998-05-01").cast("timestamp_ntz")
    wide = o.filter(~early & late).select(*[F.lit(i).alias(f"c{i}") for i in range(110)], n, F.col("o_totalprice").alias("Deaths"), day, F.col("o_orderpriority").alias("Country/Region"))
    new = o.filter(~early & ~late).select(F.lit(7).alias("FIPS"), F.col("o_orderpriority").alias("Country_Region"), n, F.col("o_totalprice").alias("Deaths"), day)
    for part in (old, new, wide):
        part.write.mode("append").option("header", True).csv(path)
    return R.select_measures(R.read_drifting_reports(spark, path))


@query("parquet_round_trip", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS country FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')""")
def parquet_round_trip(spark, sf):
    """All countries written, two read: the filter prunes folders."""
    path = scratch_path(spark, "series")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("country"))
    K.overwrite_parquet(o, path, ["country"])
    return R.read_series(spark, path, ["1-URGENT", "3-MEDIUM"])


@query("snapshots", """
SELECT c_name AS "Country", '2022-01-01' AS "Date", CAST(c_custkey AS VARCHAR) AS "Population" FROM customer
UNION ALL SELECT s_name, '2022-01-02', CAST(s_suppkey AS VARCHAR) FROM supplier""")
def snapshots(spark, sf):
    """Two stamped collections, read together by one pattern."""
    path = scratch_path(spark, "snapshots")
    parts = [("customer", "c_name", "c_custkey", "2022-01-01"), ("supplier", "s_name", "s_suppkey", "2022-01-02")]
    for name, label, number, day in parts:
        rows = table(spark, sf, name).select(F.col(label).alias("Country"), F.col(number).cast("string").alias("Population"))
        R.stamp(rows, "Date", day).select("Country", "Date", "Population").write.option("header", True).csv(f"{path}/data_{day}")
    return R.read_snapshots(spark, f"{path}/data_*", "Country string, Date string, Population string")


@query("csv_fact", """
SELECT CAST(o_orderdate AS DATE) AS data, o_orderpriority AS pais, o_totalprice AS demanda FROM orders""")
def csv_fact(spark, sf):
    src, dest = scratch_path(spark, "csv"), scratch_path(spark, "fact")
    table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("data"), F.col("o_orderpriority").alias("pais"), F.col("o_totalprice").alias("demanda")
    ).write.option("header", True).csv(src)
    return R.load_csv_fact(spark, src, dest, "data date, pais string, demanda double")


@query("json_days", """
SELECT event_id, event_type, value, CAST(ts AS DATE) AS process_date FROM events""")
def json_days(spark, sf):
    """Events by day as JSON, written twice: the second run replaces the first."""
    path = scratch_path(spark, "json")
    e = table(spark, sf, "events")
    rows = e.select("event_id", "event_type", "value", F.col("ts").cast("date").alias("day"))
    for _ in range(2):
        K.write_day_json(rows, path, F.col("day"))
    return spark.read.schema("event_id bigint, event_type string, value double, process_date date").json(path)


@query("export_csv", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, left(o_orderpriority, 1)::INT AS country FROM orders""")
def export_csv(spark, sf):
    path = scratch_path(spark, "export")
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.substring("o_orderpriority", 1, 1).cast("int").alias("country")
    )
    K.export_csv(o, path)
    return spark.read.option("header", True).schema("o_orderkey bigint, date string, country int").csv(path)


@query("quoted_csv", """
SELECT '"' || replace(n_name, '_', '"",') || '",' || n_regionkey || ',"' || o_orderpriority || '",' || o_totalprice || ',' ||
  CASE WHEN o_orderstatus = 'P' THEN '""' ELSE '"' || o_orderstatus || '"' END || ',' || o_orderkey AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def quoted_csv(spark, sf):
    """Lines as they stand in the files, without the header of each file."""
    path = scratch_path(spark, "quoted")
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    o = o.join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    K.export_csv_quoted(o.select(
        F.replace("n_name", F.lit("_"), F.lit('",')).alias("name"), F.col("n_regionkey").alias("region"), "o_orderpriority", "o_totalprice",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), "o_orderkey",
    ), path)
    return spark.read.text(path).filter(~F.col("value").startswith('"name",'))


@query("json_to_csv", """
SELECT doc_id, source, CAST(n_chars AS DOUBLE) AS compound FROM documents WHERE lang <> 'de'""")
def json_to_csv(spark, sf):
    src, dest = scratch_path(spark, "json"), scratch_path(spark, "csv")
    table(spark, sf, "documents").select(
        "doc_id", "source", F.when(F.col("lang") != "de", F.col("n_chars").cast("double")).alias("compound")
    ).write.json(src)
    schema = "doc_id bigint, source string, compound double"
    K.json_to_csv(spark, src, dest, schema, ["doc_id", "source", "compound"])
    return spark.read.option("header", True).schema(schema).csv(dest)


def _two_loads(spark, sf):
    """Orders before 1999 and from 1997 on; the later load has revised prices
    for the years that are in both."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice", "o_orderstatus")
    old = o.filter(F.col("date") < F.lit("1999-01-01").cast("date"))
    new = o.filter(F.col("date") >= F.lit("1997-01-01").cast("date"))
    changed = (F.col("date") < F.lit("1998-01-01").cast("date")) & (F.col("o_orderstatus") == "F")
    return old, new.withColumn("o_totalprice", F.when(changed, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")))


_LOADS = """o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice, o_orderstatus FROM orders),
a AS (SELECT * FROM o WHERE date < DATE '1999-01-01'),
b AS (SELECT o_orderkey, date, CASE WHEN date < DATE '1998-01-01' AND o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
  FROM o WHERE date >= DATE '1997-01-01')"""


@query("merge_history", f"WITH {_LOADS} SELECT * FROM a UNION SELECT * FROM b")
def merge_history(spark, sf):
    old, new = _two_loads(spark, sf)
    return K.merge_history(new, old)


@query("upsert", f"""
WITH {_LOADS} SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def upsert(spark, sf):
    old, new = _two_loads(spark, sf)
    return K.upsert(new, old, ["o_orderkey", "date"])


_GOLD = """SELECT md5(left(Country_Region, 1) || '|' || CAST(date AS VARCHAR)) AS ID, left(Country_Region, 1)::INT AS PAISES_ID, date AS CALENDARIO_data,
  Confirmed::INT AS confirmados, Deaths::INT AS mortes, Recovered::INT AS recuperados, New_Confirmed::INT AS novos_casos,
  New_Deaths::INT AS novas_mortes, Active::INT AS ativos FROM ({0})"""


def _gold(spark, sf):
    return jhons_gold(daily_change(spark, sf), _IDS)


@query("load_full", _GOLD.format(ORACLES["daily_change"]))
def load_full(spark, sf):
    """Fact table loaded twice in full: the second load replaces the first."""
    path = scratch_path(spark, "fact")
    for _ in range(2):
        K.load_gold(_gold(spark, sf), "COVID_JHONS_HOPKINS", path)
    return K.read_fact(spark, path)


@query("load_date", _GOLD.format(ORACLES["daily_change"]))
def load_date(spark, sf):
    """Full load, then one day again: nothing is doubled."""
    path = scratch_path(spark, "fact")
    K.load_gold(_gold(spark, sf), "COVID_JHONS_HOPKINS", path)
    K.load_gold(_gold(spark, sf), "COVID_JHONS_HOPKINS", path, F.lit("1997-05-28").cast("date"))
    return K.read_fact(spark, path)


@query("energy_load", """
SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS "PAISES_ID", CAST(date_trunc('month', l_shipdate) AS DATE) AS "CALENDARIO_data",
  round(sum(l_extendedprice), 2) AS "demanda_TWh"
FROM lineitem WHERE l_linestatus = 'O' AND date_trunc('month', l_shipdate) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY 1, 2""")
def energy(spark, sf):
    """Monthly rows in text form to the demand fact."""
    li = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("Area"), F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("Date"),
        F.col("l_linestatus").alias("Category"), F.col("l_extendedprice").alias("Value"),
    )
    rows = energy_load(li, "O", {"A": 1, "N": 2, "R": 3}, "1996-01-01", "2000-12-31", {"A": "Accepted"})
    path = scratch_path(spark, "fact")
    K.load_fact(K.to_fact(rows, "DEMANDA_ENERGIA"), path)
    return K.read_fact(spark, path).withColumn("demanda_TWh", F.round("demanda_TWh", 2))


@query("ingest", f"""
WITH {G} SELECT Country_Region, date, date_trunc('month', date)::DATE AS extract_date, Confirmed, Deaths, Recovered FROM g""")
def ingest(spark, sf):
    """Month folders that arrive in two runs; the stream reads each once."""
    src, dest, state = (scratch_path(spark, n) for n in ("arrivals", "history", "state"))
    rows = status_reports(spark, sf)
    text = rows.select(
        "Country_Region", *[F.col(c).cast("string").alias(c) for c in ("Confirmed", "Deaths", "Recovered")],
        F.date_format("date", "MM-dd-yyyy").alias("date"), F.trunc("date", "month").alias("extract_date"),
    )
    early = F.col("extract_date") < F.lit("1998-01-01").cast("date")
    for part in (text.filter(early), text.filter(~early)):
        part.hint("rebalance", F.col("extract_date")).write.mode("append").option("header", True).partitionBy("extract_date").csv(src)
        ingest_new_days(spark, src, dest, state)
    return spark.read.parquet(dest).drop("part")


@query("stamped", "SELECT o_orderkey, 'AR' AS country, '2022-05-01' AS Date FROM orders")
def stamped(spark, sf):
    return R.stamp(with_country(table(spark, sf, "orders").select("o_orderkey"), "AR"), "Date", "2022-05-01")


@query("covid_daily_folders", ORACLES["covid_daily"])
def covid_daily_folders(spark, sf):
    """Day folders of report files from 1996 on, with an earlier history that also holds wrong values for later days."""
    path = scratch_path(spark, "reports")
    rows = status_reports(spark, sf)
    late = F.col("date") >= F.lit("1996-01-01").cast("date")
    text = rows.filter(late).select(
        F.lit(None).cast("string").alias("FIPS"), "Country_Region", *[F.col(c).cast("string").alias(c) for c in ("Confirmed", "Deaths", "Recovered")],
        F.date_format("date", "MM-dd-yyyy").alias("date"), F.trunc("date", "month").alias("extract_date"),
    )
    K.export_csv(text, path, "extract_date")
    wanted = {p: i for p, i in _IDS.items() if p != "5-LOW"}
    known = case_series(rows, list(wanted))
    history = known.select("Country_Region", "date", *[F.when(late, -1.0).otherwise(F.col(c)).alias(c) for c in ("Confirmed", "Deaths", "Recovered")])
    return covid_daily(spark, path, wanted, history)


@query("load_forecast", f"""
SELECT md5(left(Country_Region, 1) || '|' || CAST(forecast_date AS VARCHAR) || '|' || CAST(forecasted_date AS VARCHAR)) AS ID,
  left(Country_Region, 1)::INT AS PAISES_ID, forecast_date AS CALENDARIO_data, forecasted_date AS data_prevista, forecast AS casos_previstos
FROM ({ORACLES["covid_forecast"]})""")
def load_forecast(spark, sf):
    """The forecast fact in full, then the day of each forecast again."""
    path = scratch_path(spark, "fact")
    gold = forecast_gold(QUERIES["covid_forecast"](spark, sf), _IDS)
    K.load_gold(gold, "PREVISAO_CASOS", path)
    for day in K.read_fact(spark, path).select("CALENDARIO_data").distinct().collect():
        K.load_gold(gold, "PREVISAO_CASOS", path, F.lit(day[0]))
    return K.read_fact(spark, path)


@query("load_sentiments", f"""
SELECT md5(country || '|' || CAST(date AS VARCHAR) || '|' || texto) AS ID, country AS PAISES_ID, date AS CALENDARIO_data, texto AS tweet,
  neg AS negativo, pos AS positivo, neu AS neutro, compound AS composto FROM ({ORACLES["tweet_gold"]})""")
def load_sentiments(spark, sf):
    path = scratch_path(spark, "fact")
    K.load_gold(QUERIES["tweet_gold"](spark, sf), "SENTIMENTOS", path)
    return K.read_fact(spark, path)


_WORLD = C.FACTS["COVID_WORLDOMETER"][2:]


@query("load_snapshot", f"""
SELECT md5("Country" || '|' || CAST("Date" AS VARCHAR)) AS "ID", CAST("Country" AS INT) AS "PAISES_ID", "Date" AS "CALENDARIO_data",
  {", ".join(f'TRY_CAST("{src}" AS {kind.upper()}) AS "{name}"' for name, src, kind in _WORLD)} FROM ({ORACLES["snapshot_daily"]})""")
def load_snapshot(spark, sf):
    path = scratch_path(spark, "fact")
    K.load_gold(QUERIES["snapshot_daily"](spark, sf), "COVID_WORLDOMETER", path)
    return K.read_fact(spark, path)
