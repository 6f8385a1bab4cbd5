"""Report rows to case series: shaping, filters, gaps, change."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import days_between, month_end, parse_date, reformat_date, target_date
from ..functions.text import join_parts, to_double
from ..operators import aggregates as A
from ..operators import shape as P
from ..operators.windows import with_daily_change
from ..plans.covid import covid_daily
from ..sources.reports import normalise_header, select_measures, stamp, with_extract_date
from .registry import G, S, query, series_of, status_reports, stored_series, table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_IDS = {p: i + 1 for i, p in enumerate(PRIORITIES)}


@query("daily_change", f"""
WITH {G}, c AS (SELECT *,
  coalesce(Confirmed - lag(Confirmed) OVER w, 0) AS New_Confirmed,
  coalesce(Deaths - lag(Deaths) OVER w, 0) AS New_Deaths,
  coalesce(Recovered - lag(Recovered) OVER w, 0) AS New_Recovered
  FROM g WINDOW w AS (PARTITION BY Country_Region ORDER BY date))
SELECT Country_Region, date, coalesce(Confirmed, 0) AS Confirmed, coalesce(Deaths, 0) AS Deaths,
  coalesce(Recovered, 0) AS Recovered, New_Confirmed, New_Deaths, New_Recovered,
  coalesce(Confirmed, 0) - coalesce(Deaths, 0) - coalesce(Recovered, 0) AS Active
FROM c""")
def daily_change(spark, sf):
    return P.with_active(with_daily_change(A.group_reports(status_reports(spark, sf))))


@query("null_change", f"""
WITH {G} SELECT Country_Region, date,
  Confirmed - lag(Confirmed) OVER w AS New_Confirmed, Deaths - lag(Deaths) OVER w AS New_Deaths,
  Recovered - lag(Recovered) OVER w AS New_Recovered
FROM g WINDOW w AS (PARTITION BY Country_Region ORDER BY date)""")
def null_change(spark, sf):
    df = with_daily_change(A.group_reports(status_reports(spark, sf)), fill=None)
    return df.select("Country_Region", "date", "New_Confirmed", "New_Deaths", "New_Recovered")


@query("group_reports", f"WITH {G} SELECT * FROM g")
def group_reports(spark, sf):
    return A.group_reports(status_reports(spark, sf))


@query("covid_daily", f"""
WITH {G}, k AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED']) AS Country_Region),
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
f AS (SELECT k.Country_Region, d.date,
  CASE WHEN g.date IS NULL THEN 0 ELSE Confirmed END AS Confirmed,
  CASE WHEN g.date IS NULL THEN 0 ELSE Deaths END AS Deaths,
  CASE WHEN g.date IS NULL THEN 0 ELSE Recovered END AS Recovered
  FROM k CROSS JOIN d LEFT JOIN g ON g.Country_Region = k.Country_Region AND g.date = d.date)
SELECT Country_Region, date, coalesce(Confirmed, 0) AS Confirmed, coalesce(Deaths, 0) AS Deaths,
  coalesce(Recovered, 0) AS Recovered,
  coalesce(Confirmed, 0) - coalesce(Deaths, 0) - coalesce(Recovered, 0) AS Active,
  coalesce(Confirmed - lag(Confirmed) OVER w, 0) AS New_Confirmed,
  coalesce(Deaths - lag(Deaths) OVER w, 0) AS New_Deaths,
  coalesce(Recovered - lag(Recovered) OVER w, 0) AS New_Recovered
FROM f WINDOW w AS (PARTITION BY Country_Region ORDER BY date)""")
def covid_daily_query(spark, sf):
    """The whole case job on text reports; one country is not asked for, and
    days without a wanted country get a zero row."""
    text = status_reports(spark, sf).select(
        F.col("Country_Region").alias("Country/Region"), F.date_format("date", "MM-dd-yyyy").alias("date"),
        *[F.col(c).cast("string").alias(c) for c in ("Confirmed", "Deaths", "Recovered")],
    )
    return covid_daily(spark, text, {p: i for p, i in _IDS.items() if p != "5-LOW"})


@query("header_drift", """
SELECT o_orderpriority AS Country_Region, strftime(CAST(o_orderdate AS DATE), '%m-%d-%Y') AS date,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS Confirmed,
  CAST(o_custkey AS DOUBLE) AS Deaths, NULL::DOUBLE AS Recovered, o_orderkey
FROM orders""")
def header_drift(spark, sf):
    """Old and new header in one load; text that is no number becomes null."""
    o = table(spark, sf, "orders")
    cols = [
        F.date_format("o_orderdate", "MM-dd-yyyy").alias("date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("abc")).otherwise(F.col("o_totalprice").cast("string")).alias("Confirmed"),
        F.col("o_custkey").cast("string").alias("Deaths"), F.lit("").alias("Recovered"), "o_orderkey",
    ]
    day = F.col("o_orderdate").cast("date")
    new = o.filter(day >= "1998-01-01").select(F.col("o_orderpriority").alias("Country_Region"), *cols)
    old = o.filter(day < "1998-01-01").select(F.col("o_orderpriority").alias("Country/Region"), *cols)
    both = normalise_header(new.unionByName(old, allowMissingColumns=True))
    return select_measures(both, extra=("o_orderkey",))


@query("clean_numeric", """
SELECT o_orderkey, round(o_totalprice, 0) AS price, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust
FROM orders""")
def clean_numeric(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("+ "), F.format_number(F.round("o_totalprice", 0), 0)).alias("price"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(F.format_number("o_custkey", 0)).alias("cust"),
    )
    return P.clean_numeric(o, ["price", "cust"])


@query("blank_to_null", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus AS status FROM orders""")
def blank_to_null(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(F.concat(F.col("o_orderpriority"), F.lit(" "))).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    return P.blank_to_null(o)


@query("missing_days", f"""
WITH {S}, k AS (SELECT series, min(date) AS lo, max(date) AS hi FROM s GROUP BY 1),
d AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM k)
SELECT d.series, d.date, coalesce(s.value, 0) AS value FROM d LEFT JOIN s ON s.series = d.series AND s.date = d.date""")
def missing_days(spark, sf):
    """Every day between the first and the last of each series."""
    s = stored_series(spark, sf)
    spans = s.groupBy("series").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return P.fill_missing_days(s, ["series"], F.col("lo"), F.col("hi"), measures=["value"], key_table=spans)


@query("date_spine", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
o AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT d.date, coalesce(o.n, 0) AS orders, last_day(d.date) AS month_end FROM d LEFT JOIN o ON o.date = d.date""")
def date_spine_query(spark, sf):
    """Run days between the first and the last order, with the orders of each."""
    o = table(spark, sf, "orders")
    counts = A.row_counts(o.select(F.col("o_orderdate").cast("date").alias("date")), "date")
    spine = counts.groupBy().agg(F.min("date").alias("lo"), F.max("date").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("date")
    )
    return spine.join(counts, "date", "left").select(
        "date", F.coalesce("n", F.lit(0)).alias("orders"), month_end("date").alias("month_end")
    )


@query("country_filter", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'F'
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def country_filter(spark, sf):
    o = P.only(P.only_in(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]), "F", "o_orderstatus")
    building = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return P.only_in(o, "o_custkey", building).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("date_ranges", """
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
  CASE WHEN CAST(ts AS DATE) > DATE '2024-01-03' AND CAST(ts AS DATE) < DATE '2024-01-20' THEN 1 ELSE 0 END AS inside_open,
  CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' THEN 1 ELSE 0 END AS inside_closed,
  CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 1 ELSE 0 END AS on_day,
  CASE WHEN strftime(ts, '%Y-%m-%dT%H:%M:%S') < '2024-01-10' THEN 1 ELSE 0 END AS before,
  CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN 1 ELSE 0 END AS up_to
FROM events""")
def date_ranges(spark, sf):
    """Every range filter over the whole table; the parts are counted back on
    their rows, so the result shows what each filter kept."""
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
    )
    low, high = F.lit("2024-01-03").cast("date"), F.lit("2024-01-20").cast("date")
    parts = {
        "inside_open": P.between_open(e, "day", low, high),
        "inside_closed": P.between_closed(e, "day", low, high),
        "on_day": P.on_day(e, "2024-01-05", "iso"),
        "before": P.before(e, "2024-01-10", "iso"),
        "up_to": P.up_to(e, F.lit("2024-01-10").cast("date"), "day"),
    }
    marked = [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    rows = P.union_all(e.withColumn("part", F.lit("all")), *marked)
    return rows.groupBy("event_id", "user_id", "event_type", "day").agg(
        *[F.max(F.when(F.col("part") == n, 1).otherwise(0)).alias(n) for n in parts]
    )


@query("for_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS forecast_date FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28'""")
def for_date(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("forecast_date"))
    return P.for_date(o, F.lit("1997-05-28").cast("date"))


@query("map_values", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
  WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END AS priority,
  CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status, 'orders' AS source
FROM orders""")
def map_values(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    o = P.map_values(P.map_values(o, "priority", _IDS, "int"), "status", {"F": "Filled", "O": "Open"})
    return P.with_country(o, "orders", "source")


@query("mortality", """
SELECT n.n_name AS country, CAST(count(c_custkey) AS DOUBLE) AS Population,
  CAST(count(*) FILTER (c_acctbal < 0) AS DOUBLE) AS TotalDeaths,
  round(CASE WHEN count(c_custkey) = 0 THEN NULL ELSE count(*) FILTER (c_acctbal < 0) / count(c_custkey) END, 6) AS Mortality
FROM nation n LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def mortality(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count("c_custkey").cast("double").alias("Population"), F.count_if(F.col("c_acctbal") < 0).cast("double").alias("TotalDeaths")
    )
    n = table(spark, sf, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    n = P.fill_zero(n.select(F.col("n_name").alias("country"), "Population", "TotalDeaths"), ["Population", "TotalDeaths"])
    return P.with_mortality(n).withColumn("Mortality", F.round("Mortality", 6))


@query("columns", """
SELECT o_orderkey AS id, o_orderpriority AS country, CAST(o_orderdate AS DATE) AS date, 'report' AS table_name FROM orders""")
def columns(spark, sf):
    o = table(spark, sf, "orders").drop("o_custkey", "o_totalprice", "o_orderstatus")
    o = o.withColumnRenamed("o_orderkey", "id").withColumnRenamed("o_orderpriority", "country")
    return stamp(o.withColumn("date", F.col("o_orderdate").cast("date")), "table_name", "report").select(
        "id", "country", "date", "table_name"
    )


@query("drop_nulls", f"WITH {G} SELECT * FROM g WHERE Confirmed IS NOT NULL AND Deaths IS NOT NULL AND Recovered IS NOT NULL")
def drop_nulls(spark, sf):
    return P.drop_nulls(A.group_reports(status_reports(spark, sf)))


@query("distinct_keys", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_keys(spark, sf):
    return A.distinct_keys(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query("row_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def row_counts(spark, sf):
    return A.row_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem")
def drop_duplicates(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", F.col("l_shipdate").cast("date").alias("day")
    ).dropDuplicates()


@query("last_dates", f"WITH {S} SELECT series, max(date) AS origin FROM s GROUP BY 1")
def last_dates(spark, sf):
    return A.last_dates(series_of(spark, sf))


@query("union_all", """
SELECT o_orderkey AS id, o_orderpriority AS kind, 'order' AS source FROM orders
UNION ALL SELECT event_id, event_type, 'event' FROM events""")
def union_all(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"))
    e = table(spark, sf, "events").select(F.col("event_type").alias("kind"), F.col("event_id").alias("id"))
    return P.union_all(P.with_country(o, "order", "source"), P.with_country(e, "event", "source"))


@query("sorted_export", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS forecast_date, CAST(o_orderdate AS DATE) + 7 AS forecasted_date FROM orders""")
def sorted_export(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("forecast_date"))
    return P.sort_rows(o.withColumn("forecasted_date", target_date("forecast_date", 7)), "forecast_date", "forecasted_date")


@query("dates", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%m-%d-%Y') AS text,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed,
  strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d') AS other, CAST(o_orderdate AS DATE) + 3 AS target,
  date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))::INT AS days, last_day(CAST(o_orderdate AS DATE)) AS month_end
FROM orders""")
def dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "MM-dd-yyyy").alias("text"))
    day = parse_date("text")
    bad = F.when(F.col("o_orderstatus") == "P", F.lit("13-45-2000")).otherwise(F.col("text"))
    return o.select(
        "o_orderkey", "text", parse_date(bad).alias("parsed"),
        reformat_date("text", "MM-dd-yyyy", "yyyy/MM/dd").alias("other"), target_date(day, 3).alias("target"),
        days_between(F.lit("1995-01-01").cast("date"), day).alias("days"), month_end(day).alias("month_end"),
    )


@query("parts", """
SELECT doc_id, array_to_string(string_split(source, '-'), ' ') AS joined, CAST(n_chars AS DOUBLE) AS n_chars,
  NULL::DOUBLE AS bad FROM documents""")
def parts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", join_parts(F.split("source", "-")).alias("joined"), to_double(F.col("n_chars").cast("string")).alias("n_chars"),
        to_double(F.col("lang")).alias("bad"),
    )


@query("monthly_demand", """
SELECT CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' ELSE l_returnflag END AS Area,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS Date, round(sum(l_extendedprice), 2) AS Value
FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'N', 'R')
  AND date_trunc('month', l_shipdate) BETWEEN DATE '1996-01-01' AND DATE '2000-12-01' GROUP BY 1, 2""")
def monthly_demand(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("Area"), F.trunc("l_shipdate", "month").alias("Date"),
        F.col("l_linestatus").alias("Category"), F.col("l_extendedprice").alias("Value"),
    )
    d = A.monthly_demand(li, "F", ["A", "N", "R"], F.lit("1996-01-01").cast("date"), F.lit("2000-12-01").cast("date"))
    return P.map_values(d, "Area", {"A": "Accepted", "R": "Returned"}).withColumn("Value", F.round("Value", 2))


@query("fill_rows", f"""
WITH {G} SELECT Country_Region, date, strftime(date, '%m-%d-%Y') AS day_text, coalesce(Confirmed, 0) AS Confirmed FROM g""")
def fill_rows(spark, sf):
    """Date of the folder as text, nulls to zero."""
    g = A.group_reports(status_reports(spark, sf))
    g = with_extract_date(g, F.col("date").cast("string"), "day_text")
    return P.fill_zero(g.select("Country_Region", "date", "day_text", "Confirmed"), ["Confirmed"])


