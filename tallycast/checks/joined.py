"""Joins, nested pages and HTML tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.dates import days_between
from ..functions.text import clean_number
from ..operators import joins as J
from ..operators.sinks import check_keys, with_id
from ..operators.windows import trailing_mean
from ..plans.snapshot import PAGE_ORDER, snapshot_daily
from ..session import scratch_path
from ..sources import html as H
from ..sources.grids import html_grids
from ..sources.dims import dim_calendar, dim_countries, dim_happiness, dim_lockdowns
from ..sources.pages import incomplete_chains, read_pages, tweets_of, users_of
from .registry import S, query, rounded, series_of, stored_series, table


def stored_pages(spark, sf, cut_short: bool = False):
    """Conversations as API pages of at most 100 turns: a turn is a tweet, a
    role in a conversation is a user. The page of the last turn has no next
    token; with ``cut_short`` the longer conversations lack that page's end."""
    c = table(spark, sf, "conversations").select(
        "conv_id", "turn", "text", F.concat_ws("-", "conv_id", "role").alias("author"), "role",
        F.format_string("2024-01-%02dT%02d:00:00.000Z", F.col("turn") % 28 + 1, F.col("conv_id") % 24).alias("created_at"),
        F.floor(F.col("turn") / 100).alias("page"),
    )
    pages = c.groupBy("conv_id", "page").agg(
        F.collect_list(F.struct(F.col("author").alias("author_id"), "created_at", "text")).alias("data"),
        F.struct(F.collect_list(F.struct(F.col("author").alias("id"), F.col("role").alias("location"))).alias("users")).alias("includes"),
        F.max("turn").alias("top"),
    )
    last = c.groupBy("conv_id").agg(F.max("turn").alias("last"))
    ended = F.col("top") == F.col("last")
    if cut_short:
        ended = ended & (F.col("last") <= 3)
    token = F.when(~ended, F.concat_ws("-", F.lit("next"), "conv_id", "page"))
    return pages.join(last, "conv_id").select("conv_id", "data", "includes", F.struct(token.alias("next_token")).alias("meta"))


_TWEETS = """t AS (SELECT DISTINCT '2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') || 'T' ||
  lpad(CAST(conv_id % 24 AS VARCHAR), 2, '0') || ':00:00.000Z' AS created_at, text, role AS location FROM conversations)"""


@query("tweet_users", f"WITH {_TWEETS} SELECT * FROM t")
def tweet_users(spark, sf):
    """Pages written as JSON lines, read back, exploded and joined again."""
    path = scratch_path(spark, "pages")
    stored_pages(spark, sf).select("data", "includes", "meta").write.json(path)
    pages = read_pages(spark, path)
    return J.join_tweet_user(tweets_of(pages), users_of(pages))


@query("page_chain", """
SELECT CAST(conv_id AS VARCHAR) AS chain, CAST(count(DISTINCT turn // 100) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS last_pages
FROM conversations GROUP BY 1 HAVING max(turn) > 3""")
def page_chain(spark, sf):
    """Collections that were cut short, found among all of them."""
    return incomplete_chains(stored_pages(spark, sf, cut_short=True), F.col("conv_id").cast("string"))


@query("dim_lookup", """
SELECT o_orderkey, o_custkey, n_name AS country, n_regionkey AS region FROM orders
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def dim_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o = J.lookup(o, table(spark, sf, "customer"), {"o_custkey": "c_custkey"}, ["c_nationkey"])
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"), F.col("n_regionkey").alias("region"))
    return J.lookup(o, n, {"c_nationkey": "n_nationkey"}, ["country", "region"]).drop("c_nationkey")


_P_ID = "CAST(left(o_orderpriority, 1) AS INT)"


@query("countries", f"""
WITH p AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in C.COUNTRIES)}) v(id, pais))
SELECT pais, count(*) AS n FROM orders JOIN p ON p.id = {_P_ID} GROUP BY 1""")
def countries(spark, sf):
    o = table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).cast("int").alias("country"))
    return J.lookup(o, dim_countries(spark), {"country": "ID"}, ["pais"], "inner").groupBy("pais").agg(F.count(F.lit(1)).alias("n"))


@query("happiness", f"""
WITH h AS (SELECT * FROM (VALUES {', '.join(str(x) for x in C.HAPPINESS)}) v(id, ano, periodo, nota, classificacao))
SELECT h.id AS country, CAST(ano AS INT) AS ano, CAST(nota AS DOUBLE) AS nota, CAST(classificacao AS INT) AS classificacao, count(o_orderkey) AS n
FROM orders JOIN h ON h.id = {_P_ID} AND h.ano = year(o_orderdate) + 21 GROUP BY 1, 2, 3, 4""")
def happiness(spark, sf):
    """Rank of the country and year of each order, years moved into the table's span."""
    o = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("country"), (F.year("o_orderdate") + 21).alias("year"), "o_orderkey"
    )
    joined = J.lookup(o, dim_happiness(spark), {"country": "PAISES_ID", "year": "ano"}, ["ano", "nota", "classificacao"], "inner")
    return joined.groupBy("country", "ano", "nota", "classificacao").agg(F.count("o_orderkey").alias("n"))


@query("lockdowns", f"""
WITH l AS (SELECT id, CAST(a AS DATE) AS a, CAST(b AS DATE) AS b, n FROM (VALUES {', '.join(str(x) for x in C.LOCKDOWNS)}) v(id, a, b, n)),
o AS (SELECT {_P_ID} AS country, CAST(o_orderdate AS DATE) + 8401 AS date, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o.country, o.date, o.n, l.id IS NOT NULL AS inside FROM o LEFT JOIN l ON l.id = o.country AND o.date BETWEEN l.a AND l.b""")
def lockdowns(spark, sf):
    """Days of each country inside its lockdown, dates moved by 8401 days."""
    o = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("country"), F.date_add(F.col("o_orderdate").cast("date"), 8401).alias("date")
    ).groupBy("country", "date").agg(F.count(F.lit(1)).alias("n"))
    spans = dim_lockdowns(spark).filter(days_between("data_inicio", "data_fim") == F.col("total_dias"))
    spans = spans.select(F.col("PAISES_ID").alias("country"), F.col("data_inicio").alias("start"), F.col("data_fim").alias("end"))
    return J.flag_intervals(o, spans, "country")


@query("key_check", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 8401 AS day, 'o_custkey' AS missing FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 8401, 'day' FROM orders
WHERE CAST(o_orderdate AS DATE) + 8401 NOT BETWEEN DATE '2018-01-01' AND DATE '2023-12-31'""")
def key_check(spark, sf):
    """Orders whose customer or day is missing in its dimension; one segment is
    left out of the customers, and the days are moved across the calendar."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_add(F.col("o_orderdate").cast("date"), 8401).alias("day"))
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return check_keys(o, {"o_custkey": (c, "c_custkey"), "day": (dim_calendar(spark), "data")})


@query("surrogate_id", """
SELECT md5(CAST(o_orderkey AS VARCHAR) || '|' || CASE WHEN o_orderstatus = 'P' THEN '\\N' ELSE o_orderstatus END || '|' ||
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS ID, o_orderkey FROM orders""")
def surrogate_id(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    return with_id(o, ["o_orderkey", "status", "day"]).select("ID", "o_orderkey")


@query("interval_flag", f"""
WITH {S}, y AS (SELECT DISTINCT series, year(date) AS y FROM s),
i AS (SELECT series, make_date(y, 1, 1) AS a, make_date(y, 3, 31) AS b, 'quarter' AS l FROM y
  UNION ALL SELECT series, make_date(y, 3, 15), make_date(y, 4, 15), 'spring' FROM y)
SELECT s.series, s.date, s.value, count(i.l) > 0 AS inside, coalesce(string_agg(i.l, ',' ORDER BY i.l), '') AS labels
FROM s LEFT JOIN i ON i.series = s.series AND s.date BETWEEN i.a AND i.b GROUP BY 1, 2, 3""")
def interval_flag(spark, sf):
    """Two overlapping intervals per year and series."""
    s = stored_series(spark, sf)
    y = s.select("series", F.year("date").alias("y")).distinct()
    span = lambda a, b, n: y.select(
        "series", F.make_date("y", *map(F.lit, a)).alias("start"), F.make_date("y", *map(F.lit, b)).alias("end"), F.lit(n).alias("label")
    )
    spans = span((1, 1), (3, 31), "quarter").unionByName(span((3, 15), (4, 15), "spring"))
    flagged = J.flag_intervals(s, spans, label="label")
    return flagged.withColumn("labels", F.coalesce(F.array_join("labels", ","), F.lit("")))


@query("aligned", f"""
WITH {S}, m AS (SELECT series, date, avg(value) OVER w AS m, count(*) OVER w AS c FROM s
  WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT s.series, s.date, s.value, round(m, 6) AS trailing_mean FROM s JOIN m ON m.series = s.series AND m.date = s.date WHERE c = 7""")
def aligned(spark, sf):
    s = stored_series(spark, sf)
    mean = trailing_mean(s).filter(F.col("trailing_mean").isNotNull()).select("series", "date", "trailing_mean")
    return rounded(J.align(s, mean), "trailing_mean")


@query("prev_days", f"""
WITH {S} SELECT series, date, value, coalesce(string_agg(CAST(CAST(value AS INT) AS VARCHAR), ',') OVER w, '') AS prev_values,
  round(avg(value) OVER w, 6) AS prev_mean, count(value) OVER w AS prev_count
FROM s WINDOW w AS (PARTITION BY series ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)""")
def prev_days(spark, sf):
    d = J.prev_days(series_of(spark, sf))
    text = F.array_join(F.transform("prev_values", lambda v: v.cast("int").cast("string")), ",")
    return rounded(d.withColumn("prev_values", text), "prev_mean")


@query("grid_rows", f"""
WITH {S}, k AS (SELECT series, count(*) AS n FROM s GROUP BY 1)
SELECT series, n, CAST(2 * a + b AS INT) AS grid_id, [0.001, 0.01, 0.1, 0.5][a + 1]::DOUBLE AS cps, [0.01, 10.0][b + 1]::DOUBLE AS sps
FROM k CROSS JOIN (SELECT unnest(range(0, 4)) AS a) CROSS JOIN (SELECT unnest(range(0, 2)) AS b)""")
def grid_rows(spark, sf):
    """Every series once per combination of two parameters."""
    k = series_of(spark, sf).groupBy("series").agg(F.count(F.lit(1)).alias("n"))
    return J.grid(k, {"cps": [0.001, 0.01, 0.1, 0.5], "sps": [0.01, 10.0]})


# ---- HTML -----------------------------------------------------------------------


@query("html_list", """
WITH i AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1) AS items FROM pages),
u AS (SELECT page_id, CAST(generate_subscripts(items, 1) - 1 AS INT) AS pos, unnest(items) AS item FROM i)
SELECT page_id, pos, replace(replace(replace(replace(replace(regexp_replace(item, '(?s)<[^>]*>', '', 'g'), '&nbsp;', ' '),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS item FROM u""")
def html_list(spark, sf):
    return H.list_items(table(spark, sf, "pages"))


def order_pages(spark, sf, open_tag: str, close_tag: str):
    """Orders as table pages of at most 25 rows, with a title row and a total
    row around them. The first table of a page is a decoy."""
    o = table(spark, sf, "orders").withColumn("page_id", F.floor(F.col("o_orderkey") / 25))
    row = F.concat(
        F.lit("<tr class='r'><th>"), F.col("o_orderkey").cast("string"), F.lit("</th>\n<td><b>"),
        F.format_number("o_custkey", 0), F.lit("</b></td><td>A &amp; "), F.col("o_orderpriority"), F.lit("</td></tr>"),
    )
    pages = o.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows"))
    body = F.array_join(F.col("rows.row"), "\n")
    return pages.select("page_id", F.concat(
        F.lit(open_tag), F.lit("<tr><td>Total</td><td></td><td>first</td></tr>"), body,
        F.lit("<tr><td>Total</td><td></td><td>last</td></tr>"), F.lit(close_tag),
    ).alias("html"))


_ROWS = """SELECT CAST(o_orderkey // 25 AS BIGINT) AS page_id,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 25 ORDER BY o_orderkey) - 1 AS INT) AS row_pos,
  CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS DOUBLE) AS customer, 'A & ' || o_orderpriority AS priority FROM orders"""


def _typed(t):
    return t.select(
        "page_id", "row_pos", H.cell("Order").alias("id"), clean_number(H.cell("Customer")).alias("customer"),
        H.cell("Priority").alias("priority"),
    )


_HEAD = "<tr><th>Order</th><th>Customer</th><th>Priority</th></tr>"


@query("html_table", _ROWS)
def html_table(spark, sf):
    """Last header, first body; the rows around the data are cut by position."""
    pages = order_pages(
        spark, sf, f"<table><thead><tr><th>x</th></tr></thead><thead>{_HEAD}</thead><tbody>", "</tbody><tbody><tr><td>z</td></tr></tbody></table>"
    )
    return _typed(H.extract_html_table(pages, head=1, tail=1))


@query("wiki_table", _ROWS)
def wiki_table(spark, sf):
    """Second table of a class; its first row is the header."""
    pages = order_pages(
        spark, sf, "<table class='wikitable'><tr><td>no</td></tr></table><table class='plain'></table>"
        f"<table class=\"wikitable sortable\">{_HEAD}", "</table>",
    )
    return _typed(H.extract_html_table(pages, css_class="wikitable", nth=1, head=1, tail=1))


@query("table_grid", """
WITH o AS (SELECT CAST(o_orderkey // 25 AS BIGINT) AS page_id, o_orderkey, o_custkey, 'A & ' || o_orderpriority AS p,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 25 ORDER BY o_orderkey) - 1 AS INT) AS i FROM orders),
r AS (SELECT page_id, i, CASE WHEN i % 2 = 0 THEN p ELSE lag(p) OVER (PARTITION BY page_id ORDER BY i) END AS p, o_orderkey, o_custkey FROM o)
SELECT page_id, 0 AS table_pos, 0 AS depth, 0 AS row_pos, TRUE AS is_header, 'Orders|Orders|Customer' AS cells FROM (SELECT DISTINCT page_id FROM r)
UNION ALL SELECT page_id, 0, 0, i + 1, FALSE, o_orderkey || '|' || p || '|' || o_custkey FROM r
UNION ALL SELECT page_id, i // 2 + 1, 1, 0, FALSE, CAST(o_custkey AS VARCHAR) FROM r WHERE i % 2 = 0""")
def table_grid(spark, sf):
    """Cells that span columns and rows, a table in every second row, cells and rows that are never closed."""
    i = F.row_number().over(Window.partitionBy("page_id").orderBy("o_orderkey")) - 1
    o = table(spark, sf, "orders").withColumn("page_id", F.floor(F.col("o_orderkey") / 25)).withColumn("i", i)
    even = F.format_string("<tr><td>%d<td rowspan='2'>A &amp; %s<td><table class=in><tr><td>%d</table>", "o_orderkey", "o_orderpriority", "o_custkey")
    odd = F.format_string("<TR><td>%d</td><td>%d", "o_orderkey", "o_custkey")
    rows = F.array_sort(F.collect_list(F.struct("i", F.when(F.col("i") % 2 == 0, even).otherwise(odd).alias("row"))))
    pages = o.groupBy("page_id").agg(rows.alias("rows")).select(
        "page_id", F.concat(F.lit("<p>x<table><tr><th colspan=2>Orders<th>Customer</tr><!-- <td> -->"), F.array_join("rows.row", "\n"), F.lit("</table>")).alias("html")
    )
    return html_grids(pages).drop("css_class").withColumn("cells", F.array_join("cells", "|"))


# Header of the country page as it is scraped.
_PAGE_HEADER = [
    "#", *PAGE_ORDER, "Continent", "1 Caseevery X ppl", "1 Deathevery X ppl", "1 Testevery X ppl",
    "New Cases/1M pop", "New Deaths/1M pop", "Active Cases/1M pop",
]


def country_pages(spark, sf):
    """One country page per month of orders: counts by status in the columns of
    the scraped table, numbers as text."""
    o = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("date"), F.substring("o_orderpriority", 1, 1).cast("int").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.sum("o_custkey").alias("p")
    )
    name = F.element_at(F.create_map(*[F.lit(x) for n, i in C.COUNTRY_IDS.items() for x in (i, n)]), F.col("id"))
    number = lambda c: F.format_number(c, 0)
    cells = {"Country": name, "TotalCases": number("n"), "NewCases": F.concat(F.lit("+"), number("n")), "TotalDeaths": number("f"),
             "NewDeaths": F.lit("N/A"), "Population": F.concat(number("p"), F.lit(" "))}
    row = F.concat(*[
        F.concat(F.lit("<td>"), cells.get(h, F.lit("")), F.lit("</td>")) for h in _PAGE_HEADER
    ])
    line = F.concat(F.lit("<tr>"), row, F.lit("</tr>"))
    blank = "<tr>" + "<td>World</td>" * len(_PAGE_HEADER) + "</tr>"
    head = "<table><thead><tr>" + "".join(f"<th>{h}</th>" for h in _PAGE_HEADER) + "</tr></thead><tbody>"
    return o.groupBy("date").agg(F.collect_list(line).alias("rows")).select(
        F.date_format("date", "yyyyMM").alias("page_id"), "date",
        F.concat(F.lit(head + blank * 8), F.array_join("rows", ""), F.lit(blank * 6 + "</tbody></table>")).alias("html"),
    )


@query("snapshot_daily", f"""
SELECT {_P_ID} AS "Country", CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date", CAST(sum(o_custkey) AS DOUBLE) AS "Population",
  CAST(count(*) AS DOUBLE) AS "TotalCases", CAST(count(*) AS DOUBLE) AS "NewCases", CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "TotalDeaths",
  {', '.join(f'0.0::DOUBLE AS "{n}"' for n in C.SNAPSHOT_NUMBERS if n not in ("Population", "TotalCases", "NewCases", "TotalDeaths"))},
  round(count(*) FILTER (o_orderstatus = 'F') / sum(o_custkey), 9) AS "Mortality"
FROM orders GROUP BY 1, 2""")
def snapshot(spark, sf):
    return snapshot_daily(country_pages(spark, sf)).withColumn("Mortality", F.round("Mortality", 9))


