"""Table grids of HTML against grids known beforehand; intervals of decades against plain comparison."""

import random
from datetime import date, timedelta

import pytest

from tallycast.operators.joins import flag_intervals
from tallycast.sources.grids import html_grids


def drawn(r):
    """A table as HTML with random spans, end tags and nested tables, and the grid it must give."""
    height, width = r.randrange(1, 7), r.randrange(1, 7)
    grid = [[None] * width for _ in range(height)]
    parts, inner = ["<TABLE class='a b'>" if r.random() < 0.5 else "<table>"], []
    for y in range(height):
        parts.append(r.choice(["<tr>", "<tr class=x>", "<tbody><tr>"]))
        x = 0
        while x < width:
            if grid[y][x] is not None:
                x += 1
                continue
            free = 1
            while x + free < width and grid[y][x + free] is None:
                free += 1
            wide, tall = r.choice([1, 1, 1, r.randint(1, free)]), r.choice([1, 1, r.randint(1, height - y)])
            text, shown = f"c{y}.{x}", r.choice(["c%d.%d", " c%d.%d\n", "<b>c%d.%d</b>", "c%d<!-- <td> -->.%d", "<script>'<td>'</script>c%d.%d"]) % (y, x)
            if r.random() < 0.15:
                text, shown = f"{text} & in", f"{shown} &amp; <table><tr><td>in</table>"
                inner.append(["in"])
            for dy in range(tall):
                for dx in range(wide):
                    grid[y + dy][x + dx] = text
            said = "".join(f" {k}={q}{n if n != height - y or k == 'colspan' or r.random() < 0.5 else 0}{q}" for k, n in (("colspan", wide), ("rowspan", tall)) if n > 1 for q in [r.choice(["", '"', "'"])])
            parts.append(f"<td{said}>{shown}" + r.choice(["</td>", ""]))
            x += wide
        parts.append(r.choice(["</tr>", ""]))
    return "".join(parts) + r.choice(["</table>", "</table>after"]), grid, inner


def test_random_tables(spark):
    r = random.Random(6)
    pages = [[drawn(r) for _ in range(r.randrange(0, 4))] for _ in range(150)]
    df = spark.createDataFrame([(i, "<p>x" + "text".join(h for h, _, _ in p), "taken") for i, p in enumerate(pages)], "page_id long, html string, cells string")
    got = {}
    for x in html_grids(df).collect():
        got.setdefault((x.page_id, x.depth, x.table_pos), {})[x.row_pos] = x.cells
    for i, p in enumerate(pages):
        outer = [list(got[k].values()) for k in sorted(got) if k[:2] == (i, 0)]
        nested = [list(got[k].values()) for k in sorted(got) if k[:2] == (i, 1)]
        assert outer == [g for _, g, _ in p], p
        assert nested == [[g] for _, _, more in p for g in more]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, []),
        ("", []),
        ("<td>outside</td></table>", []),
        ("<table></table>", []),
        ("<table><td>no row<td>", [["no row", ""]]),
        ("<table><tr><th>a<th>b</tr><tr><td>1</table>", [["a", "b"], ["1"]]),
        ("<table><tr><td rowspan=3>a<td>b<tr><td>c", [["a", "b"], ["a", "c"]]),
        ("<table><tr><td rowspan=2>a<td>b<tr><td colspan=2>c", [["a", "b"], ["a", "c", "c"]]),
        ("<table><tr><td>a<td rowspan=2>b<tr><td colspan=3>c", [["a", "b"], ["c", "b"]]),
        ("<table><tr><td colspan=x>a &lt; b &amp;eacute;<td title='a>b'>é&nbsp;1", [["a < b &eacute;", "é 1"]]),
        ("<table><tr><td>a<table><tr><td>b</td><td>c</table>d<td>e</table>", [["abcd", "e"]]),
    ],
)
def test_edges(spark, html, want):
    df = spark.createDataFrame([(1, html), (1, html)], "page_id long, html string")
    rows = [x.cells for x in html_grids(df).collect() if x.depth == 0]
    assert sorted(rows) == sorted(want * 2)


def test_header_class_and_keys(spark):
    df = spark.createDataFrame([("u", 3, "<table class='wikitable sortable'><tr><th>h</tr><tr><td>v")], "url string, day int, html string")
    rows = html_grids(df, ("url", "day")).orderBy("row_pos").collect()
    assert [tuple(x) for x in rows] == [("u", 3, 0, 0, "wikitable sortable", 0, True, ["h"]), ("u", 3, 0, 0, "wikitable sortable", 1, False, ["v"])]
    assert html_grids(df.limit(0), ("url", "day")).collect() == []


def test_intervals_of_decades(spark):
    r = random.Random(8)
    day = lambda n: date(1970, 1, 1) + timedelta(days=n)
    days = [(r.choice("ab"), day(r.randrange(-30_000, 30_000)), float(i)) for i in range(400)] + [("a", None, 0.0), (None, day(0), 0.0)]
    spans = [(r.choice("ab"), (s := r.randrange(-40_000, 40_000)), s + r.choice([0, 1, 6, 300, 9_000, 40_000]), f"n{i}") for i in range(60)]
    spans += [("a", 10, 5, "backwards")]
    got = flag_intervals(
        spark.createDataFrame(days, "series string, date date, value double"),
        spark.createDataFrame([(k, day(a), day(b), n) for k, a, b, n in spans] + [("b", None, day(3), "open")], "series string, start date, end date, label string"),
        label="label",
    )
    want = {v: sorted(n for k, a, b, n in spans if k == s and d and day(a) <= d <= day(b)) for s, d, v in days if v}
    assert {x.value: x.labels or [] for x in got.collect() if x.value} == want
    assert all(x.inside == bool(x.labels) for x in got.collect())
    assert got.count() == len(days)
