import pytest
import pyarrow as pa

from aerowx import contracts as C
from aerowx.operators import positions
from aerowx.operators.requests import month_grid, page_status, status_counts
from aerowx.plans.historic import historic, staged_from_pages
from aerowx.sources.pages import html_tables, span_rejects

WIDTHS = [1, 3, 3, 3, 3, 3, 1]


def html_table(name, width, days, head=False):
    lines = ["<table>"]
    if head:
        lines.append(f"<thead><tr><th colspan='{width}'>{name}</th></tr></thead>")
    lines.append("<tr>" + "".join(f"<td>{name} {i}</td>" for i in range(width)) + "</tr>")
    for day in range(1, days + 1):
        cells = [str(day)] if name == "Date" else [f"{day}.{i}" for i in range(width)]
        lines.append("<tr>" + "".join(f"<td> {c}\n</td>" for c in cells) + "</tr>")
    return "\n".join([*lines, "</table>"])


def page(days=3, short=None, tables=7, head=False):
    names = ["Date", "Temp", "Dew", "Hum", "Wind", "Press", "Rain"][:tables]
    parts = ["<table><tr><td>menu</td></tr></table>", "<table><tr><td>facts</td></tr></table>"]
    for name, width in zip(names, WIDTHS):
        parts.append(html_table(name, width, days - (1 if name == short else 0), head))
    return "<html><body>" + "<p>text &amp; more</p>".join(parts) + "</body></html>"


SCHEMA = "url string, html string, airport_code string, year_month string"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [
            ("good", page(), "ACK", "2023-1"),
            ("headed", page(head=True), "ATL", "2023-2"),
            ("short", page(short="Rain"), "BIH", "2023-3"),
            ("short", page(short="Rain"), "BIH", "2023-3"),
            ("narrow", page(tables=5), "DAL", "2023-4"),
            ("missing", "<h1>Error 404: Page Not Found</h1>" + page(), "EMP", "2023-5"),
            ("empty", None, "FRI", "2023-6"),
        ],
        SCHEMA,
    )


def test_pages_to_contract(pages, rows):
    staged, without = staged_from_pages(pages)
    table, rejected = historic(staged)
    assert table.schema.simpleString() == C.HISTORIC.simpleString()
    found = table.select("airport_code", "date_recorded", "temperature_avg", "humidity_max", "precipitation")
    got = [(a, d.day, t, h, p) for a, d, t, h, p in rows(found)]
    assert got[:3] == [("ACK", 1, pytest.approx(1.1), 1, 1.0), ("ACK", 2, pytest.approx(2.1), 2, 2.0),
                       ("ACK", 3, pytest.approx(3.1), 3, 3.0)]
    assert [g[0] for g in got] == ["ACK"] * 3 + ["ATL"] * 3 + ["BIH"] * 3
    assert got[-1][1:] == (3, pytest.approx(3.1), 3, None)
    assert rejected.count() == 0
    assert sorted(r["url"] for r in without.collect()) == ["empty", "missing", "narrow"]


def test_nested_tables_spans_and_headers(spark, rows):
    text = """
        <table><tr><th>a</th><th>b</th></tr>
          <tr><td colspan=2>wide</td><td>x<table><tr><td>inner<td>open</table>y</td></tr>
          <tr></tr><tr><td>last &lt;cell&gt;</td>
    """
    found = html_tables(spark.createDataFrame([(1, text)], "id int, html string"), ["id"])
    assert rows(found) == [
        (1, 1, 0, False, ["wide", "wide", "xinneropeny"]),
        (1, 1, 0, True, ["a", "b"]),
        (1, 1, 1, False, ["last <cell>"]),
        (1, 2, 0, False, ["inner", "open"]),
    ]


def test_status(pages):
    checked = page_status(pages)
    assert tuple(status_counts(checked).first()) == (5, 2)


def test_month_grid_is_a_projection(spark):
    codes = spark.createDataFrame([("ACK",), ("ATL",)], "code string")
    grid = month_grid(codes, "code", 2022, 2023)
    assert grid.count() == 2 * 2 * 12
    first = grid.where("code = 'ACK' AND year = 2023 AND month = 3").first()
    assert first["url"] == "https://www.wunderground.com/history/monthly/ACK/date/2023-3"
    assert first["year_month"] == "2023-03"
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()


def test_cells_that_span_rows_are_carried_down(spark):
    html = (
        "<table><tr><th colspan=2>h</table>"
        "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td rowspan=3>e</table>"
        "<table><tr><td>x<td rowspan=2 colspan=2>y<td>z<tr><td>u<td>v</table>"
    )
    pages = spark.createDataFrame([(1, html), (2, None)], "id int, html string")
    found = html_tables(pages, ["id"]).where("id = 1").orderBy("table_no", "row_no")
    assert [(r.table_no, r.cells) for r in found.collect()] == [
        (1, ["h", "h"]),
        (2, ["a", "b"]),
        (2, ["a", "c"]),
        (2, ["d", "e"]),
        (2, ["e"]),
        (2, ["e"]),
        (3, ["x", "y", "y", "z"]),
        (3, ["u", "y", "y", "v"]),
    ]


def test_wide_spans_are_whole_and_too_wide_ones_rejected(spark):
    cell = "<table><tr><td colspan={}>a</table>"
    spans = [(1, cell.format(1500)), (2, cell.format(10**12)), (3, cell.format(10_001)), (4, cell.format(0))]
    pages = spark.createDataFrame(spans, "id int, html string")
    found = {r.id: len(r.cells) for r in html_tables(pages, ["id"]).collect()}
    assert found == {1: 1500, 4: 1}
    left_out = span_rejects(pages, ["id"]).collect()
    assert sorted((r.id, r.reason) for r in left_out) == [(2, "span"), (3, "span")]


def test_one_version_of_a_row_is_laid_out(spark):
    rows = [(1, 1, 1, ["b"]), (1, 1, 1, ["a"]), (1, 2, 1, ["x", "y"])]
    laid = positions.side_by_side(
        spark.createDataFrame(rows, "page int, table_no int, row_no int, cells array<string>"), ["page"]
    )
    assert [(r.cells, r.width) for r in laid.collect()] == [(["a", "x", "y"], 3)]


def test_large_keys_beside_null_stay_as_they_are(spark):
    ids = [2**60 + 1, 2**60 + 3, None]
    rows = [(i, "<table><tr><td>x</td></tr><tr><td>y</td></tr></table>") for i in ids]
    rows += [(7, "<table><tr><td colspan=20000>z</td></tr></table>")]
    df = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    found = html_tables(df, ["page_id"]).collect()
    assert sorted((r.page_id, r.row_no, r.cells[0]) for r in found if r.page_id) == [
        (i, k, c) for i in ids[:2] for k, c in enumerate("xy")
    ]
    assert sum(r.page_id is None for r in found) == 2
    assert [tuple(r) for r in span_rejects(df, ["page_id"]).collect()] == [(7, "span")]


def test_pages_are_parsed_a_slice_at_a_time(spark, rows, monkeypatch):
    from aerowx.sources import pages as module

    monkeypatch.setattr(module, "PAGES_AT_ONCE", 3)
    assert [b.num_rows for b in module._slices(iter([pa.record_batch({"x": list(range(10))})]), 3)] == [3, 3, 3, 1]
    html = [(k, "<table>" + "".join(f"<tr><td>{k}</td><td>{r}</td></tr>" for r in range(k % 4)) + "</table>") for k in range(20)]
    html += [(20, "<table><tr><td colspan=20000>wide</td></tr></table>")]
    df = spark.createDataFrame(html, "id int, html string").coalesce(1)
    want = [(k, 1, r, False, [str(k), str(r)]) for k in range(20) for r in range(k % 4)]
    assert rows(html_tables(df, ["id"])) == sorted(want, key=repr)
    assert [tuple(r) for r in span_rejects(df, ["id"]).collect()] == [(20, "span")]
