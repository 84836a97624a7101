"""Tables in web pages: one row per table row, cells as text.

The parser is small and runs per page inside Spark tasks; pages are rows, so the
work is split like any other column.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Ship this module's code with the tasks, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns or rows that one cell may span; a page beyond it is rejected as a whole.
MAX_SPAN = 10_000
#: Pages of an Arrow batch parsed and sent on together, so that a task holds so many in Python.
PAGES_AT_ONCE = 256


class _Tables(HTMLParser):
    """Collects (table_no, row_no, is_header, cells), tables counted in page order.

    A nested table is a table of its own, and its text also belongs to the cell
    around it. A cell that spans columns or rows is repeated in each of them; rows that
    exist only because a cell reaches past the last one are added.
    """

    def __init__(self, container: str, row: str, cells: Sequence[str], max_span: int):
        super().__init__(convert_charrefs=True)
        self.container, self.row, self.cells = container, row, cells
        self.max_span = max_span
        self.widest_span = 1
        self.open: list[dict] = []
        self.rows: list[tuple[int, int, bool, list[str]]] = []
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag == self.container:
            self.count += 1
            self.open.append(
                {"no": self.count, "thead": False, "row": None, "text": None,
                 "headers": 0, "bodies": 0, "kind": "headers", "below": []}
            )
            return
        if not self.open:
            return
        table = self.open[-1]
        if tag == "thead":
            table["thead"] = True
        if tag == self.row:
            self._end_row()
            table["row"] = []
        if tag in self.cells and table["row"] is not None:
            self._end_cell()
            given = dict(attrs)
            table["text"] = []
            table["across"], table["down"] = (self._span(given.get(a)) for a in ("colspan", "rowspan"))
            table["th"] = tag == "th"

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in self.cells:
            self._end_cell()
        if tag in (self.row, "thead", self.container):
            self._end_row()
        if tag == "thead":
            self.open[-1]["thead"] = False
        if tag == self.container:
            self._end_spans()
            self.open.pop()

    def handle_data(self, data):
        for table in self.open:
            if table["text"] is not None:
                table["text"].append(data)

    def close(self):
        super().close()
        while self.open:
            self._end_row()
            self._end_spans()
            self.open.pop()

    def _span(self, given: str | None) -> int:
        span = int(given) if given and given.isascii() and given.isdigit() and len(given) < 10 else 1
        if given and given.isascii() and given.isdigit() and len(given) >= 10:
            span = self.max_span + 1
        self.widest_span = max(self.widest_span, span)
        # A page with a wider span is rejected as a whole; nothing of it is laid out.
        return span if 0 < span <= self.max_span else 1

    def _end_cell(self):
        table = self.open[-1]
        if table["text"] is not None:
            text = " ".join("".join(table["text"]).split())
            table["row"].append((text, table["th"], table["across"], table["down"]))
            table["text"] = None

    def _end_row(self):
        table = self.open[-1]
        self._end_cell()
        if table["row"] or (table["row"] is not None and table["below"]):
            heads = bool(table["row"]) and all(cell[1] for cell in table["row"])
            kind = "headers" if table["thead"] or (heads and not table["bodies"]) else "bodies"
            if kind != table["kind"]:
                self._end_spans()
                table["kind"] = kind
            self._lay(table["row"])
        table["row"] = None

    def _end_spans(self):
        while self.open[-1]["below"]:
            self._lay([])

    def _lay(self, cells):
        """Add a row: its own cells, each after those that reach down to its place."""
        table = self.open[-1]
        waiting, below, texts = table["below"], [], []

        def put(text, down):
            if down > 1:
                below.append((len(texts), text, down - 1))
            texts.append(text)

        for text, _, across, down in cells:
            while waiting and waiting[0][0] <= len(texts):
                put(*waiting.pop(0)[1:])
            for _ in range(across):
                put(text, down)
        # A count of 1 stands for the row it is put into.
        for _, text, left in waiting:
            put(text, left)
        table["below"] = below
        if texts:
            self.rows.append((table["no"], table[table["kind"]], table["kind"] == "headers", texts))
            table[table["kind"]] += 1


def html_tables(
    pages: DataFrame,
    keys: Sequence[str],
    html: str = "html",
    container: str = "table",
    row: str = "tr",
    cells: Sequence[str] = ("td", "th"),
    max_span: int = MAX_SPAN,
) -> DataFrame:
    """(*keys, table_no from 1, row_no from 0, is_header, cells): every row of every table.

    Body rows and header rows are numbered apart; header rows are those in a
    ``thead`` or, without one, the leading rows of ``th`` cells only. A page with a cell
    that spans more than ``max_span`` columns or rows gives nothing here and is listed by
    ``span_rejects``.
    """
    keys = list(keys)
    found = T.StructType(
        [
            T.StructField("table_no", T.IntegerType()),
            T.StructField("row_no", T.IntegerType()),
            T.StructField("is_header", T.BooleanType()),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )
    schema = T.StructType([*[pages.schema[k] for k in keys], *found.fields])
    tags = (container, row, tuple(cells), max_span)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, PAGES_AT_ONCE):
            page, out = [], []
            for k, text in enumerate(batch.column(len(keys)).to_pylist()):
                parser = _parsed(text, tags)
                if parser.widest_span <= max_span:
                    page += [k] * len(parser.rows)
                    out += parser.rows
            columns = zip(*out) if out else [()] * len(found.fields)
            yield _with_keys(batch, len(keys), page, columns, schema)

    return pages.select(*keys, html).mapInArrow(extract, schema)


def span_rejects(
    pages: DataFrame,
    keys: Sequence[str],
    html: str = "html",
    container: str = "table",
    row: str = "tr",
    cells: Sequence[str] = ("td", "th"),
    max_span: int = MAX_SPAN,
) -> DataFrame:
    """(*keys, reason): the pages that ``html_tables`` leaves out for a cell that spans too much."""
    keys = list(keys)
    schema = T.StructType([*[pages.schema[k] for k in keys], T.StructField("reason", T.StringType())])
    tags = (container, row, tuple(cells), max_span)

    def reject(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, PAGES_AT_ONCE):
            texts = batch.column(len(keys)).to_pylist()
            page = [k for k, text in enumerate(texts) if _parsed(text, tags).widest_span > max_span]
            yield _with_keys(batch, len(keys), page, [["span"] * len(page)], schema)

    return pages.select(*keys, html).mapInArrow(reject, schema)


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, at most ``most`` at a time (slices share the buffers)."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def _with_keys(
    batch: pa.RecordBatch, n_keys: int, rows: list[int], columns: Iterable[Sequence], schema: T.StructType
) -> pa.RecordBatch:
    """New columns beside the keys of the pages they come from, which no conversion touches."""
    at = pa.array(rows, pa.int64())
    arrays = [batch.column(k).take(at) for k in range(n_keys)]
    kinds = {T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}
    fields = schema.fields[n_keys:]
    arrays += [pa.array(list(c), kinds.get(f.dataType, pa.list_(pa.string()))) for c, f in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())


def _parsed(html: str | None, tags: tuple) -> _Tables:
    parser = _Tables(*tags)
    parser.feed(html or "")
    parser.close()
    return parser
