"""A Python data source for tables that are served page by page: each partition reads its own range of rows.

The transport is a function (table, first, last) -> list of rows, so that HTTP, a cloud listing or a test double fit; a
page shorter than asked for ends the range.
"""

from __future__ import annotations

import importlib

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PagedSource(DataSource):
    """Options: table, rows (how many to expect), page (rows a request, 1000), transport (module:function)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options.get("schema", "id long, value string")

    def reader(self, schema):
        return PagedReader(dict(self.options))


class Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        rows, page = int(self.options["rows"]), int(self.options.get("page", "1000"))
        return [Pages(i, min(i + page, rows) - 1) for i in range(0, rows, page)] or [Pages(0, -1)]

    def read(self, partition: Pages):
        module, _, name = self.options["transport"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        if partition.last >= partition.first:
            for row in fetch(self.options.get("table", ""), partition.first, partition.last):
                yield tuple(row)


class ListedSource(DataSource):
    """Listings that are paged by token: each root is a partition, followed from page to page until there is no token.

    Options: table, roots (comma-separated), transport (module:function of table, root, token -> rows, next token or None).
    """

    @classmethod
    def name(cls) -> str:
        return "listed"

    def schema(self) -> str:
        return self.options.get("schema", "root string, id long, value string")

    def reader(self, schema):
        return ListedReader(dict(self.options))


class Root(InputPartition):
    def __init__(self, root: str):
        self.root = root


class ListedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        return [Root(r) for r in self.options["roots"].split(",")]

    def read(self, partition: Root):
        module, _, name = self.options["transport"].partition(":")
        fetch, token, seen = getattr(importlib.import_module(module), name), None, set()
        while True:
            rows, token = fetch(self.options.get("table", ""), partition.root, token)
            for row in rows:
                yield (partition.root, *row)
            if token is None:
                return
            if token in seen:
                raise ValueError(f"the listing of {partition.root} returns to a token")
            seen.add(token)


class SqliteSource(DataSource):
    """A table of a SQLite file, opened read-only, by ranges of rowid. Options: path (mounted on all executors), table, columns, parts."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema):
        return SqliteReader(dict(self.options))


class Rows(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def _open(self):
        import sqlite3

        return sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)

    def partitions(self):
        con = self._open()
        try:
            low, high = con.execute(f'select min(rowid), max(rowid) from "{self.options["table"]}"').fetchone()
        finally:
            con.close()
        if low is None:
            return [Rows(0, -1)]
        parts = max(1, int(self.options.get("parts", "8")))
        step = -(-(high - low + 1) // parts)
        return [Rows(i, min(i + step, high + 1) - 1) for i in range(low, high + 1, step)]

    def read(self, partition: Rows):
        con = self._open()
        try:
            names = ", ".join(f'"{c}"' for c in self.options["columns"].split(","))
            yield from con.execute(f'select {names} from "{self.options["table"]}" where rowid between ? and ?', (partition.first, partition.last))
        finally:
            con.close()


def parquet_rows(table: str, first: int, last: int) -> list[tuple]:
    """A transport over a Parquet file with two columns: its rows first to last, in the file's order, as a service would send them."""
    import pyarrow.parquet as pq

    out, at = [], 0
    file = pq.ParquetFile(table)
    for k in range(file.num_row_groups):
        n = file.metadata.row_group(k).num_rows
        if at <= last and at + n > first:
            group = file.read_row_group(k).slice(max(0, first - at), min(n, last + 1 - at) - max(0, first - at))
            out += list(zip(*(c.to_pylist() for c in group.columns)))
        at += n
    return out


def parquet_pages(table: str, root: str, token: str | None, page: int = 2) -> tuple[list[tuple], str | None]:
    """A transport by token over a Parquet file (root, id, value): a root's rows by id, a few a page."""
    import pyarrow.parquet as pq

    rows = sorted((i, v) for r, i, v in zip(*(c.to_pylist() for c in pq.read_table(table).columns)) if str(r) == root)
    at = int(token or 0)
    return rows[at : at + page], str(at + page) if at + page < len(rows) else None


def numbered(table: str, first: int, last: int) -> list[tuple[int, str]]:
    """A transport for tests: rows that count."""
    return [(i, f"{table}-{i}") for i in range(first, last + 1)]
