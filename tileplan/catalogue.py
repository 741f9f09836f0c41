"""The set of tables every operator works on."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


class Catalogue:
    """Named DataFrames, each built on first use; ``cat.raw_inputs`` and so on."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            table = self._tables[name]
        except KeyError:
            raise AttributeError(f"no table {name!r} in the catalogue") from None
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def names(self) -> list[str]:
        return sorted(self._tables)

    def replace(self, **tables: DataFrame) -> Catalogue:
        """The same catalogue with some tables exchanged."""
        return Catalogue({**self._tables, **tables})
