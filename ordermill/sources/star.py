"""The star schema as a set of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ordermill.model import STAR


class Star:
    """``star.fact_order`` and so on; a table is only opened when something asks for it."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open = open_table

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR:
            raise AttributeError(name)
        table = self._open(name)
        setattr(self, name, table)
        return table

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAR}
