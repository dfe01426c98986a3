"""A named set of tables that is built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame

from stocktally.session import cut_lineage

Builder = Callable[["Tables"], DataFrame]


class Tables(Mapping[str, DataFrame]):
    """Names to DataFrames; a builder may ask for other names of the same set.

    Building is lazy and remembered, so shared inputs appear once in a plan and
    Spark can reuse their exchanges.
    """

    def __init__(self, builders: Mapping[str, Builder] | None = None, frames: Mapping[str, DataFrame] | None = None):
        self._builders: dict[str, Builder] = dict(builders or {})
        self._frames: dict[str, DataFrame] = dict(frames or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._builders:
                raise KeyError(f"no table named {name!r}")
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter({**self._builders, **self._frames})

    def __len__(self) -> int:
        return len({**self._builders, **self._frames})

    def put(self, name: str, frame: DataFrame) -> None:
        """Replace a table, for example by its materialized copy."""
        self._frames[name] = frame

    def stored(self, names: Iterable[str]) -> "Tables":
        """The same set with the named tables written once, on first use."""
        cuts = {n: _stored(n, self._builders[n]) for n in names if n in self._builders}
        return Tables({**self._builders, **cuts}, self._frames)

    def extended(self, builders: Mapping[str, Builder]) -> "Tables":
        return Tables({**self._builders, **builders}, self._frames)


def _stored(name: str, builder: Builder) -> Builder:
    return lambda tables: cut_lineage(builder(tables), name, "zstd")
