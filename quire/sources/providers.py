"""Decoders and models that live outside this library, behind small interfaces, with deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Provider(Protocol):
    """Rows in, rows out, batch by batch; made once per task, so a model loads lazily and once."""

    schema: str

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame: ...


class WithFallback:
    """Ask the first provider; where it raises, ask the second and note the event."""

    def __init__(self, first: Provider, second: Provider):
        self.first, self.second, self.schema = first, second, f"{first.schema}, event string"

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return self.first(batch).assign(event=None)
        except Exception as problem:  # noqa: BLE001  any failure of the first is what the second is for
            return self.second(batch).assign(event=f"fallback: {problem}")


def apply(rows: DataFrame, make: Callable[[], Provider]) -> DataFrame:
    schema = make().schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = None
        for frame in frames:
            if own is None:
                own = make()
            yield own(frame)

    return rows.mapInPandas(run, schema)


def isolated(make: Callable[[], Provider], key: str) -> Callable[[], Provider]:
    """A provider asked row by row whose failures become rows with an error instead of ending the task."""

    class Isolated:
        def __init__(self):
            self.inner = make()
            self.schema = f"{self.inner.schema}, error string"

        def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
            out = []
            for i in range(len(batch)):
                one = batch.iloc[i : i + 1]
                try:
                    out.append(self.inner(one).assign(error=None))
                except Exception as problem:  # noqa: BLE001
                    out.append(pd.DataFrame({key: [one[key].iloc[0]], "error": [str(problem)]}))
            names = [c.strip().split()[0] for c in self.schema.split(",")]
            return pd.concat(out).reindex(columns=names) if out else pd.DataFrame(columns=names)

    return Isolated
