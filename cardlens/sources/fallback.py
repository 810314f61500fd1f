"""The first source that can be read."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

Loader = Callable[[], DataFrame]


def first_available(sources: Iterable[tuple[str, Loader]]) -> tuple[str, DataFrame]:
    """Name and rows of the first source that exists and is not empty.

    Only a source that is missing (``AnalysisException``) or empty is passed over; any
    other failure is an error of its own and is raised.
    """
    passed_over = []
    for name, load in sources:
        try:
            df = load()
        except AnalysisException as error:
            passed_over.append(f"{name}: {error.getCondition()}")
            continue
        if not df.isEmpty():
            return name, df
        passed_over.append(f"{name}: empty")
    raise LookupError("no source of transactions is available; " + "; ".join(passed_over))
