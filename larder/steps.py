"""The steps of a query that run while it is built, for whoever wants to see their plans."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame

Watcher = Callable[[str, DataFrame], None]

_watcher: ContextVar[Watcher | None] = ContextVar("watcher", default=None)


@contextmanager
def watch(watcher: Watcher) -> Iterator[None]:
    """Hand every step taken inside the block to ``watcher``, by name, before it runs."""
    token = _watcher.set(watcher)
    try:
        yield
    finally:
        _watcher.reset(token)


def step(df: DataFrame, name: str) -> DataFrame:
    """``df``, which is about to be run while a query is still being built."""
    watcher = _watcher.get()
    if watcher is not None:
        watcher(name, df)
    return df
