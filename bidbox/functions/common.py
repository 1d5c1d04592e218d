"""Helpers shared by the Column builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body`` (a lambda binding).

    A derived text that several checks read would otherwise be copied into each check; when
    Catalyst pushes a filter below the projection that defines the text, every copy is
    evaluated.  Binding it through a one-element ``transform`` keeps one evaluation per row.
    """
    return F.get(F.transform(F.array(value), body), 0)
