"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append ``columns`` so that filters above them do not evaluate them a second time.

    Catalyst pushes a filter through a projection by copying the projected expression into the
    filter, so ``select(from_json(..)).filter(isNotNull)`` parses every row twice, and a filter over
    twenty tests of one parsed VARIANT parses it twenty times. A one-element ``inline`` is a narrow
    operator that a filter on its output cannot move below, which keeps the work at one evaluation.
    The expressions themselves stay in a projection under it, where they are compiled; a generator
    would interpret those that hold a lambda or ``from_json``.
    """
    computed = df.select("*", *[column.alias(f"_once_{name}") for name, column in columns.items()])
    packed = F.struct(*[F.col(f"_once_{name}").alias(name) for name in columns])
    return computed.select(*df.columns, F.inline(F.array(packed)))
