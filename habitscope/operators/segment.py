"""Rule-based segmentation: a label from the first rule that holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from habitscope.functions.columns import first_match


@dataclass(frozen=True)
class Segmentation:
    """Ordered (label, SQL predicate) rules and the label for everything else.

    Predicates are Spark SQL text over the columns of the table, so a rule set is
    plain data. A row whose predicates are all false or NULL gets ``default``;
    give ``null_label`` and ``null_when`` to keep NULL rows apart instead.
    """

    name: str
    rules: Sequence[tuple[str, str]]
    default: str
    null_label: str | None = None
    null_when: str | None = None

    def column(self) -> Column:
        rules = [(label, F.expr(predicate)) for label, predicate in self.rules]
        null_when = None if self.null_when is None else F.expr(self.null_when)
        return first_match(rules, self.default, self.null_label, null_when).alias(self.name)


def segment(df: DataFrame, *segmentations: Segmentation) -> DataFrame:
    """Add one label column per segmentation, in one projection."""
    return df.withColumns({s.name: s.column() for s in segmentations})
