"""Gate measures collected while a layer is written, so that the gate need not read it again.

The aggregates of a gate ride along with a write as observed metrics: every task adds up the rows it writes,
and the sums of the tasks that succeeded arrive with the end of the job. The rows observed must be those
written, in the stage that writes them: nothing after ``observe`` may shuffle, or a repeated task of an
earlier stage would count twice. Rules with a grouping of their own (uniqueness, references) cannot ride along;
they read the columns of their key from what was written.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from . import rules as R
from .gates import aggregates_of

LOG = logging.getLogger(__name__)
#: Measures of these types come back as values that can be literals again.
_PLAIN = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


class Observed:
    """Measures of a gate on the rows that pass through ``frame``, of all or of those of ``where``.

    Write ``frame``, then hand ``row()`` to ``Gate.evaluate`` or ``gate_rows`` as ``seen``.
    """

    def __init__(self, df: DataFrame, rules: Sequence[R.Rule], where: Column | None = None) -> None:
        named = aggregates_of(df, rules, where)
        try:
            types = df.agg(*[c.alias(n) for n, c in named.items()]).schema  # analysed, not run
        except PySparkException:  # a rule that does not fit the frame is left to the gate, which reports it
            named = aggregates_of(df, [], where)
            types = df.agg(*[c.alias(n) for n, c in named.items()]).schema
        self._types = {f.name: f.dataType for f in types if isinstance(f.dataType, _PLAIN)}
        self._observation = Observation()
        self._spark = df.sparkSession
        self.frame = df.observe(self._observation, *[named[n].alias(n) for n in self._types])

    @property
    def total(self) -> int:
        """Rows written, once the write is done."""
        return self._observation.get[R.TOTAL]

    def row(self) -> DataFrame:
        """The observed values as a frame of one row, made of literals: using it starts no job."""
        values = self._observation.get
        one = self._spark.sql("VALUES (1) AS t(one)")
        return one.select(*[F.lit(values[n]).cast(kind).alias(n) for n, kind in self._types.items()])


def write_observed(
    df: DataFrame, rules: Sequence[R.Rule], write: Callable[[DataFrame], DataFrame], where: Column | None = None
) -> tuple[DataFrame, DataFrame | None, int]:
    """(what was written, its observed measures, its rows or those of ``where``).

    ``write`` takes a frame, writes it and returns it read again. If a measure cannot be computed on the
    rows, the write is repeated without measures: they are None then, and the gate reads what was written.
    """
    observed = Observed(df, rules, where)
    try:
        stored = write(observed.frame)
        return stored, observed.row(), observed.total
    except PySparkException:
        LOG.exception("written again without observed measures")
    stored = write(df)
    rows = stored if where is None else stored.filter(where)
    return stored, None, rows.count()
