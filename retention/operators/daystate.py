"""Customer-day states: a mergeable pre-aggregate of both fact tables.

A state row holds, for one customer and one day, the counts, sums and maxima that the features of any
window are merged from. Facts are read once and combined before their first shuffle; what meets the
snapshots afterwards is a row a customer and day, whatever the number of snapshots or of facts.

A window ends at midnight of its snapshot day, so of that day only rows of exactly midnight count.
Each state is therefore kept twice: over all rows of the day, and over those of midnight.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.functions.safe import count_if
from retention.functions.timewin import is_midnight
from retention.operators.features import MEASURES, Measure, facts
from retention.operators.rangejoin import day_number

DAY, AT_MIDNIGHT = "day", "_0"


@dataclass(frozen=True)
class State:
    """``how`` (count | sum | max) over a customer's rows of one table and day that have ``where`` and, with
    ``positive``, a value above 0 in ``of``. A count with ``of`` is of its values that aren't null."""

    how: str
    fact: str
    where: tuple[str, str] | None = None
    of: str | None = None
    positive: bool = False

    @property
    def name(self) -> str:
        return "_".join(filter(None, [self.fact, self.how, *(self.where or ()), self.of, "positive" if self.positive else ""]))

    def columns(self) -> list[Column]:
        tests = [F.col("_fact") == self.fact]
        if self.where is not None:
            tests.append(F.col(self.where[0]) == self.where[1])
        if self.positive:
            tests.append(F.col(self.of) > 0)
        if self.how == "count" and self.of is not None:
            tests.append(F.col(self.of).isNotNull())
        out = []
        for name, more in ((self.name, []), (self.name + AT_MIDNIGHT, [F.col("_midnight")])):
            test = reduce(and_, tests + more)
            if self.how == "count":
                out.append(count_if(test).alias(name))
            else:
                out.append({"sum": F.sum, "max": F.max}[self.how](F.when(test, F.col(self.of))).alias(name))
        return out


def states_of(m: Measure, fact: str) -> list[State]:
    """The states that a measure is merged from."""
    if m.how in ("count", "recency"):
        return [State("count", fact, m.where, None, m.positive)]
    if m.how == "avg":
        return [State("sum", fact, m.where, m.of, m.positive), State("count", fact, m.where, m.of, m.positive)]
    return [State(m.how, fact, m.where, m.of, m.positive)]


STATES = list(dict.fromkeys(s for m, fact in MEASURES for s in states_of(m, fact)))


def day_states(transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    """(customer_id, day, a column a state, the same of midnight): at most one row a customer and day. States
    of parts of the data are merged by adding counts and sums and taking the larger maximum."""
    ts = F.col("timestamp")
    rows = facts(transactions, interactions).withColumns({DAY: day_number(ts), "_midnight": is_midnight(ts)})
    return rows.groupBy("customer_id", DAY).agg(*(c for s in STATES for c in s.columns()))


def merge_days(states: DataFrame) -> DataFrame:
    """One row for each customer and day of several state tables (of other days, or other rows of the same)."""
    def merged(s: State):
        for name in (s.name, s.name + AT_MIDNIGHT):
            yield (F.max if s.how == "max" else F.sum)(name).alias(name)

    return states.groupBy("customer_id", DAY).agg(*(c for s in STATES for c in merged(s)))


def measure_over(m: Measure, fact: str, age: Column) -> Column:
    """A measure over the days of a window, from their states; ``age`` is 0 on the snapshot's day."""
    within = age <= m.within if m.within is not None else F.lit(True)

    def state(s: State) -> Column:
        return F.when(age == 0, F.col(s.name + AT_MIDNIGHT)).otherwise(F.col(s.name))

    first, *second = states_of(m, fact)
    if m.how == "recency":
        return F.min(F.when(state(first) > 0, age)).alias(m.name)
    chosen = F.when(within, state(first))
    if m.how == "count":
        return F.coalesce(F.sum(chosen), F.lit(0)).alias(m.name)
    if m.how == "avg":
        return F.try_divide(F.sum(chosen), F.sum(F.when(within, state(second[0])))).alias(m.name)
    return {"sum": F.sum, "max": F.max}[m.how](chosen).alias(m.name)


def active_days(transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    """(customer_id, day, at_midnight): the days with activity that keeps a customer (L3: any transaction, or an
    interaction with a positive session), and whether some of it was at exactly midnight. A row a customer, day
    and table. Repeated rows change nothing here, so Catalyst drops a cleaning step's whole-row dedupe beneath."""
    ts = F.col("timestamp")

    def days(df: DataFrame) -> DataFrame:
        return df.groupBy("customer_id", day_number(ts).alias(DAY)).agg(F.max(is_midnight(ts)).alias("at_midnight"))

    return days(transactions).union(days(interactions.filter(F.col("session_duration") > 0)))
