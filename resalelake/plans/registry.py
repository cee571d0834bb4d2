"""Every registered query: name -> (session, folder of driver tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from resalelake.operators.filters import Filters
from resalelake.operators.periods import Period
from resalelake.plans.facts import FACT_NAMES, Facts, to_edge
from resalelake.plans.metrics import SPECIAL, Card, catalogue_cards, run, tab_cards, windowed_cards
from resalelake.plans.operator_queries import QUERIES, Context
from resalelake.sources.driver_tables import AS_OF, DriverTables

Query = Callable[[SparkSession, str], DataFrame]


def _fact(name: str) -> Query:
    return lambda spark, folder: to_edge(getattr(Facts(DriverTables(spark, folder).raw()), name)())


def _facts(spark: SparkSession, folder: str) -> Facts:
    return Facts(DriverTables(spark, folder).raw())


# The period a reader would pick on cards that ask for one: all days that any fixture has.
HISTORY = Filters(Period(date(1995, 1, 1), date(2001, 12, 31)))
# Cards whose date filter is optional run without it.
OPTIONAL_DAY = ("customers", "seller")


def _card(card: Card) -> Query:
    filters = Filters() if card.fact in OPTIONAL_DAY else HISTORY
    return lambda spark, folder: run(card, _facts(spark, folder), AS_OF, filters)


def _special(build) -> Query:
    return lambda spark, folder: build(_facts(spark, folder), AS_OF)


def _operator(fn) -> Query:
    return lambda spark, folder: fn(Context(spark, folder))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"fact_{name}": _fact(name) for name in FACT_NAMES}
    out |= {card.key: _card(card) for card in [*tab_cards(), *catalogue_cards(), *windowed_cards()]}
    out |= {key: _special(build) for key, build in SPECIAL.items()}
    out |= {key: _operator(fn) for key, fn in QUERIES.items()}
    return out
