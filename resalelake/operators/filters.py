"""Dashboard filter slots: what is not set adds no predicate."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.operators.periods import Period


@dataclass(frozen=True)
class Filters:
    period: Period = field(default_factory=Period)
    store_location: str | tuple[str, ...] | None = None
    channel: str | tuple[str, ...] | None = None
    contract_type: str | tuple[str, ...] | None = None
    ship_province: str | tuple[str, ...] | None = None
    snapshot_date: date | None = None

    def apply(self, df: DataFrame, day: str | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
        """Filter a fact. ``day`` is the date column the period applies to; ``only`` lists the slots
        the card offers (default: every slot whose column the fact has). A slot that is set but not
        offered is an error: leaving it out would show unfiltered numbers as filtered ones."""
        out = df
        if day is not None and (self.period.start or self.period.end):
            out = out.where(self.period.covers(day))
        for slot in fields(self):
            value = getattr(self, slot.name)
            if slot.name == "period" or value is None:
                continue
            if slot.name not in df.columns or (only is not None and slot.name not in only):
                raise ValueError(f"no filter slot {slot.name!r} here")
            values = value if isinstance(value, tuple) else (value,)
            out = out.where(F.col(slot.name).isin(*values))
        return out
