"""Dashboard filter model (P4): date range, optional route ids, optional vehicle type names."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date_key(d: dt.date | str) -> int:
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return d.year * 10000 + d.month * 100 + d.day


@dataclass(frozen=True)
class Filters:
    """Empty lists mean "no restriction"; ``None`` dates mean an open end."""

    start_date: dt.date | str | None = None
    end_date: dt.date | str | None = None
    route_ids: tuple[str, ...] = field(default_factory=tuple)
    vehicle_types: tuple[str, ...] = field(default_factory=tuple)

    @property
    def start_date_key(self) -> int | None:
        return None if self.start_date is None else to_date_key(self.start_date)

    @property
    def end_date_key(self) -> int | None:
        return None if self.end_date is None else to_date_key(self.end_date)

    def needs_routes(self) -> bool:
        return bool(self.route_ids)

    def needs_vehicle_types(self) -> bool:
        return bool(self.vehicle_types)

    def predicate(self) -> Column:
        """Literal keys so partition pruning on ``date_key`` is static."""
        p = F.lit(True)
        if self.start_date_key is not None:
            p = p & (F.col("date_key") >= self.start_date_key)
        if self.end_date_key is not None:
            p = p & (F.col("date_key") <= self.end_date_key)
        if self.route_ids:
            p = p & F.col("route_id").isin(list(self.route_ids))
        if self.vehicle_types:
            p = p & F.col("type_name").isin(list(self.vehicle_types))
        return p

    def date_predicate(self) -> Column:
        p = F.lit(True)
        if self.start_date_key is not None:
            p = p & (F.col("date_key") >= self.start_date_key)
        if self.end_date_key is not None:
            p = p & (F.col("date_key") <= self.end_date_key)
        return p


ALL = Filters()
