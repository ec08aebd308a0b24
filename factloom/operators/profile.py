"""A declarative query profile: normalised sets, an as-of day and a window, as one predicate."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """Empty sets mean no restriction. Equal profiles have equal ids, whatever the order of their sets."""

    places: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    first: str | None = None
    last: str | None = None
    as_of: str | None = None

    def __post_init__(self):
        for name in ("places", "categories"):
            object.__setattr__(self, name, tuple(sorted(set(getattr(self, name)))))
        if self.first and self.last and self.first > self.last:
            raise ValueError("the window ends before it begins")

    @property
    def id(self) -> str:
        return "profile_" + hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]

    def predicate(self, place: str, category: str, date: str) -> Column:
        """Membership and date bounds; a row without a place is always in scope, one without a date never under bounds."""
        out = F.lit(True)
        if self.places:
            out = out & (F.col(place).isNull() | F.col(place).isin(*self.places))
        if self.categories:
            out = out & F.col(category).isin(*self.categories)
        for bound, low in ((self.first, True), (self.last, False), (self.as_of, False)):
            if bound:
                out = out & ((F.col(date) >= bound) if low else (F.col(date) <= bound))
        return out
