"""Domain parameters, all of them arguments of the library's functions."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The 8-point compass, clockwise from north.
DIRECTIONS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


@dataclass(frozen=True)
class Config:
    #: Whose id names a merged row, most preferred first.
    precedence: tuple[str, ...] = ("pge", "ansg", "dhv")
    #: Which guides are authoritative in which countries; the order ranks guides of one country.
    scope: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"ansg": ("AU",), "dhv": ("DE", "AT", "CH")})
    fallback: tuple[str, ...] = ("pge",)
    merge_m: float = 250.0
    review_m: float = 400.0
    max_source_drop: float = 0.20
    max_count_delta: float = 0.05
    max_key_churn: float = 0.02
    max_provider_drop: float = 0.20
    max_key_move_m: float = 5000.0

    def check_guides(self, names: list[str]) -> None:
        """A guide without a place in the precedence can't name rows."""
        missing = sorted(set(names) - set(self.precedence))
        if missing:
            raise ValueError(f"guides without precedence: {missing}")


DEFAULT = Config()

RECORD_SCHEMA = (
    "provider string, id string, key string, name string, role string, lat double, lon double, wind map<string,int>, "
    "altitude double, country string, url string, closed string, notes string, tow boolean, approximate_location boolean, group_ids array<string>"
)
RECORD_COLUMNS = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
