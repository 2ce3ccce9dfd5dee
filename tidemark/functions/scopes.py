"""Account-type scopes that narrow a quality rule."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scope:
    """Keep (or leave out) rows of some account types; rows of unknown type never qualify."""

    types: tuple[str, ...]
    keep: bool = True

    def condition(self, type_column: str = "account_type") -> Column:
        listed = F.col(type_column).isin(*self.types)
        return listed if self.keep else ~listed


# Override names and the account types they select, in order of precedence.
NULL_SCOPES = {
    "ConditionalNulls": Scope(("VBA",)),
    "ConditionalNullsNonLegacy": Scope(("VBA", "TA")),
    "ConditionalNullsNonVBO": Scope(("VBO",), keep=False),
}
DUPLICATE_SCOPES = {
    "ConditionalDupNonLegacy": Scope(("VBA", "TA")),
}


def _first(scopes: dict[str, Scope], overrides: Collection[str]) -> Scope | None:
    return next((scope for name, scope in scopes.items() if name in overrides), None)


def null_scope(overrides: Collection[str]) -> Scope | None:
    """Scope of a null check; None means every row."""
    return _first(NULL_SCOPES, overrides)


def duplicate_scope(overrides: Collection[str]) -> Scope | None:
    """Scope of a duplicate check; null overrides have no say here, nor the reverse."""
    return _first(DUPLICATE_SCOPES, overrides)
