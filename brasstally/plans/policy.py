"""What differs between deployments: the kinds, lists and keys a feed is run with."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, functions as F

from brasstally.operators.gates import SYNC_WINDOW, THIRD_PARTY_TYPES
from brasstally.operators.skew import NONE_HOT, HotKeys

Hot = Mapping[str, HotKeys] | None


@dataclass(frozen=True)
class Policy:
    """Status and type lists are plain values; ``tiebreak`` makes the newest version unique."""

    third_party_types: Sequence[str] = THIRD_PARTY_TYPES
    # Account states that are billed, and the freeze that is not.
    account_statuses: Sequence[str] = ("Customer", "Frozen", "Partner")
    expired_freeze_reason: str = "TRIAL_EXPIRED"
    # Fixed value: how a product code of a free product begins.
    free_product_prefix: str = "Free"
    status_exempt_types: Sequence[str] = ()
    free_tiers: Sequence[str] = ()
    free_types: Sequence[str] = ()
    legacy_types: Sequence[str] = ()
    excluded_products: Sequence[str] = ()
    window: timedelta = SYNC_WINDOW
    tiebreak: Sequence[str] = ("id",)

    def newest_by(self) -> tuple[str, ...]:
        return ("version", *self.tiebreak)

    def newest_first(self) -> list[Column]:
        return [F.desc_nulls_last(c) for c in self.newest_by()]


# Most lines may have no third party: their rows, which match nothing, are dealt out in joins by it.
NULLS_DEALT = {"third_party_payer_id": HotKeys(nulls=True, splits=1024)}


def skewed(hot: Hot, *columns: str) -> dict[str, HotKeys]:
    """The hot keys that the caller knows; none are looked for."""
    return {c: (hot or {}).get(c, NULLS_DEALT.get(c, NONE_HOT)) for c in columns}
