"""What an installation's own codes mean to the reports.  The library has no codes of its
own: the jobs take these rules as arguments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class DailyRules:
    """Inventory name (N10) and area code of the daily summary."""
    target_id: str                  # the target whose app bundle names the inventory
    area_media: str                 # the medium whose rows carry an area code
    app_media: tuple[str, ...]      # media whose app id names the inventory
    test_media: str                 # the medium whose inventory is called test


@dataclass(frozen=True)
class ReachRules:
    """Media of the exchange feed that the reach reports read, and their inventories."""
    media: tuple[str, ...]          # whose views count as reach
    daily_media: str                # whose rows of the day are reported
    app_media: tuple[str, ...]
    test_media: str
    group_inventory: Mapping[int, str] = field(default_factory=dict)    # named by ad group, before anything else
