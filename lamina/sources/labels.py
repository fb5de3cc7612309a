"""Names of feeds and where their exports go."""

from __future__ import annotations

import logging

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

COMBINED = "_combined"

#: Each feed's name and its other spellings.
SPELLINGS = {
    "firm": ("firm", "firms", "gtran_firm"),
    "interruptible": ("it", "interruptible", "interruptibles", "gtran_it"),
    "awards": ("award", "awards"),
    "ioc": ("ioc",),
    "index": ("index", "gindex"),
    COMBINED: ("final", "finals", "combined", COMBINED),
}
FEEDS = tuple(f for f in SPELLINGS if f != COMBINED)
_NAME = {s: feed for feed, all_of in SPELLINGS.items() for s in all_of}


def feed_name(label: str | None) -> str:
    """The feed that a spelling means; whatever is unknown or empty counts as spanning feeds."""
    if not label:
        return COMBINED
    name = _NAME.get(str(label).strip().lower())
    if name is None:
        log.warning("unknown feed %r counts as %s", label, COMBINED)
    return name or COMBINED


def feed_name_of(label: Column) -> Column:
    """feed_name() of a column of labels."""
    known = F.create_map(*[F.lit(x) for pair in _NAME.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(label))), F.lit(COMBINED))


def spellings(feed: str) -> tuple[str, ...]:
    return tuple(sorted({*SPELLINGS[feed_name(feed)], feed_name(feed)}))
