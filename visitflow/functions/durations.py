"""Visit durations from check-in, rooming, visit-end and checkout stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitflow.functions.stamps import minutes_between


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def earliest_after(anchor, *candidates) -> Column:
    """Earliest candidate at or after the anchor; null when none qualifies."""
    anchor = _col(anchor)
    valid = [F.when(_col(c) >= anchor, _col(c)) for c in candidates]
    return F.least(*valid) if len(valid) > 1 else valid[0]


def time_to_room(check_in, *room_stamps) -> Column:
    return minutes_between(check_in, earliest_after(check_in, *room_stamps))


def time_in_room(roomed, visit_end, checkout) -> Column:
    """Minutes from rooming to whichever of visit end and checkout comes first, both after rooming."""
    roomed, visit_end, checkout = _col(roomed), _col(visit_end), _col(checkout)
    ended_first = checkout.isNull() | (visit_end <= checkout)
    left_first = visit_end.isNull() | (checkout < visit_end)
    end = F.when((visit_end >= roomed) & ended_first, visit_end).when(
        (checkout >= roomed) & left_first, checkout
    )
    return minutes_between(roomed, end)


def cycle_time(check_in, visit_end, checkout) -> Column:
    """Minutes from check-in to visit end, or to checkout where that is the usable earlier stamp."""
    check_in, visit_end, checkout = _col(check_in), _col(visit_end), _col(checkout)
    checkout_unusable = checkout.isNull() | (checkout < check_in) | (visit_end <= checkout)
    end = F.when((visit_end >= check_in) & checkout_unusable, visit_end).when(
        checkout >= check_in, checkout
    )
    return minutes_between(check_in, end)
