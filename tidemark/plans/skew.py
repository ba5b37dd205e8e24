"""Sizing decisions that need a look at the data before the plan is fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import pages
from tidemark.sources.scratch import written

SESSION_QUOTA = 1_000_000
BROADCAST_ROWS = 200_000


def measured_hot_sessions(
    events: DataFrame, quota: int = SESSION_QUOTA, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame | None:
    """Sessions to cut into pieces, or None where every session fits a task.

    No more events than the quota cannot hold a hot session, so these are not counted by
    session. Otherwise there is one narrow counting pass over the events, and a second one
    over the hot sessions where there are any. What they find is written out, so that the
    plans that use it do not count again. It is broadcast only when it was counted to fit;
    a longer list is joined by shuffle. ``quota`` and ``broadcast_rows`` only change the
    plan, never the result.
    """
    if events.limit(quota + 1).count() <= quota:
        return None
    counted = pages.hot_sessions(events, quota)
    if counted.isEmpty():
        return None
    hot = written(counted, "hot-sessions")
    found = hot.limit(broadcast_rows + 1).count()
    small = F.broadcast(hot) if found <= broadcast_rows else hot
    moments = written(pages.hot_moments(events, small, quota), "hot-moments")
    # A session's list of moments is part of its row, so both counts matter.
    found = max(found, moments.limit(broadcast_rows + 1).count())
    listed = written(pages.with_moments(hot, moments), "hot-list")
    return F.broadcast(listed) if found <= broadcast_rows else listed
