"""The resource state machine over a stream of fetches, with state kept for each URL."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import vocab as V

OUT, STATE = "url_id long, state string, misses long, seen long", "state string, misses long, seen long"


def step(state: str, misses: int, observation: str) -> tuple[str, int]:
    """As decisions.next_state(), for one observation."""
    if state == "moved":
        return state, misses
    if observation == "alive":
        return "active", 0
    if observation == "gone":
        return "deleted", misses + 1
    if observation in ("not_found", "soft_404_title", "soft_404_known_title", "top_redirect"):
        return "deleted" if state == "deleted" or misses + 1 >= V.NOT_FOUND_LIMIT else "deletion_candidate", misses + 1
    return state, misses


def _update(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
    state, misses, seen = kept.get if kept.exists else ("active", 0, 0)
    rows = pd.concat(list(frames)).sort_values(["fetched_at", "event_id"])  # one URL's rows of one micro-batch
    for ob in rows["ob"]:
        state, misses = step(state, misses, ob)
        seen += 1
    kept.update((state, misses, seen))
    yield pd.DataFrame({"url_id": [key[0]], "state": [state], "misses": [misses], "seen": [seen]})


def resource_states(observations: DataFrame) -> DataFrame:
    """Updates of (url_id, state, misses, seen) from a stream of (url_id, fetched_at, event_id, ob)."""
    return observations.groupBy("url_id").applyInPandasWithState(_update, OUT, STATE, "update", GroupStateTimeout.NoTimeout)
