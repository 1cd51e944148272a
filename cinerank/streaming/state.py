"""Keyed streaming state: each user's last k ratings.

The reference keeps a per-user list in an external key-value store.  Here the
list is Structured Streaming state.  Users are dealt by hash into STATE_GROUPS
groups, and ``groupBy(group).applyInPandasWithState`` folds each micro-batch's ratings
into at most k entries a user (newest by event time, then event id), all users of a group
at once: a call for each user costs more than its ratings.  State is bounded by k entries
a user whatever the user's volume; the group's rows arrive as an iterator of Arrow batches
and are folded chunk by chunk, so a user with a third of a batch never sits whole
in memory.  A replayed event (same id) is ignored, so replays are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cinerank import config
from cinerank.functions.columns import column_type, epoch_micros

STATE_SCHEMA = "uids array<int>, event_ids array<bigint>, ts array<bigint>, mids array<int>, scores array<double>"
OUTPUT_SCHEMA = "uid int, rank int, mid int, score double"
STATE_GROUPS = 4096     # part of a checkpoint's meaning: another number needs a new checkpoint
COLUMNS = (("uid", "int32"), ("event_id", "int64"), ("ts", "int64"), ("mid", "int32"), ("score", "float64"))


def _places(uids: np.ndarray) -> np.ndarray:
    """Position of each entry among those of its user; ``uids`` ascend."""
    return np.arange(len(uids)) - np.searchsorted(uids, uids)


def _fold(k: int):
    def fold(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = [np.asarray(x, t) for x, (_, t) in zip(state.get if state.exists else [[]] * len(COLUMNS), COLUMNS)]
        touched = np.empty(0, "int32")
        for chunk in chunks:
            touched = np.union1d(touched, chunk["uid"].to_numpy("int32"))
            uids, ids, ts, *_ = kept = [np.concatenate([x, chunk[c].to_numpy(t)]) for x, (c, t) in zip(kept, COLUMNS)]
            order = np.lexsort((ids, uids))                    # stable: a replayed id counts once, as first seen
            again = np.r_[False, (np.diff(ids[order]) == 0) & (np.diff(uids[order]) == 0)][:len(order)]
            order = order[~again]
            order = order[np.lexsort((-ids[order], -ts[order], uids[order]))]      # each user's newest first
            order = order[_places(uids[order]) < k]
            kept = [x[order] for x in kept]
        state.update(tuple(x.tolist() for x in kept))
        uids, _, _, mids, scores = kept
        now = np.isin(uids, touched)
        yield pd.DataFrame({"uid": uids[now], "rank": (_places(uids)[now] + 1).astype("int32"), "mid": mids[now], "score": scores[now]})
    return fold


def recent_ratings_state(ratings: DataFrame, k: int = config.RECENT_RATINGS_K) -> DataFrame:
    """Streaming ``uid, rank, mid, score``: the current last-k list of every
    user updated in the micro-batch (output mode ``update``)."""
    micros = epoch_micros("ts", column_type(ratings, "ts"))
    rows = ratings.select(F.pmod(F.xxhash64("uid"), F.lit(STATE_GROUPS)).alias("part"), "uid", "event_id", micros.alias("ts"), "mid", "score")
    return rows.groupBy("part").applyInPandasWithState(
        _fold(k), OUTPUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


def current_lists(spark, path: str) -> DataFrame:
    """Latest list per user from batch-partitioned output."""
    out = spark.read.schema(f"{OUTPUT_SCHEMA}, batch_id long").parquet(path)
    last = out.groupBy("uid").agg(F.max("batch_id").alias("batch_id"))
    return out.join(last, ["uid", "batch_id"]).select("uid", "rank", "mid", "score")
