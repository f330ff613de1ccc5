"""Continuous aggregates and stateful review."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from catalith.operators.review import STATES, TRANSITIONS

# Rows of one emitted frame.
FRAME = 10_000

# Python workers receive these helpers by value (no installed copy needed).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def queue_progress_stream(results: DataFrame, queue: str = "queue", status: str = "status") -> DataFrame:
    """Running count per queue and status (update mode)."""
    return results.groupBy(queue, status).agg(F.count(F.lit(1)).alias("processed"))


def windowed_progress(results: DataFrame, ts: str, status: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts per time window; rows later than the watermark no longer count."""
    return results.withWatermark(ts, late).groupBy(F.window(ts, width), status).agg(
        F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), status, "n")


def dedupe_cache(stream: DataFrame, ts: str, key: str, ttl: str = "24 hours") -> DataFrame:
    """First row of each key within the cache lifetime; older keys leave the state."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


def review_state_stream(events: DataFrame, initial: str = "proposed", ttl_ms: int | None = None) -> DataFrame:
    """Stateful review: every event with its state before, after and acceptance.

    ``events(proposal_id, seq, to_state)``.  The state of a proposal is one word and its last ``seq``, so it stays
    small however many events a proposal gets.  The events a trigger brings for a proposal are put in order as a
    whole, over all Arrow frames; the source's trigger limits bound their number.  An event that is not after the
    last one of its proposal (a null ``seq`` included) came too late: it is rejected with ``late``.  After ``ttl_ms``
    without events a proposal still in ``initial`` is forgotten; any other state, such as an approval, is kept.
    """
    names = list(STATES)
    step = [{to: names.index(to) for to in TRANSITIONS[a]} for a in names]

    def ordered(frames: list[pd.DataFrame]) -> tuple:
        """Numbers in order, None last, and their states; most proposals come as one frame of whole numbers."""
        if len(frames) == 1 and frames[0]["seq"].dtype == "int64":
            seq, to = frames[0]["seq"].to_numpy(), frames[0]["to_state"].to_numpy(dtype=object)
            at = seq.argsort(kind="stable")
            return seq[at].tolist(), to[at]
        rows = pd.concat(frames, ignore_index=True).astype({"seq": "Int64"}).sort_values("seq", kind="stable", na_position="last")
        return rows["seq"].astype(object).where(rows["seq"].notna(), None).tolist(), rows["to_state"].to_numpy(dtype=object)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, last = state.get if state.exists else (initial, None)
        if state.hasTimedOut:
            if now == initial:
                state.remove()
            return
        frames = [f for f in frames if len(f)]
        seqs, states = ordered(frames) if frames else ([], [])
        now = names.index(now)
        for at in range(0, len(seqs), FRAME):
            part, told, codes = seqs[at:at + FRAME], states[at:at + FRAME], []
            for seq, to in zip(part, told, strict=True):
                before, late = now, seq is None or (last is not None and seq <= last)
                if not late:
                    now, last = step[now].get(to, now), seq
                codes.append(before << 8 | now << 1 | late)
            yield pd.DataFrame({"proposal_id": key[0], "seq": part if part[-1] is not None else pd.array(part, dtype="Int64"),
                                "to_state": told, "code": codes}, copy=False)
        state.update((names[now], last))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)

    kind = dict(events.dtypes)["proposal_id"]
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    # A frame of four columns for each proposal: the codes become words and flags in the JVM.
    out = events.select("proposal_id", "seq", "to_state").groupBy("proposal_id").applyInPandasWithState(
        run, f"proposal_id {kind}, seq long, to_state string, code int", "state string, last long", "append", timeout)
    before, after = F.shiftright("code", 8), F.shiftright("code", 1).bitwiseAND(F.lit(127))
    return out.select("proposal_id", "seq", "to_state", F.get(F.lit(names), before).alias("state_before"), F.get(F.lit(names), after).alias("state_after"),
                      (before != after).alias("accepted"), (F.col("code") % 2 == 1).alias("late"))
