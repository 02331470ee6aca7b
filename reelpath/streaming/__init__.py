"""Streaming form of the daily roll-up.

The reference is batch-only (daily Parquet logs).  The one operator that is
naturally incremental -- the per-(user, item, day) playtime roll-up (A1) --
is offered as a Structured Streaming job in :mod:`reelpath.streaming.rollup`.
"""
