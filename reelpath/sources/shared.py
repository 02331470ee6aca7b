"""Frames that several readers share, kept for a while and always released.

A lineage cut (``cut_lineage``) writes a frame to the shared folder and is read
from there for as long as anything refers to it.  A :class:`SharedFrames` scope
keeps frames in the executors' memory and disk instead, for the duration of a
``with`` block::

    with SharedFrames() as shared:
        train = shared.keep(roll_up(rows))
        result = cut_lineage(report(train, train))

Leaving the block releases every frame, in the reverse order and whether the
block ended well or not, so a failing query leaves no cached block behind.
Whatever is to outlive the block must be computed inside it.  A kept block that
is lost with its executor is computed again from its lineage.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class SharedFrames:
    """A scope of persisted frames with guaranteed release."""

    def __init__(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.level = level
        self._kept: list[DataFrame] = []
        self._open = False

    def __enter__(self) -> "SharedFrames":
        self._open = True
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """Persist ``df`` until the scope ends; a frame that is cached already,
        by whomever, is left to its owner."""
        if not self._open:
            raise RuntimeError("a frame is kept inside the scope's with block only")
        if not df.is_cached and df.storageLevel == StorageLevel.NONE:
            self._kept.append(df.persist(self.level))
        return df

    @property
    def kept(self) -> int:
        return len(self._kept)

    def __exit__(self, kind, error, trace) -> None:
        self._open = False
        first: Exception | None = None
        while self._kept:
            try:
                self._kept.pop().unpersist(blocking=True)
            except Exception as e:  # noqa: BLE001 -- the others are released all the same
                first = first or e
        if first is not None and error is None:
            raise first
