"""reelpath: a Spark-native viewing-analytics and recommendation workbench.

Every operator is a plain ``DataFrame -> DataFrame`` function built on the
DataFrame/SQL API and ``pyspark.ml``.  Operators never collect data to the
driver; statistics travel as one-row frames that are joined back.

Sub-packages
------------
``sources``    scans of daily logs, fixture views, table bundles (sinks)
``functions``  reusable column expressions (labels, decay, flags, vectors)
``operators``  the inventory: cleaning, interactions, scoring, indexing,
               recommendation, vectors, features, search rules, evaluation,
               diagnostics
``plans``      named end-to-end queries over the provided tables and their
               DuckDB oracle twins
``streaming``  incremental form of the daily playtime roll-up
"""

from reelpath.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
