"""Sinks, lineage cuts and table bundles.

Everything is written under the shared checkpoint folder of the session
(``spark.checkpoint.dir``) or a caller-given shared path -- never a
machine-local folder -- so a lost executor only costs a task retry and the
files are readable from every node.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from reelpath.session import checkpoint_root


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet overwrite sink (optionally partitioned, e.g. by ``day``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder.

    The returned frame's plan starts at the checkpoint files: later stages and
    task retries never recompute the upstream shuffles, and Spark's cleaner
    removes the files once nothing refers to the frame."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def save_bundle(tables: dict[str, DataFrame | None], folder: str) -> list[str]:
    """Write each named table to ``folder/name``; ``None`` entries are
    skipped.  Returns the names written."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        write_table(df, f"{folder.rstrip('/')}/{name}")
        written.append(name)
    return written


def load_bundle(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Read the named tables back; fails as a unit if any is missing."""
    out = {}
    try:
        for name in names:
            out[name] = spark.read.parquet(f"{folder.rstrip('/')}/{name}")
    except Exception as e:  # noqa: BLE001
        raise RuntimeError(f"bundle at {folder} is incomplete: {name} missing") from e
    return out


def save_model_bundle(model: ALSModel, raw: DataFrame | None, novel: DataFrame | None,
                      folder: str) -> None:
    """ALS model + raw top-N + novel top-k."""
    base = folder.rstrip("/")
    model.write().overwrite().save(f"{base}/als_model")
    save_bundle({"als_raw": raw, "als_novel": novel}, base)


def load_model_bundle(spark: SparkSession, folder: str) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Inverse of :func:`save_model_bundle`."""
    base = folder.rstrip("/")
    model = ALSModel.load(f"{base}/als_model")
    t = load_bundle(spark, base, ["als_raw", "als_novel"])
    return model, t["als_raw"], t["als_novel"]


def export_sample_csv(df: DataFrame, path: str, fraction: float = 0.001, n: int = 100,
                      seed: int = 42) -> str:
    """A sample of the rows, capped at ``n`` (the feature: a small
    human-readable extract), written as CSV with a header.

    A row is in when the md5 of its values and the seed falls under
    ``fraction``, so the extract is the same on any cluster; of more than ``n``
    the smallest hashes stay."""
    from reelpath.operators.features import sample_rows
    sample_rows(df, fraction, seed).orderBy("_h", *df.columns).limit(n).drop("_h").write.mode("overwrite").option(
        "header", "true").csv(path)
    return path
