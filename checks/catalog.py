"""Registry of queries and their oracles."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.sql import standalone
from checks.fixtures import table
from spendlens.streaming.sinks import CHECKPOINT_DIR, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
BUILDS: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

#: What the plan of a query may hold that others must not: "python" (a caller's scorer, or a
#: fold in order), "daily window" (a window without key, over one row per day), "writes"
#: (building the query stores something first).
TRAITS: dict[str, frozenset[str]] = {}


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder for one run in the shared folder of the session.

    A session on one machine may name none and gets a temporary one; on a cluster the
    executors could not read it, so there a missing setting is an error.
    """
    if not spark.conf.get(CHECKPOINT_DIR, None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="spendlens-"))
    return shared_folder(spark, name)


class Inputs:
    """Tables of one data folder, loaded when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def __getitem__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None, extra: str = "", traits: tuple[str, ...] = ()):
    """Register a query; the oracle gets the views it names as CTEs."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        BUILDS[name] = build
        TRAITS[name] = frozenset(traits)
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = standalone(oracle, extra)
        return build

    return register
