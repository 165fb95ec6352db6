"""Registry of runnable queries: each key has a Spark builder and, where SQL can say it, an oracle."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.plans import fixtures
from plotloom.session import dealt, held, measured_broadcasts, shuffles, sized_shuffles

#: Tables of a few bytes a row, a file or two, each of whose rows becomes plots with rings, edges and samples. Dealt out by their key.
SPREAD = {"part": "p_partkey", "supplier": "s_suppkey"}

#: Rows of a table that one shuffle partition takes; a part unfolds into some hundred samples, a supplier into thousands of poses.
ROWS = {"part": 5_000, "supplier": 1_000, "customer": 100_000, "orders": 100_000, "lineitem": 100_000, "events": 100_000}

#: Derived from those, cheap as such: what filters make of them (rings, boxes, areas) stays behind the dealing.
HELD = ("lattice_fx", "village_fx")
#: Derivations whose products of integers pass 32 bits on large tables: what they read, and its integers that are 64 bits wide meanwhile.
WIDE = {"village_fx": ("lattice_fx", ("c", "r"))}

_BUILDERS: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


class Inputs:
    """Base tables and their shared derivations, as DataFrames: ``fx.lattice_fx``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}
        measured_broadcasts(spark)
        sized_shuffles(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in fixtures.BASE:
                table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                if name in ROWS:
                    sized_shuffles(self.spark, max(shuffles(self.spark), -(-table.count() // ROWS[name])))     # read from the footers
                self._made[name] = dealt(table, SPREAD[name]) if name in SPREAD else table
            elif name in fixtures.DERIVED:
                derived = self._widely(name) if name in WIDE else self.sql(fixtures.DERIVED[name])
                self._made[name] = held(derived) if name in HELD else derived
            else:
                raise AttributeError(name)
        return self._made[name]

    def _widely(self, name: str) -> DataFrame:
        """The derivation worked out in 64 bits, with the column types it has in 32."""
        source, columns = WIDE[name]
        table = getattr(self, source)
        wide = self.sql(fixtures.DERIVED[name], **{source: table.withColumns({c: F.col(c).cast("bigint") for c in columns})})
        return wide.withColumns({c: F.col(c).cast(table.schema[c].dataType) for c in columns if c in wide.columns})

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        used = fixtures.names_in(text)
        for n in used:
            text = re.sub(rf"\b{n}\b", "{" + n + "}", text)
        return self.spark.sql(text, **{n: given[n] if n in given else getattr(self, n) for n in used})


def query(key: str, sql: str | None = None):
    def keep(fn):
        if key in _BUILDERS:
            raise ValueError(f"duplicate query key {key}")
        _BUILDERS[key] = fn
        if sql is not None:
            _ORACLES[key] = fixtures.with_derivations(sql)
        return fn
    return keep


def _load():
    import importlib
    import pkgutil

    import plotloom.plans as plans
    for m in sorted(x.name for x in pkgutil.iter_modules(plans.__path__) if x.name.startswith("q_")):
        importlib.import_module(f"plotloom.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return {k: bind(fn) for k, fn in _BUILDERS.items()}


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
