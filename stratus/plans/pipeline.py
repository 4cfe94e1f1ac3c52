"""One hourly run end to end, as written tables: raw -> staging -> dims -> link -> facts -> marts -> checks.

Layout under ``root`` (a folder in the shared storage):
* staging, facts and mart states of each kind: keyed logs that a run appends what it touches to (``gold``); the
  forecast's keys hold the run id (version history), and a later run replaces a key whatever its load stamps say;
* dims, link and bridge: rebuilt each run (as the reference rebuilds them), each in a fresh folder;
  ``RunResult.paths`` names the folders;
* ``quality_failures``: failing rows of every suite and declared column test, partitioned by check name (warn only).
  A run checks the rows it wrote, and the dimensions whole.

Facts and marts after a run equal a full build from staging and the dimensions of that run, also after areas or
stations left, were renumbered or moved.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import mart_state
from stratus.operators import quality as Q
from stratus.operators.incremental import write_fresh
from stratus.plans import models
from stratus.plans.gold import HOUR_KEYS, Gold
from stratus.session import materialize, side_by_side
from stratus.sources.landing import land_responses, station_scope
from stratus.sources.raw_tables import materialize_view

__all__ = ["HOUR_KEYS", "RunResult", "failures_now", "hourly_ingest", "hourly_run"]


@dataclass
class RunResult:
    run: int
    tables: dict
    paths: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)  # of a run from documents: kind -> rows by where they went


def hourly_run(spark: SparkSession, root: str, run: int, raw_observed: DataFrame, raw_forecast: DataFrame,
               station_raw: DataFrame, postal_raw: DataFrame, as_of: str,
               station_pattern: str | None = None, previous: RunResult | None = None, checks: bool = True,
               keep_failures: bool = False) -> RunResult:
    """``station_pattern``: the run's station scope (a LIKE pattern on the lower-cased name; None = all
    stations); raw rows of other stations are not taken into this run. ``previous``: no longer needed, what a run has to
    know of the one before lies under ``root``. ``checks``: store the failures of the run's rows. ``keep_failures``: keep
    what fails now in staging, facts and marts too (in every run, or in none), for ``failures_now``."""
    t, paths = {}, {}
    raw = {"observed": raw_observed, "forecast": raw_forecast.drop("batch_id")}
    if station_pattern is not None:
        scope = station_scope(station_raw, station_pattern)
        raw = {kind: df.join(scope, "wmo_station_id", "left_semi") for kind, df in raw.items()}

    def table(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_fresh(df, f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(paths[name])

    # dimensions and the link: full rebuilds, each written once and read back by the later layers
    stg_station, stg_area = models.stg_station(station_raw), models.stg_postal_area(postal_raw)
    dim_st = table("dim_station", models.dim_station(stg_station))
    dim_area = table("dim_postal_area", models.dim_postal_area(stg_area))
    link = table("fact_link_postcode_station", models.link_postcode_station(dim_area, dim_st, as_of=as_of,
                                                                            materialize_inputs=False))
    bridge = table("bridge", models.area_bridge(dim_st, link, dim_area))
    t.update({"raw_observed": raw["observed"], "raw_forecast": raw["forecast"], "station_raw": station_raw,
              "postal_raw": postal_raw, "stg_station": materialize_view(stg_station, "stg_dim_station"),
              "stg_postal_area": stg_area, "dim_station": dim_st, "dim_postal_area": dim_area, "link": link})

    def advance(kind: str) -> tuple[Gold, DataFrame, dict]:
        gold = Gold(spark, root, kind)
        batch = models.stg_weather(raw[kind], kind, since=gold.loads(run))
        if kind == "forecast":
            batch = batch.withColumn("batch_id", F.lit(run).cast("long"))
        batch = materialize(batch, "stg_batch")
        wrote = gold.advance(batch, run, bridge)
        if keep_failures:
            for kept in gold.kept_failures().values():
                kept.follow(run)
        return gold, batch, wrote

    own = dict(t)  # what this run wrote
    kinds = ("observed", "forecast")
    for kind, (gold, batch, wrote) in zip(kinds, side_by_side(spark, *(partial(advance, kind) for kind in kinds))):
        own |= {f"stg_{kind}": batch, f"fact_{kind}": wrote["facts"], f"mart_{kind}": mart_state.finish(wrote["states"])}
        for name, now, empty in (("stg", gold.staged(), batch), ("fact", gold.fact(), wrote["facts"]),
                                 ("mart", gold.mart(), own[f"mart_{kind}"])):
            t[f"{name}_{kind}"] = now if now is not None else empty.limit(0)
    if checks:  # warn only, failures stored per check
        paths["quality_failures"] = f"{root}/quality_failures/run={run}"
        failures = Q.all_failures(own, as_of)
        Q.store_failures(failures, paths["quality_failures"])
        t["quality_failures"] = Q.read_failures(failures, paths["quality_failures"])
    return RunResult(run, t, paths)


def failures_now(spark: SparkSession, root: str, t: dict[str, DataFrame]) -> DataFrame:
    """``suite, check_name, key1, key2``: all rows of staging, facts and marts that fail a check after the last run, as
    the runs kept them, and those of the dimensions and the link of its tables ``t``, which are asked whole. Equal to
    a scan of all tables. The integrity suite, which moves with the clock, is asked by ``quality.integrity_suite``."""
    out = Q.dimension_failures(t)
    for kind in ("observed", "forecast"):
        for table, kept in Gold(spark, root, kind).kept_failures().items():
            found = kept.failures()
            if found is not None:
                k1, k2 = Q.KEY_COLUMNS[table]
                out = out.unionByName(found.select("suite", "check_name", F.col(k1).cast("string").alias("key1"),
                                                   F.col(k2).cast("string").alias("key2")))
    return out


def hourly_ingest(spark: SparkSession, root: str, run: int, observed_docs: DataFrame, forecast_docs: DataFrame,
                  station_raw: DataFrame, postal_raw: DataFrame, as_of: str, load_dts: str, **options) -> RunResult:
    """An hourly run from response documents (a ``value`` column each). Every element of a document becomes a raw row or lands in the
    side table ``set_aside_<kind>`` with its reason; ``counts`` has the rows of each way, as the landing write counted them.
    ``options`` are those of ``hourly_run``."""
    landed = {kind: land_responses(docs, f"{root}/landed_{kind}", load_dts)
              for kind, docs in (("observed", observed_docs), ("forecast", forecast_docs))}
    res = hourly_run(spark, root, run, landed["observed"].accepted, landed["forecast"].accepted, station_raw, postal_raw,
                     as_of, **options)
    for kind, batch in landed.items():
        res.tables[f"set_aside_{kind}"], res.paths[f"landed_{kind}"], res.counts[kind] = batch.set_aside, batch.path, batch.counts
    return res
