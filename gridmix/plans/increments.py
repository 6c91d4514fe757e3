"""Daily increment and backfill: bronze -> silver -> quality gate -> models -> published marts, for a range of
days and all or some countries.  One Spark job per step covers all countries; nothing outside the range and the countries is
read or changed.

Every run writes each model once, into the folders of a ``sinks.versions.Store``.  Publishing is one version of its
manifest: it names the run's slices (day, country), and all other slices stay those of earlier runs.  What a gate says of a slice
decides whether it is named: ``hold`` leaves slices that fail a check out, with their reasons in ``held_back``, and
publishes the others; ``stop`` publishes nothing then."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import dims, session, sinks
from gridmix import functions as gf
from gridmix import operators as ops
from gridmix.operators import quality as dq
from gridmix.plans import reports
from gridmix.plans.catalog import ORACLE, query
from gridmix.sinks.versions import SLICE, Store, matching, new_run
from gridmix.sources import cube, load_gen_raw, load_weather_raw, weather
from gridmix.sources import xml as bx
from gridmix.verify import oracle as o


def _day(ts_ns: str = "timestamp") -> Column:
    return F.to_date(gf.epoch_ns_to_ts(ts_ns))


def within(df: DataFrame, day: Column, start=None, end=None, countries: list[str] | str = "ALL",
           country: str = "country") -> DataFrame:
    """Rows of [start, end] (dates, inclusive) and of the countries.  On a partition column this prunes files, in silver tables
    those of other months."""
    for bound, keep in ((start, lambda d, b: d >= b), (end, lambda d, b: d <= b)):
        if bound is not None:
            bound = bound if isinstance(bound, Column) else F.lit(bound).cast("date")
            df = df.where(keep(day, bound))
            if sinks.MONTH in df.columns:
                df = df.where(keep(F.col(sinks.MONTH), F.trunc(bound, "month")))
    return df if countries == "ALL" else df.where(F.col(country).isin(list(countries)))


def ingest(raw: DataFrame, silver_path: str, start=None, end=None, countries: list[str] | str = "ALL") -> None:
    """Write raw rows in the silver layout to the silver table; only the touched slices are replaced."""
    sinks.write_silver_generation(within(raw, _day(), start, end, countries), silver_path)


def ingest_weather(raw: DataFrame, silver_path: str, start=None, end=None, countries: list[str] | str = "ALL") -> None:
    """Weather rows as delivered -> silver weather (renamed, typed, bad rows dropped) of the range."""
    sinks.write_silver_weather(within(weather.to_silver_weather(raw), _day(), start, end, countries), silver_path)


@dataclass
class Layout:
    """Folders of a deployment."""

    base: str
    paths: dict[str, str] = field(default_factory=dict)

    def __getattr__(self, name: str) -> str:
        return self.paths.get(name, f"{self.base}/{name}")


# --- slices ---------------------------------------------------------------------------------------

def _narrow(start, end, countries):
    return lambda df: within(df, F.col("date_key"), start, end, countries, "country_code")


# --- bronze -> silver -----------------------------------------------------------------------------

REJECTS = ["path", "country_code", "domain", "reason", "n", "date_key"]


def bronze_digests(spark: SparkSession, at: Layout, start=None, end=None, countries="ALL") -> DataFrame:
    """(date_key, country_code, domain, digest): what the documents and cubes of each slice hold, by content.  A
    slice's documents are few (a document holds up to 100,000 points), its cubes one per variable and hour."""
    parts = []
    if session.exists(spark, at.documents):
        docs = within(bx.read_documents(spark, at.documents, start, end), F.col("date"), start, end, countries)
        parts.append(docs.select(F.col("date").alias("date_key"), F.col("country").alias("country_code"), "domain",
                                 F.sha2("xml", 256).alias("one")))
    if session.exists(spark, at.cubes):
        cubes = within(spark.read.parquet(at.cubes), F.col("date"), start, end, countries)
        content = F.to_json(F.struct("variable", "time", "lat", "lon", "values"))
        parts.append(cubes.select(F.col("date").alias("date_key"), F.col("country").alias("country_code"),
                                  F.lit("weather").alias("domain"), F.sha2(content, 256).alias("one")))
    each = reduce(DataFrame.unionByName, parts)
    return each.groupBy(*SLICE, "domain").agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("one"))), 256).alias("digest"))


def changed_slices(spark: SparkSession, at: Layout, store: Store, start=None, end=None, countries="ALL",
                   now: DataFrame | None = None) -> DataFrame:
    """The slices and domains of the range whose content isn't what the last published run read (its ledger,
    ``bronze_digests``): new ones, and those with another digest.  ``now`` are digests that were taken already."""
    now = bronze_digests(spark, at, start, end, countries) if now is None else now
    if not store.has("bronze_digests"):
        return now
    seen = store.read("bronze_digests", within=_narrow(start, end, countries))
    return matching(now, seen, [*SLICE, "domain", "digest"], "left_anti")


def _span(changed: DataFrame, start, end) -> tuple:
    """The days from the first changed slice to the last, or the range where slices without a day are among them."""
    days = changed.agg(F.min("date_key").alias("first"), F.max("date_key").alias("last"),
                       (F.count(F.lit(1)) > F.count("date_key")).alias("undated")).first()
    return (start, end) if days["undated"] or days["first"] is None else (days["first"], days["last"])


def _as_slices(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"date": "date_key", "country": "country_code"})


def bronze_to_silver(spark: SparkSession, at: Layout, start=None, end=None, countries="ALL",
                     changed: DataFrame | None = None) -> DataFrame:
    """Documents of the range (of the ``changed`` slices and domains, if given) -> silver generation.  Each document is
    decoded once; what is left out is published as ``rejects`` of its slice, which replace the slice's earlier ones, also
    with none.  Returns the rejects of the range."""
    store, run, narrow = Store(spark, at.warehouse), new_run(), _narrow(start, end, countries)
    first, last = (start, end) if changed is None else _span(changed, start, end)
    docs = narrow(_as_slices(bx.read_documents(spark, at.documents, first, last)))
    if changed is not None:
        docs = matching(within(docs, F.col("date_key"), first, last), changed, [*SLICE, "domain"])
    read = session.materialize(bx.read_through(docs), "decoded")
    left_out = read.where("n > 0").select(*REJECTS)
    if changed is not None and store.has("rejects"):  # a slice's rejects are of all its domains: those not read now stay
        before = matching(store.read("rejects", within=narrow), changed)
        left_out = left_out.unionByName(matching(before, changed, [*SLICE, "domain"], "left_anti").select(*REJECTS))
    new = store.slices("rejects", store.write("rejects", run, left_out))
    old = matching(store.current("rejects"), read.select(*SLICE).distinct())
    store.commit(_placed(new, run).unionByName(_taken(matching(old, new, how="left_anti"))))
    series = read.where("TimeSeries is not null").select(
        F.col("country_code").alias("country"), "domain", "date_key", F.explode("TimeSeries").alias("series"))
    rows = [bx.to_silver_generation(bx.flatten_series(series.where(F.col("domain") == kind), kind))
            for kind in ("generation", "forecast")]
    silver = within(bx.union_generation(*rows), _day(), start, end, countries)
    if changed is not None:  # rows that a changed document has for another day's slice would replace that slice
        own = changed.withColumnRenamed("country_code", "country")
        silver = matching(silver.withColumn("date_key", _day()), own, ["date_key", "country", "domain"]).drop("date_key")
    sinks.write_silver_generation(silver, at.silver_generation)
    return rejected(spark, at, start, end, countries)


def rejected(spark: SparkSession, at: Layout, start=None, end=None, countries="ALL") -> DataFrame:
    """(path, country, domain, reason, n, date): what was left out of the documents of the range."""
    found = Store(spark, at.warehouse).read("rejects", within=_narrow(start, end, countries))
    return found.select(*REJECTS).withColumnsRenamed({"date_key": "date", "country_code": "country"})


def weather_to_silver(spark: SparkSession, at: Layout, start=None, end=None, countries="ALL",
                      changed: DataFrame | None = None) -> None:
    """Cubes of the range (of the ``changed`` slices, if given) -> silver weather."""
    cubes = within(spark.read.parquet(at.cubes), F.col("date"), start, end, countries)
    if changed is not None:
        some = changed.where("domain = 'weather'").withColumnsRenamed({"date_key": "date", "country_code": "country"})
        cubes = matching(cubes, some, ["date", "country"])
    ingest_weather(cube.flatten_cube(cubes), at.silver_weather, start, end, countries)


# --- models ---------------------------------------------------------------------------------------

@dataclass
class Models:
    """The models of a range of days, each written once and read by the checks and by the publishing."""

    stg: DataFrame
    daily: DataFrame
    kpi: DataFrame
    hourly: DataFrame
    intensity: DataFrame
    weather: DataFrame | None = None
    wind: DataFrame | None = None
    solar: DataFrame | None = None
    #: Source -> its rows without a time, which no day's slice holds.
    undated: dict[str, DataFrame] = field(default_factory=dict)
    #: Row tests, counted while the models were written.
    observed: dq.Observed = field(default_factory=dq.Observed)


TABLES = {"int_daily_generation": "daily", "fct_renewable_kpi": "kpi", "int_carbon_intensity": "hourly",
          "daily_intensity": "intensity", "int_generation_weather": "weather"}
#: Published name -> the model that its tests are declared for.
_TESTED = {"daily_intensity": "fct_grid_carbon_intensity"}


def build(spark: SparkSession, silver_path: str, weather_path: str | None = None, start=None, end=None,
          countries="ALL", store: Store | None = None, run: str | None = None, slices: DataFrame | None = None) -> Models:
    """Staging and models over the silver days of the range (``date`` prunes the partitions), or over some of its
    ``slices``.  With a ``store`` each model is written to its place there; without one to a scratch folder."""
    from gridmix.plans.quality_checks import row_checks

    seen = dq.Observed()

    def put(name: str, df: DataFrame) -> DataFrame:
        tested = _TESTED.get(name, name)
        df = seen.watch(df, row_checks(tested, df))
        return store.write(name, run, df) if store is not None and name in TABLES else session.materialize(df, name)

    def silver_days(df: DataFrame) -> DataFrame:
        df = within(df, F.col("date"), start, end, countries)
        if slices is not None:
            some = slices.withColumnsRenamed({"date_key": "date", "country_code": "country"})
            df = matching(df, some, ["date", "country"])
        return df

    def undated(df: DataFrame) -> DataFrame:
        return df.where("date is null").select(F.lit(None).cast("date").alias("date_key"), F.col("country").alias("country_code"))

    generation = sinks.read_silver_generation(spark, silver_path)
    lost = {"raw_entsoe_generation": undated(generation)}
    stg = put("stg_generation", ops.stg_generation(silver_days(generation).drop("date")))

    def shares():
        daily = put("int_daily_generation", ops.int_daily_generation(stg))
        return daily, put("fct_renewable_kpi", ops.fct_renewable_kpi(daily))

    def emissions():
        hourly = put("int_carbon_intensity", ops.int_carbon_intensity(stg, dims.dim_energy_source(spark)))
        return hourly, put("daily_intensity", ops.daily_intensity(hourly))

    def with_weather():
        if weather_path is None:
            return None, None, None
        raw = sinks.read_silver_weather(spark, weather_path)
        lost["raw_era5_weather"] = undated(raw)
        cells = ops.weather_cells(silver_days(raw).drop("date"))
        tests = [dq.row_check(c.name, name, cells, F.col(flag) & F.expr(test)) for name, flag in
                 (("stg_wind", "has_wind"), ("stg_solar", "has_solar"))
                 for c, test in zip(row_checks(name, cells), ("ts_hour is null", "country is null"))]
        cells = session.materialize(seen.watch(cells, tests), "cells")
        return (put("int_generation_weather", ops.int_generation_weather(stg, ops.hourly_weather(cells))),
                ops.stg_wind(None, cells), ops.stg_solar(None, cells))

    (daily, kpi), (hourly, intensity), (joined, wind, solar) = session.together(spark, shares, emissions, with_weather)
    return Models(stg, daily, kpi, hourly, intensity, joined, wind, solar, lost, seen)


def key_integrity_checks(m: Models) -> list:
    """Keys present and unique: without these, models are wrong whatever the values."""
    return [
        dq.row_check("not_null_ts_hour", "stg_generation", m.stg, F.col("ts_hour").isNull()),
        dq.Check("unique_hour_country_source", "stg_generation",
                 dq.unique_combination(m.stg, ["country_code", "ts_hour", "energy_source"])),
        dq.Check("unique_day_country", "fct_renewable_kpi", dq.unique_combination(m.kpi, ["country_code", "date_key"])),
    ]


def declared_checks(m: Models) -> list:
    """All declared tests of error severity, of the sources, of staging and of the models: the gate's default."""
    from gridmix.plans.quality_checks import model_checks

    return model_checks(m)


def counted(m: Models, checks: list) -> list[tuple[str, str, str, int]]:
    """(check, model, severity, failures): row tests from what was counted in the writes, the others in one job."""
    known = {(c, model): row for row in m.observed.counts() for c, model in [row[:2]]}
    rows = [known[c.name, c.model] for c in checks if (c.name, c.model) in known]
    rest = [c for c in checks if (c.name, c.model) not in known]
    if rest:
        rows += [(r["check"], r["model"], r["severity"], r["failures"]) for r in dq.summary(rest).collect()]  # a row per check
    return rows


# --- publishing -----------------------------------------------------------------------------------

def _placed(slices: DataFrame, run: str) -> DataFrame:
    return slices.select("table", *SLICE, F.lit(run).alias("run"), "rows")


def _taken(slices: DataFrame) -> DataFrame:
    return slices.select("table", *SLICE, F.lit(None).cast("string").alias("run"), F.lit(0).cast("long").alias("rows"))


HELD = "held_back"
COUNTS = "cleanest_hour_days"


def cleanest_hours(store: Store, run: str, new: DataFrame, days: DataFrame, narrow) -> DataFrame:
    """(country_code, cleanest_hour_of_day, days, date_key), days by their cleanest hour, of the countries that a run
    touches: what was counted before, with the run's ``days`` added and those that they replace taken away.  Reads
    these days alone, however long the history is.  ``date_key`` is null: a country's counts are one slice."""
    def of(df: DataFrame, each) -> DataFrame:
        return df.select("country_code", F.col("cleanest_hour_of_day").cast("long").alias("cleanest_hour_of_day"),
                         F.lit(each).cast("long").alias("days") if isinstance(each, int) else each)

    parts = [of(matching(new, days), 1)]
    if store.has(COUNTS):
        replaced = store.read("daily_intensity", within=lambda df: matching(narrow(df), days))
        parts += [of(replaced, -1), of(matching(store.read(COUNTS), days, ["country_code"]), "days")]
    counts = reduce(DataFrame.unionByName, parts).groupBy("country_code", "cleanest_hour_of_day").agg(F.sum("days").alias("days"))
    return store.write(COUNTS, run, counts.where("days > 0").withColumn("date_key", F.lit(None).cast("date")))


def publish(models: Models, store: Store, run: str, start=None, end=None, countries="ALL", held: DataFrame | None = None,
            digests: DataFrame | None = None, slices: DataFrame | None = None) -> int:
    """One version that puts the run's slices in place, but for those in ``held`` (slice, check, model, failures).

    Slices of the range and countries (or of ``slices``) that the run neither built nor held back are taken away: their
    silver rows are gone.  All others stay.  Returns the version."""
    narrow = _narrow(start, end, countries)

    def covered(df: DataFrame) -> DataFrame:
        return narrow(df) if slices is None else matching(narrow(df), slices)

    tables = {name: getattr(models, attribute) for name, attribute in TABLES.items() if getattr(models, attribute) is not None}
    made = session.materialize(reduce(DataFrame.unionByName, [store.slices(n, df) for n, df in tables.items()]), "slices")
    old = covered(store.current()).where(F.col("table").isin(*tables, HELD))
    good, stays = made, old
    entries = []
    if held is not None:
        held = store.write(HELD, run, held)
        good, stays = matching(made, held, how="left_anti"), matching(old, held, how="left_anti")
        entries.append(_placed(store.slices(HELD, held), run))
    gone = matching(stays, good, ["table", *SLICE], "left_anti")
    entries += [_placed(good, run), _taken(gone)]
    # the typical hour depends on all days: its counts follow the slices that this version changes
    days = good.unionByName(gone, allowMissingColumns=True).where("table = 'daily_intensity'").select(*SLICE).distinct()
    counts = cleanest_hours(store, run, models.intensity, days, narrow)
    entries.append(_placed(store.slices(COUNTS, counts), run))
    if digests is not None:
        entries.append(_placed(store.slices("bronze_digests", store.write("bronze_digests", run, digests)), run))
    return store.commit(reduce(DataFrame.unionByName, entries))


def typical_hours(store: Store) -> DataFrame:
    """(country_code, typical_cleanest_hour) from the maintained counts (24 rows a country)."""
    return ops.typical_hour_of_counts(store.read(COUNTS).withColumnRenamed("days", "day_count"))


def carbon_mart(spark: SparkSession, warehouse: str) -> DataFrame:
    """The published carbon mart: days with their country's typical cleanest hour, joined as it is read."""
    store = Store(spark, warehouse)
    return ops.join_typical_hour(store.read("daily_intensity"), typical_hours(store))


def published(spark: SparkSession, warehouse: str, table: str, start=None, end=None, countries="ALL") -> DataFrame:
    """A published table's rows, of a range of days and some countries if given."""
    return Store(spark, warehouse).read(table, within=_narrow(start, end, countries))


def latest_day(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The rows of a published table's newest day.  The manifest knows which that is: no other day is read."""
    store = Store(spark, warehouse)
    last = store.current(table).agg(F.max("date_key")).first()[0]
    return store.read(table, within=lambda df: df.where(F.col("date_key").eqNullSafe(F.lit(last).cast("date"))))


def publish_marts(spark: SparkSession, silver_path: str, warehouse: str, start=None, end=None, gate: bool = True,
                  gate_checks=declared_checks, weather_path: str | None = None, countries="ALL", on_failure: str = "stop",
                  digests: DataFrame | None = None, slices: DataFrame | None = None, run: str | None = None) -> Models:
    """Models of the silver days in [start, end], gated, then published.

    The gate runs on what was written and before anything of it is named by the manifest.  It looks at every declared test of
    error severity; pass ``gate_checks=key_integrity_checks`` to look at keys alone.  ``on_failure`` is ``stop`` (publish
    nothing) or ``hold`` (publish the slices without failures, and record the others as ``held_back``)."""
    store, run = Store(spark, warehouse), run or new_run()
    models = build(spark, silver_path, weather_path, start, end, countries, store, run, slices)
    held = None
    if gate:
        checks = [c for c in gate_checks(models) if c.severity == "error"]
        counts = counted(models, checks)
        if on_failure == "stop":
            dq.stop(counts)
        failing = {(c, model) for c, model, _, n in counts if n}
        if failing:  # only now is anything grouped by slice, and only for the checks that fail
            held = session.materialize(dq.failing_slices([c for c in checks if (c.name, c.model) in failing]), "held")
    publish(models, store, run, start, end, countries, held, digests, slices)
    return models


def run_range(spark: SparkSession, at: Layout, start=None, end=None, countries="ALL", gate_checks=declared_checks,
              on_failure: str = "stop", only_changed: bool = False) -> Models | None:
    """J1 / J2 end to end for a range of days: documents and cubes -> silver -> gate -> published models.

    With ``only_changed``, slices whose documents and cubes are those of the last published run are left alone; where there is no other,
    nothing is written and None is returned."""
    digests = changed = slices = None
    if only_changed:
        store = Store(spark, at.warehouse)
        now = session.materialize(bronze_digests(spark, at, start, end, countries), "now")
        changed = session.materialize(changed_slices(spark, at, store, start, end, countries, now), "changed")
        if changed.isEmpty():
            return None
        slices = changed.select(*SLICE).distinct()
        digests = session.materialize(matching(now, slices), "digests")
    bronze_to_silver(spark, at, start, end, countries, changed)
    weather_to_silver(spark, at, start, end, countries, changed)
    return publish_marts(spark, at.silver_generation, at.warehouse, start, end, gate_checks=gate_checks,
                         weather_path=at.silver_weather, countries=countries, on_failure=on_failure, digests=digests, slices=slices)


def daily_increment(spark: SparkSession, raw: DataFrame, silver_path: str, day, countries="ALL", gate: bool = True) -> Models:
    """J1 from rows in the silver layout: one day -> silver -> gate -> that day's models."""
    return backfill(spark, raw, silver_path, day, day, countries, gate)


def backfill(spark: SparkSession, raw: DataFrame, silver_path: str, start, end, countries="ALL", gate: bool = True) -> Models:
    """J2 from rows in the silver layout: a range of days in one job."""
    ingest(raw, silver_path, start, end, countries)
    models = build(spark, silver_path, None, start, end, countries)
    if gate:
        dq.stop(counted(models, key_integrity_checks(models)))
    return models


# --- named queries --------------------------------------------------------------------------

def _first_and_last(raw: DataFrame) -> list[Column]:
    """The first and the last day of raw rows, found once: a scalar subquery would read them again in each plan that has it."""
    return [F.lit(day).cast("date") for day in raw.select(F.min(_day()), F.max(_day())).first()]


@query("silver_roundtrip", o.with_ctes(o.GEN_BASE, o.GEN_RAW, select="""select *,
  cast(make_timestamp("timestamp" // 1000) as date) as "date" from gen_raw"""))
def q_silver_roundtrip(spark, sf_dir):
    """Raw rows written to the partitioned silver table and read back."""
    path = session.work_dir(spark, "silver")
    sinks.write_silver_generation(load_gen_raw(spark, sf_dir), path)
    return sinks.read_silver_generation(spark, path).drop(sinks.MONTH)


@query("incremental_day", o.with_ctes(*o.KPI_CHAIN, select="""select * from kpi
  where date_key = (select max(date_key) from kpi)"""))
def q_incremental_day(spark, sf_dir):
    """Backfill every day but the last, then the last day's increment twice (a re-run changes nothing): the
    increment's KPI is that day's alone."""
    raw = load_gen_raw(spark, sf_dir)
    _, last = _first_and_last(raw)
    path = session.work_dir(spark, "increment")
    ingest(raw.where(_day() < last), path)
    daily_increment(spark, raw, path, last)
    return daily_increment(spark, raw, path, last).kpi


# The re-issued last day: half of its actual generation.
_REISSUED = """reissued as (
  select * replace (if(make_timestamp("timestamp" // 1000)::date = (select max(make_timestamp("timestamp" // 1000)::date)
                       from gen_raw), actual_MW / 2, actual_MW) as actual_MW) from gen_raw)"""


@query("stream_increment", o.with_ctes(o.GEN_BASE, o.GEN_RAW, _REISSUED, o.STG.replace("from gen_raw", "from reissued"),
                                       o.IDG, o.KPI, select="select * from kpi"))
def q_stream_increment(spark, sf_dir):
    """Raw rows landed in drops, each picked up by an availableNow file stream into silver; the last drop is
    the last day again with lower readings, which replace the earlier ones."""
    from gridmix import streaming

    raw = load_gen_raw(spark, sf_dir)
    base = session.work_dir(spark, "stream")
    landing, silver, ckpt = f"{base}/landing", f"{base}/silver", f"{base}/_checkpoint"
    first, last = raw.select(F.min(_day())).scalar(), raw.select(F.max(_day())).first()[0]
    raw.where(_day() < F.date_add(first, 3)).write.parquet(f"{landing}/drop=1")
    streaming.run_available_now(spark, landing, silver, ckpt)
    raw.where(_day() >= F.date_add(first, 3)).write.parquet(f"{landing}/drop=2")
    streaming.run_available_now(spark, landing, silver, ckpt)
    reissued = raw.where(_day() == last).withColumn("actual_MW", F.col("actual_MW") / 2)
    reissued.write.parquet(f"{landing}/drop=3")
    streaming.run_available_now(spark, landing, silver, ckpt)
    streaming.run_available_now(spark, landing, silver, ckpt)  # nothing new: no-op
    stg = ops.stg_generation(streaming.read_silver(spark, silver).drop("date"))
    return ops.fct_renewable_kpi(ops.int_daily_generation(stg))


@query("stream_published", o.with_ctes(o.GEN_BASE, o.GEN_RAW, _REISSUED, o.STG.replace("from gen_raw", "from reissued"),
                                       o.CI, o.FCT_CI, select="select * from fct_ci"))
def q_stream_published(spark, sf_dir):
    """A file stream to published marts: each batch publishes the slices that it brought and no others.  The last drop is
    the last day again with lower readings; its batch, repeated, changes nothing."""
    from gridmix import streaming

    raw = load_gen_raw(spark, sf_dir)
    at = Layout(session.work_dir(spark, "stream"))
    first, last = raw.select(F.min(_day()), F.max(_day())).first()
    drops = [raw.where(_day() < F.date_add(F.lit(first), 3)), raw.where(_day() >= F.date_add(F.lit(first), 3)),
             raw.where(_day() == F.lit(last)).withColumn("actual_MW", F.col("actual_MW") / 2)]
    store = Store(spark, at.warehouse)
    for n, drop in enumerate(drops):
        drop.write.parquet(f"{at.landing}/drop={n}")
        streaming.publish_available_now(spark, at.landing, at.silver_generation, at.warehouse, f"{at.base}/_checkpoint",
                                        gate_checks=key_integrity_checks)
    version = store.version()
    streaming.publish_batch(drops[2].withColumn("drop", F.lit(2).cast("long")), len(drops) - 1, at.silver_generation,
                            at.warehouse, f"{at.base}/_checkpoint", gate_checks=key_integrity_checks)
    if store.version() != version:
        raise RuntimeError("a repeated batch was published again")
    return carbon_mart(spark, at.warehouse)


BACKFILL_FROM, BACKFILL_DAYS = 1, 3
_RANGE = f"""between (select min(date_key) from kpi) + {BACKFILL_FROM}
                  and (select min(date_key) from kpi) + {BACKFILL_FROM + BACKFILL_DAYS}"""


def _range(first: Column) -> tuple[Column, Column]:
    return F.date_add(first, BACKFILL_FROM), F.date_add(first, BACKFILL_FROM + BACKFILL_DAYS)


@query("backfill_range", o.with_ctes(*o.KPI_CHAIN, select=f"select * from kpi where date_key {_RANGE}"))
def q_backfill_range(spark, sf_dir):
    """Backfill of a date range for all countries in one job, models built from silver."""
    raw = load_gen_raw(spark, sf_dir)
    start, end = _range(_first_and_last(raw)[0])
    return backfill(spark, raw, session.work_dir(spark, "backfill"), start, end).kpi


@query("published_marts", o.with_ctes(*o.FCT_CI_CHAIN, select="select * from fct_ci"))
def q_published_marts(spark, sf_dir):
    """Silver and marts published by a backfill of all days but the last, then the last
    day's increment twice; the published carbon mart equals one built from all raw rows."""
    raw = load_gen_raw(spark, sf_dir)
    _, last = _first_and_last(raw)
    at = Layout(session.work_dir(spark, "warehouse"))
    ingest(raw.where(_day() < last), at.silver_generation)
    publish_marts(spark, at.silver_generation, at.warehouse, gate_checks=key_integrity_checks)
    for _ in range(2):
        ingest(raw, at.silver_generation, last, last)
        publish_marts(spark, at.silver_generation, at.warehouse, last, last, gate_checks=key_integrity_checks)
    return carbon_mart(spark, at.warehouse)


def land_bronze(spark: SparkSession, sf_dir: str, at: Layout) -> None:
    """The bronze tree that the tables imply: documents of both domains, an acknowledgement for each
    country-day divisible by 3, and weather cubes.  Documents are packed and cubes have a folder a month: a document is
    a few dozen points long, and a tree with a file for each would be all file creation."""
    raw = load_gen_raw(spark, sf_dir)
    docs = bx.generation_documents(raw)
    days = docs.select("country", "date").distinct().where(F.dayofmonth("date") % 3 == 0)
    acks = days.withColumn("xml", bx.acknowledgement_document(F.lit("999"), F.lit("No data")))
    of_domain = [df.withColumn("domain", F.lit(domain)) for df, domain in
                 ((docs, "generation"), (bx.forecast_documents(raw), "forecast"), (acks, "forecast"))]
    bx.pack_documents(reduce(DataFrame.unionByName, of_domain), at.documents)
    cubes = cube.build_cubes(load_weather_raw(spark, sf_dir)).withColumn("date", F.to_date(F.element_at("time", 1)))
    (cubes.withColumn(sinks.MONTH, F.trunc("date", "month")).hint("rebalance", sinks.MONTH).write.partitionBy(sinks.MONTH)
     .parquet(at.cubes))


# Documents of actual generation carry no forecast.  Their times are quarter-hours or, for forecasts, hours, which
# staging truncates to hours anyway.
_DOCUMENTED = """documented as (
  select * replace (if(domain = 'forecast', forecast_MW, null) as forecast_MW) from gen_raw)"""
_DOCUMENT_GW = o.with_ctes(o.GEN_BASE, o.GEN_RAW, _DOCUMENTED, o.STG.replace("from gen_raw", "from documented"),
                           o.WEATHER_RAW, o.CELLS, o.WIND, o.SOLAR, o.GW, select=f"""select * replace ({o.R('avg_wind_speed', 6)} as avg_wind_speed) from gw
  where date_key""")


def _revised(rows: str, actual: str) -> str:
    """gen_raw with other readings in some rows of the last day."""
    return f"""reissued as (
  select * replace (if(make_timestamp("timestamp" // 1000)::date = (select max(make_timestamp("timestamp" // 1000)::date) from gen_raw)
                       and {rows}, {actual}, actual_MW) as actual_MW) from gen_raw)"""


_FR_HALVED = [o.GEN_BASE, o.GEN_RAW, _revised("country = 'FR'", "actual_MW / 2"), o.STG.replace("from gen_raw", "from reissued")]


@query("publish_one_country", o.with_ctes(*_FR_HALVED, o.IDG, o.KPI, select="select * from kpi"))
def q_publish_one_country(spark, sf_dir):
    """All days and countries published, then one country's last day revised and published alone: its slice is
    replaced, those of other days and countries stay."""
    raw = load_gen_raw(spark, sf_dir)
    last = raw.select(F.max(_day())).first()[0]
    at = Layout(session.work_dir(spark, "warehouse"))
    ingest(raw, at.silver_generation)
    publish_marts(spark, at.silver_generation, at.warehouse, gate_checks=key_integrity_checks)
    ingest(raw.withColumn("actual_MW", F.col("actual_MW") / 2), at.silver_generation, last, last, ["FR"])
    publish_marts(spark, at.silver_generation, at.warehouse, last, last, gate_checks=key_integrity_checks, countries=["FR"])
    return published(spark, at.warehouse, "fct_renewable_kpi")


@query("overview_published", ORACLE["overview_kpis"])
def q_overview_published(spark, sf_dir):
    """The overview of the newest day from the published mart, of which only that day's rows are read."""
    at = Layout(session.work_dir(spark, "warehouse"))
    ingest(load_gen_raw(spark, sf_dir), at.silver_generation)
    publish_marts(spark, at.silver_generation, at.warehouse, gate_checks=key_integrity_checks)
    return reports.overview_kpis(latest_day(spark, at.warehouse, "fct_renewable_kpi"))


def _quarantine_sql() -> str:
    """Failures of the declared tests by slice, from their definitions; slices without one are published."""
    from gridmix.plans import quality_checks as qc

    twins = {"stg_generation": "stg", "int_daily_generation": "idg", "int_carbon_intensity": "ci", "fct_renewable_kpi": "kpi",
             "fct_grid_carbon_intensity": "fct_ci"}
    parts = [(check, model, f"select date_key, country_code from {table} where {test}")
             for model, table in twins.items() for check, test in qc.ROW_TESTS[model]]
    parts.append(("minimum_row_coverage", "stg_generation", f"""select date_key, country_code from stg
        where actual_mw is not null or forecast_mw is not null group by all having count(*) < {dq.MIN_ROWS_PER_DAY}"""))
    parts.append(("country_code_valid", "fct_renewable_kpi",
                  "select date_key, country_code from kpi where country_code not in (select country_code from dim_country)"))
    failing = " union all ".join(f"""select date_key, country_code, '{c}' as "check", '{m}' as model, count(*) as failures
        from ({sql}) group by all""" for c, m, sql in parts)
    chain = list(dict.fromkeys([*o.KPI_CHAIN, *o.FCT_CI_CHAIN, o.DIM_COUNTRY]))
    return o.with_ctes(*chain, f"failing as ({failing})", select="""
      select date_key, country_code, 'held' as outcome, "check", model, failures from failing
      union all
      select date_key, country_code, 'published', null, null, 0 from kpi
      where (date_key, country_code) not in (select date_key, country_code from failing)""")


@query("quarantined_slices", _quarantine_sql())
def q_quarantined_slices(spark, sf_dir):
    """A run that holds back the slices which fail a declared test, with every reason, and publishes the others."""
    at = Layout(session.work_dir(spark, "warehouse"))
    ingest(load_gen_raw(spark, sf_dir), at.silver_generation)
    publish_marts(spark, at.silver_generation, at.warehouse, on_failure="hold")
    store = Store(spark, at.warehouse)
    outcome = store.current("fct_renewable_kpi").select(*SLICE, F.lit("published").alias("outcome"),
                                                        F.lit(0).cast("long").alias("failures"))
    if not store.has(HELD):
        return outcome.withColumns({"check": F.lit(None).cast("string"), "model": F.lit(None).cast("string")})
    return store.read(HELD).withColumn("outcome", F.lit("held")).unionByName(outcome, allowMissingColumns=True)


_SOLAR_RISES = [o.GEN_BASE, o.GEN_RAW, _revised("hour(make_timestamp(\"timestamp\" // 1000)) % 5 = 0 and psr_type in ('B16', 'B18', 'B19')",
                                                "actual_MW * 40"), o.STG.replace("from gen_raw", "from reissued")]


@query("typical_hour_maintained", o.with_ctes(*_SOLAR_RISES, o.CI, o.FCT_CI, select="""
  select country_code, low.h as cleanest_hour_of_day, count(*) as days from ci_ends group by all"""))
def q_typical_hour_maintained(spark, sf_dir):
    """Days by country and cleanest hour, kept up through a revision of the last day by the days that it replaces,
    equal a count over all days."""
    raw = load_gen_raw(spark, sf_dir)
    last = raw.select(F.max(_day())).first()[0]
    at = Layout(session.work_dir(spark, "warehouse"))
    ingest(raw, at.silver_generation)
    publish_marts(spark, at.silver_generation, at.warehouse, gate_checks=key_integrity_checks)
    green = (F.hour(gf.epoch_ns_to_ts("timestamp")) % 5 == 0) & F.col("psr_type").isin("B16", "B18", "B19")
    ingest(raw.withColumn("actual_MW", F.when(green, F.col("actual_MW") * 40).otherwise(F.col("actual_MW"))),
           at.silver_generation, last, last)
    publish_marts(spark, at.silver_generation, at.warehouse, last, last, gate_checks=key_integrity_checks)
    return Store(spark, at.warehouse).read(COUNTS).drop("date_key")


@query("pipeline_day", f"{_DOCUMENT_GW} = (select max(date_key) from stg)")
def q_pipeline_day(spark, sf_dir):
    """One day end to end: documents and cubes -> silver -> gate -> published generation x weather."""
    at = Layout(session.work_dir(spark, "pipeline"))
    land_bronze(spark, sf_dir, at)
    _, last = bx.document_days(spark, at.documents)
    run_range(spark, at, last, last, gate_checks=key_integrity_checks)
    out = published(spark, at.warehouse, "int_generation_weather")
    return out.withColumn("avg_wind_speed", F.round("avg_wind_speed", 6))


@query("pipeline_backfill", f"""{_DOCUMENT_GW} between (select min(date_key) from stg) + {BACKFILL_FROM}
  and (select min(date_key) from stg) + {BACKFILL_FROM + BACKFILL_DAYS}""")
def q_pipeline_backfill(spark, sf_dir):
    """A range of days end to end in one job per step, for all countries; a re-run changes nothing."""
    at = Layout(session.work_dir(spark, "pipeline"))
    land_bronze(spark, sf_dir, at)
    first, _ = bx.document_days(spark, at.documents)
    start, end = (first + dt.timedelta(n) for n in (BACKFILL_FROM, BACKFILL_FROM + BACKFILL_DAYS))
    for _ in range(2):
        run_range(spark, at, start, end, gate_checks=key_integrity_checks)
    out = published(spark, at.warehouse, "int_generation_weather")
    return out.withColumn("avg_wind_speed", F.round("avg_wind_speed", 6))


_BRONZE_SLICES = f"""
  select cast(make_timestamp(ts_ns // 1000) as date) as date_key, country as country_code, domain from gen_base
  union select distinct cast(make_timestamp(ts_ns // 1000) as date), country, 'forecast' from gen_base
    where domain = 'generation' and dayofmonth(make_timestamp(ts_ns // 1000)) % 3 = 0
  union select cast(make_timestamp("timestamp" // 1000) as date), country, 'weather' from weather_raw"""


@query("changed_slices", o.with_ctes(o.GEN_BASE, o.WEATHER_RAW, f"bronze as ({_BRONZE_SLICES})", select="""
  select 'first' as step, * from bronze
  union all
  select 'revised', * from bronze where domain = 'generation' and country_code = 'GR'
     and date_key = (select max(date_key) from bronze where domain = 'generation' and country_code = 'GR')"""))
def q_changed_slices(spark, sf_dir):
    """What a run over unchanged-skipping ingest takes up: everything at first, nothing when repeated (no version is
    written), and after one document was corrected that document's slice alone."""
    at = Layout(session.work_dir(spark, "pipeline"))
    land_bronze(spark, sf_dir, at)
    store = Store(spark, at.warehouse)
    steps = []

    def run(step: str) -> None:
        steps.append(session.materialize(changed_slices(spark, at, store).withColumn("step", F.lit(step)), "step"))
        run_range(spark, at, gate_checks=key_integrity_checks, only_changed=True)

    run("first")
    version = store.version()
    run("again")
    if store.version() != version:
        raise RuntimeError("a run without changes wrote a version")
    _, last = bx.document_days(spark, at.documents, "GR", "generation")
    docs = bx.read_documents(spark, at.documents, last, last).where("domain = 'generation' and country = 'GR'")
    fixed = docs.where(F.col("date") == F.lit(last)).select(
        F.replace("xml", F.lit("<quantity>"), F.lit("<quantity>1")).alias("value"), "country", "date", "domain")
    fixed = session.materialize(fixed, "fixed")
    (fixed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1)
     .partitionBy("country", "date", "domain").text(at.documents))
    run("revised")
    return reduce(DataFrame.unionByName, steps).select("step", *SLICE, "domain")


# --- what is left out, and what is read as archives deliver it --------------------------------

def odd_documents(spark, sf_dir) -> DataFrame:
    """Generation documents, some cut short, some with numeric offsets, some without a start; acknowledgements."""
    docs = bx.generation_documents(load_gen_raw(spark, sf_dir)).select("country", "date", "xml")
    day = F.dayofmonth("date")
    xml = F.col("xml")
    start = F.date_format("date", "yyyy-MM-dd'T'00:00'Z'")
    moved = F.concat(F.date_format("date", "yyyy-MM-dd'T'"), F.lit("01:00+01:00"))
    return docs.withColumn("xml", (
        F.when((F.col("country") == "DE") & (day % 2 == 0), F.substring(xml, 1, 400))
        .when(F.col("country") == "FR", F.replace(xml, F.concat(F.lit("<start>"), start), F.concat(F.lit("<start>"), moved)))
        .when((F.col("country") == "IT") & (day % 2 == 1), F.replace(xml, F.concat(F.lit("<start>"), start), F.lit("<start>soon")))
        .otherwise(xml)))


_DOC_DAY = "cast(make_timestamp(ts_ns // 1000) as date)"


@query("xml_rejects", o.with_ctes(o.GEN_BASE, select=f"""
  select country, {_DOC_DAY} as "date", 'bad_start' as reason, true as lost from gen_base
  where domain = 'generation' and country = 'IT' and dayofmonth({_DOC_DAY}) % 2 = 1
  union
  select country, {_DOC_DAY}, 'corrupt', true from gen_base
  where domain = 'generation' and country = 'DE' and dayofmonth({_DOC_DAY}) % 2 = 0"""))
def q_xml_rejects(spark, sf_dir):
    """Country-days with documents that don't parse or whose periods start at no time, by reason; documents
    with numeric offsets are not among them."""
    left_out = bx.rejects(odd_documents(spark, sf_dir))
    return left_out.groupBy("country", "date", "reason").agg((F.sum("n") > 0).alias("lost"))


_FILE_DAY = "cast(make_timestamp(ts_ns // 1000) as date)"


@query("xml_file_rejects", o.with_ctes(o.GEN_BASE, select=f"""
  select distinct country, {_FILE_DAY} as "date", 'cut' as reason, true as lost from gen_base
  where domain = 'generation' and country = 'DE' and dayofmonth({_FILE_DAY}) % 2 = 0
  union all
  select distinct country, {_FILE_DAY}, 'bad_start', true from gen_base
  where domain = 'generation' and country = 'IT' and dayofmonth({_FILE_DAY}) % 2 = 1
  union all
  select distinct country, {_FILE_DAY}, 'corrupt', true from gen_base
  where domain = 'generation' and country = 'SE' and dayofmonth({_FILE_DAY}) % 2 = 1"""))
def q_xml_file_rejects(spark, sf_dir):
    """Files scanned by row tag, with what the scan leaves out counted per file: elements cut off (DE), elements that don't
    parse (SE: a tag that isn't closed) and periods that start at no time (IT)."""
    broken = (F.col("country") == "SE") & (F.dayofmonth("date") % 2 == 1)
    docs = odd_documents(spark, sf_dir).withColumn("xml", F.when(broken, F.regexp_replace(
        "xml", "</quantity></Point></Period>", "</Point></Period>")).otherwise(F.col("xml")))
    root = session.work_dir(spark, "odd-files")
    bx.land_documents(docs, root, "generation")
    place = [F.regexp_extract("path", r"country=([A-Z]+)/", 1).alias("country"),
             F.to_date(F.regexp_extract("path", r"date=([0-9-]+)/", 1)).alias("date")]
    return bx.file_rejects(spark, root).groupBy(*place, "reason").agg((F.sum("n") > 0).alias("lost"))


@query("xml_offset_rows", o.with_ctes(o.GEN_BASE, select=f"""
  select make_timestamp(ts_ns // 1000) as "timestamp", country, psr_type, actual_MW from gen_base
  where domain = 'generation' and actual_MW is not null
    and not (country = 'DE' and dayofmonth({_DOC_DAY}) % 2 = 0) and not (country = 'IT' and dayofmonth({_DOC_DAY}) % 2 = 1)"""))
def q_xml_offset_rows(spark, sf_dir):
    """Rows of all documents that can be read: those whose start has a numeric offset give the same rows as in UTC, those
    that don't parse or start at no time give none."""
    docs = odd_documents(spark, sf_dir)
    return bx.flatten_series(bx.decode_documents(docs)).select("timestamp", "country", "psr_type", "actual_MW") \
        .where("actual_MW is not null")


@query("weather_coerced", o.with_ctes(o.WEATHER_RAW, select="""select "timestamp", lat, lon, variable, value, country
  from weather_raw where cast(round(lat * 4 + lon * 4) as bigint) % 5 not in (1, 2)"""))
def q_weather_coerced(spark, sf_dir):
    """Weather as archives deliver it (archive names, text, NaN, no numbers) made into silver rows."""
    raw = load_weather_raw(spark, sf_dir)
    kind = F.round(F.col("lat") * 4 + F.col("lon") * 4).cast("long") % 5
    names = {v: k for k, v in dims.WEATHER_SHORT_NAMES.items()}
    text = F.when(kind == 1, "n/a").when(kind == 2, "NaN").otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    delivered = raw.select(
        F.timestamp_micros(F.expr("timestamp div 1000")).alias("valid_time"), F.col("lat").cast("string").alias("latitude"),
        F.col("lon").alias("longitude"), F.try_element_at(dims.map_literal(names), F.col("variable")).alias("variable"),
        text.alias("value"), "country")
    return weather.to_silver_weather(delivered)
