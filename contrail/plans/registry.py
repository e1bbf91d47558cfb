"""One runnable query per operator, over a folder of star-schema parquet tables.

Results are flat: dates and arrays are given as text and trigonometric or summed doubles are rounded,
so that two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, StructType

from contrail.functions import geo
from contrail.operators import accumulate, enrich, flight_sets, hexagons, incremental, quality, ranges, staging, trajectory
from contrail.plans import dashboards, model_tests
from contrail.plans.marts import Marts
from contrail.plans.runs import Warehouse
from contrail.session import empty_frame, shared_folder
from contrail.sources import schemas
from contrail.sources.adapters import StarSchema
from contrail.sources.files import conform
from contrail.sources.tables import read, settled, store_merge, store_months
from contrail.streaming import ingest

AIRPORT, LAT, LON = "AP0", 47.0, 5.0
AIRPORT_RESOLUTIONS = range(6, 11)
FIRST, LAST = date(2024, 1, 1), date(2024, 2, 1)
PATHS_UNTIL = date(2024, 1, 10)
LOADED, RELOADED = datetime(2024, 1, 1), datetime(2024, 1, 11)
YEAR = date(2024, 1, 1)
PERIOD_STARTS = [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2024, 1, 31)]
COUNTRIES = [f"NATION_{i}" for i in range(25)]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def flat(df: DataFrame) -> DataFrame:
    def column(field):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, ArrayType):
            value = F.array_join(value.cast("array<string>"), ",", "null")
        return value.alias(field.name)

    if not any(isinstance(field.dataType, DateType | ArrayType) for field in df.schema):
        return df
    return df.select([column(field) for field in df.schema])


def query(build: Callable[[Marts], DataFrame]) -> Callable[[Marts], DataFrame]:
    """Register ``build`` under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return flat(build(Marts(spark, StarSchema(spark, folder).raw, LOADED)))

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _batch(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows whose day of flight is from the first to the last day of January 2024."""
    return df.where(F.col("dof").between(F.lit(date(2024, 1, first)), F.lit(date(2024, 1, last))))


# Sources and staging


@query
def scan_flights(m):
    return conform(m.raw("src_flights"), schemas.FLIGHTS)


@query
def stg_flights(m):
    return m.stg_flights


@query
def stg_events(m):
    return m.stg_events


@query
def stg_measurements(m):
    return m.stg_measurements


@query
def stg_aircrafts(m):
    return m.stg_aircrafts


@query
def stg_aircraft_types(m):
    return m.stg_aircraft_types


@query
def stg_airports(m):
    return m.stg_airports


# Enrichment and marts


@query
def int_events(m):
    return m.int_events


@query
def orphan_events(m):
    """Events of no flight with both airports known."""
    return enrich.orphan_events(m.stg_events, m.fct_flights.dropna(subset=["adep", "ades"]))


@query
def int_measurements(m):
    return m.int_measurements


@query
def int_aircraft_types(m):
    return m.int_aircraft_types


@query
def fct_events(m):
    return m.fct_events


@query
def dim_aircrafts(m):
    return m.dim_aircrafts


@query
def dim_airports(m):
    return m.dim_airports


@query
def dim_customers(m):
    return m.dim_customers


@query
def payment_methods_agg(m):
    return _rounded(enrich.payment_methods_agg(m.raw("stg_payments")), "amount", digits=2)


@query
def fact_orders(m):
    return _rounded(m.fact_orders, "amount", digits=2)


@query
def agg_orders(m):
    return _rounded(m.agg_orders, "total_amount", digits=2)


# Trajectories


@query
def events_lagged(m):
    return m.view_events_lagged


@query
def events_filtered(m):
    return m.view_events_filtered


@query
def leg_distance(m):
    measured = trajectory.with_leg_distance(m.view_events_lagged)
    return _rounded(measured.select("id", "flight_id", "distance_km", "steps"), "distance_km")


@query
def number_series(m):
    """How many legs have an n-th step."""
    points = trajectory.interpolated_points(m.legs, max_altitude=None)
    return points.groupBy("n").agg(F.count("*").alias("legs"))


@query
def interpolated_steps(m):
    """Exact digests of the interpolated points of each flight."""
    point = F.col("waypoint")

    def micro(value):
        return F.floor(value * 1e6)

    return trajectory.interpolated_points(m.legs).groupBy("flight_id").agg(
        F.count("*").alias("points"),
        F.count_if(F.col("n") == 0).alias("legs"),
        F.sum("n").alias("sum_n"),
        F.sum("steps").alias("sum_steps"),
        F.sum(micro(point["lat"])).alias("sum_lat"),
        F.sum(micro(point["lon"])).alias("sum_lon"),
        F.sum(micro(point["alt"])).alias("sum_alt"),
        F.min(point["ts"]).alias("first_ts"),
        F.max(point["ts"]).alias("last_ts"),
        F.max(F.round("distance_km", 6)).alias("longest_km"),
    )


@query
def interpolated_waypoints(m):
    """Every interpolated point, row by row; coordinates in whole millionths, which no engine rounds otherwise."""
    points = trajectory.interpolated_points(m.legs).select("id", "n", "steps", "distance_km", "waypoint.*")
    micro = {c: F.floor(F.col(c) * 1e6) for c in ("lat", "lon", "alt")}
    return _rounded(points, "distance_km").withColumns(micro)


# Hexagons


@query
def hex_cells(m):
    return hexagons.hex_cells(m.stg_events).select("id", "latitude", "longitude", "hex")


@query
def hex_paths(m):
    """Length of the path and its cells in order."""
    paths = hexagons.hex_paths(m.view_events_filtered)
    cells = F.transform("grid_array", lambda cell: geo.hex_id(cell))
    return paths.select("id", "flight_id", F.size("grid_array").alias("cells"), cells.alias("path"))


@query
def hex_traffic(m):
    return hexagons.hex_traffic(m.airborne_legs)


@query
def hex_traffic_res8(m):
    return hexagons.hex_traffic(m.airborne_legs, resolution=8)


@query
def airport_hexes(m):
    return hexagons.agg_by_coordinates(m.legs, LAT, LON)


@query
def airport_page(m):
    """The map of an airport at each resolution it offers."""
    return dashboards.airport_page(m.legs, LAT, LON, AIRPORT_RESOLUTIONS)


def _at_the_180th_meridian(m) -> DataFrame:
    """Legs of the events as if they lay on both sides of the 180th meridian."""
    moved = F.col("longitude") + 174.5
    turned = F.when(moved > 180, moved - 360).otherwise(moved)
    return trajectory.airborne(trajectory.legs(m.int_events.withColumn("longitude", turned), m.hot_flights, carried=["dof"]))


@query
def meridian_paths(m):
    """Paths that cross the 180th meridian, or lie beside it."""
    paths = hexagons.hex_paths(_at_the_180th_meridian(m))
    cells = F.transform("grid_array", lambda cell: geo.hex_id(cell))
    return paths.select("id", "flight_id", F.size("grid_array").alias("cells"), cells.alias("path"))


@query
def meridian_traffic(m):
    return hexagons.hex_traffic(_at_the_180th_meridian(m))


@query
def period_counts(m):
    return hexagons.period_counts(m.airborne_legs)


@query
def flight_set_counts(m):
    """The same counts from bitmaps of flights per cell and day."""
    numbers = flight_sets.new_numbers(m.int_events, empty_frame(m.spark, StructType.fromDDL(flight_sets.NUMBERS)))
    sets = flight_sets.flight_sets(m.int_events, numbers, m.hot_flights, geo.DEFAULT_RESOLUTION)
    return hexagons.named(flight_sets.set_counts(sets), geo.DEFAULT_RESOLUTION, "year_start", "slot")


# Accumulating arrays


def _period(m, index: int, cumulative: bool = False) -> DataFrame:
    start = None if cumulative else PERIOD_STARTS[index]
    return hexagons.hex_traffic(m.airborne_legs, start=start, end=PERIOD_STARTS[index + 1])


def _no_state(m) -> DataFrame:
    return empty_frame(m.spark, accumulate.STATE_SCHEMA)


def _metric_arrays(m) -> DataFrame:
    return accumulate.metric_arrays(
        hexagons.period_counts(m.airborne_legs), accumulate.loaded_periods(m.int_events)
    )


@query
def metric_array_step(m):
    """State after all periods, added one after the other."""
    steps = range(len(PERIOD_STARTS) - 1)
    return reduce(lambda state, i: accumulate.accumulate(state, _period(m, i), YEAR, i), steps, _no_state(m))


@query
def metric_array_rerun(m):
    """The first period counted again, over everything so far, replaces its slot."""
    state = accumulate.accumulate(_metric_arrays(m), _period(m, 1, cumulative=True), YEAR, 0)
    return state


@query
def metric_array_append(m):
    """Appended steps, one per period, of counts over everything loaded so far."""
    steps = range(len(PERIOD_STARTS) - 1)
    return reduce(lambda s, i: accumulate.accumulate(s, _period(m, i, cumulative=True), YEAR), steps, _no_state(m))


@query
def metric_array_full(m):
    return _metric_arrays(m)


@query
def hex_year_totals(m):
    return accumulate.sum_yearly_metric_array(_metric_arrays(m))


# Incremental strategies


@query
def batch_bounds(m):
    return incremental.batch_bounds(m.int_events)


@query
def replace_range(m):
    """All days are stored; a corrected batch covers days 11 to 20 without day 13."""
    corrected = _batch(m.int_events, 11, 20).where(F.dayofmonth("dof") != 13)
    return incremental.replace_range(m.int_events, corrected.withColumn("altitude", F.col("altitude") + 1))


@query
def replace_month(m):
    """Flights moved to lie in two months; the batch brings half of the first month again."""
    moved = m.fct_flights.withColumn("dof", F.date_add("dof", 20))
    january = moved.where(F.month("dof") == 1)
    return incremental.replace_month(moved, january.where(F.dayofmonth("dof") % 2 == 0))


@query
def merge_upsert(m):
    """Flights per airport pair: days 11 to 31 update or join days 1 to 20, the first day stays."""

    def pairs(first, last):
        kept = _batch(m.fct_flights, first, last).dropna(subset=["adep", "ades"])
        return kept.groupBy("adep", "ades").agg(F.count("*").alias("flights"), F.min("dof").alias("first_day"))

    return incremental.merge_upsert(pairs(1, 20), pairs(11, 31), ["adep", "ades"], ["flights"])


def _next_airports(m) -> DataFrame:
    raised = F.when(F.col("id") % 3 == 0, F.col("elevation_ft") + 1).otherwise(F.col("elevation_ft"))
    return m.raw("src_airports").where(F.col("id") % 10 != 9).withColumn("elevation_ft", raised)


@query
def scd2_airports(m):
    return incremental.snapshot_airports(m.scd_airports, _next_airports(m), RELOADED)


@query
def scd2_close_missing(m):
    return incremental.snapshot_airports(m.scd_airports, _next_airports(m), RELOADED, close_missing=True)


# Dashboards


@query
def hex_heatmap(m):
    return dashboards.hex_heatmap(accumulate.sum_yearly_metric_array(_metric_arrays(m)))


@query
def range_breaks(m):
    points = m.stg_events.dropna(subset=["altitude"])
    return ranges.range_breaks(points, "altitude", ranges.ALTITUDE_FRACTIONS)


@query
def range_buckets(m):
    points = m.stg_events.dropna(subset=["altitude"])
    return ranges.with_range_bucket(points, "altitude", ranges.ALTITUDE_FRACTIONS).select("id", "altitude", "bucket")


@query
def current_airports(m):
    versions = incremental.snapshot_airports(m.scd_airports, _next_airports(m), RELOADED)
    airports = enrich.dim_airports(versions, m.raw("country_codes"))
    return dashboards.current_airports(airports).select(
        "airport", "icao_code", "type", "country", "elevation", "latitude", "longitude"
    )


@query
def airport_picker(m):
    return dashboards.airport_picker(m.dim_airports, "NATION_15", staging.AIRPORT_TYPES)


@query
def airport_lookup(m):
    return dashboards.airport_lookup(m.dim_airports, "Supplier#000000000")


@query
def hourly_traffic(m):
    # int_events has all the columns of fct_events that the query reads.
    return dashboards.hourly_traffic(m.fct_flights, m.int_events, AIRPORT, m.hot_flights)


@query
def top_aircraft_types(m):
    return dashboards.top_aircraft_types(m.fct_flights, m.dim_aircrafts, AIRPORT)


@query
def top_operators(m):
    return dashboards.top_operators(m.fct_flights, m.dim_aircrafts, AIRPORT)


@query
def airport_pairs(m):
    return dashboards.airport_pairs(m.fct_flights)


@query
def flight_connections(m):
    return dashboards.flight_connections(m.fct_flights, m.dim_airports)


@query
def connections_filtered(m):
    connections = dashboards.flight_connections(m.fct_flights, m.dim_airports)
    types = ["large_airport", "medium_airport"]
    return dashboards.filter_connections(connections, 30, 25000, types, COUNTRIES[5:], COUNTRIES[:20])


@query
def distinct_countries(m):
    return dashboards.distinct_countries(m.dim_airports)


@query
def busiest_top10(m):
    return dashboards.busiest_top(m.fct_flights, FIRST, LAST)


@query
def busiest_aircraft(m):
    return dashboards.busiest_aircraft(m.fct_flights, m.fct_events, FIRST, LAST, m.hot_flights)


@query
def default_aircraft(m):
    return dashboards.default_aircraft(dashboards.busiest_points(m.fct_flights, m.fct_events, FIRST, LAST, m.hot_flights))


def _paths(m, segment_seconds=None):
    points = dashboards.busiest_points(m.fct_flights, m.fct_events, FIRST, LAST, m.hot_flights)
    chosen = dashboards.filter_points(points, dashboards.busiest_top(m.fct_flights, FIRST, LAST), FIRST, PATHS_UNTIL)
    paths = dashboards.aircraft_paths(chosen, segment_seconds)
    decimals = "array<decimal(18,6)>"
    pairs = F.transform("coordinates", lambda p: F.concat_ws(" ", *(p[c].cast("decimal(18,6)") for c in ("lon", "lat"))))
    return paths.withColumns({c: F.col(c).cast(decimals) for c in ("longitude", "latitude", "time_passed")}).withColumn(
        "coordinates", pairs
    )


@query
def aircraft_paths(m):
    return _paths(m)


@query
def aircraft_path_segments(m):
    """The same paths cut into one row per hour."""
    return _paths(m, segment_seconds=3600)


# Quality


@query
def dq_load_gate(m):
    def report(source, required):
        gate = quality.load_gate(m.raw(f"src_{source}"), required)
        checks = F.array(*(F.struct(F.lit(c).alias("check_name"), F.col(c).alias("passed")) for c in gate.columns))
        return gate.select(F.lit(source).alias("source"), F.inline(checks))

    return reduce(DataFrame.unionByName, (report(*item) for item in schemas.GATED_COLUMNS.items()))


@query
def dq_not_null(m):
    return m.stg_flights.where(quality.not_null("ades")).select("id", "icao24", "dof")


@query
def dq_unique(m):
    return quality.unique(m.raw("stg_payments"), "id")


@query
def dq_accepted_values(m):
    return m.stg_events.where(quality.accepted_values("type", model_tests.FLIGHT_EVENTS)).select("id", "type")


@query
def dq_relationships(m):
    return quality.relationships(m.raw("stg_orders"), "id", m.raw("stg_payments"), "order_id")


@query
def dq_between(m):
    fails = quality.between("altitude", 100, 3000, strictly=True, where=F.col("longitude") >= 5.5)
    return m.stg_events.where(fails).select("id", "longitude", "altitude")


@query
def dq_compound_unique(m):
    return quality.unique(m.raw("stg_payments"), "order_id", "payment_method")


@query
def profile_flights(m):
    return quality.profile(m.raw("src_flights"), ["icao24", "dof"])


class _WithArrays(Marts):
    """The models and, for their tests, the metric arrays."""

    @property
    def agg_yearly_metric_array(self):
        return _metric_arrays(self)

    @property
    def sum_yearly_metric_array(self):
        return accumulate.sum_yearly_metric_array(_metric_arrays(self))


def _register_model_tests(name: str) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        models = _WithArrays(spark, StarSchema(spark, folder).raw, LOADED)
        return model_tests.model_report(models, name)

    _QUERIES[f"tests_{name}"] = run


for _model in model_tests.DECLARED:
    _register_model_tests(_model)


# Streaming: deliveries are derived from the events table and land as files


class _Deliveries:
    """A landing folder and the tables that runs over it maintain, in a database of their own."""

    def __init__(self, m: Marts, with_arrays: bool = False):
        self.m = m
        self.home = shared_folder(m.spark, "deliveries")
        self.database = "contrail_" + self.home.rsplit("-", 1)[1]
        m.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.home}/tables'")
        self.facts = f"{self.database}.fct_events"
        self.arrays = f"{self.database}.metric_arrays" if with_arrays else None

    def deliver(self, name: str, first: int, last: int, run: bool = True, **changes: Column) -> None:
        """Land the raw events of flights of the given days, with changed columns, then run."""
        days = _batch(self.m.fct_flights, first, last).select(F.col("id").alias("flight_id"))
        events = self.m.raw("src_events").join(days, "flight_id", "left_semi")
        if events.isEmpty():
            return
        conform(events.withColumns(changes), schemas.EVENTS).write.parquet(f"{self.home}/landing/{name}")
        if run:
            self.run()

    def result(self, table: str) -> DataFrame:
        """The table's rows, kept in the checkpoint folder while the database goes."""
        rows = settled(read(self.m.spark, table))
        self.m.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        return rows

    def run(self) -> int:
        stream = ingest.arrivals(self.m.spark, f"{self.home}/landing", schemas.EVENTS)
        handle = ingest.event_batches(self.m.fct_flights, self.m.raw("src_measurements"), self.facts, self.arrays)
        return ingest.run_once(stream, handle, f"{self.home}/progress")


@query
def stream_ingest(m):
    """Everything delivered at once; a second run finds no new file."""
    deliveries = _Deliveries(m)
    deliveries.deliver("all", 1, 30)
    deliveries.run()
    return deliveries.result(deliveries.facts)


@query
def stream_replace(m):
    """Two deliveries, then a corrected one that replaces the second."""
    deliveries = _Deliveries(m)
    deliveries.deliver("first", 1, 10)
    deliveries.deliver("second", 11, 30)
    deliveries.deliver("second_again", 11, 20, altitude=F.col("altitude") + 1)
    return deliveries.result(deliveries.facts)


@query
def stream_backlog(m):
    """The same deliveries, all waiting when the one run begins."""
    deliveries = _Deliveries(m)
    deliveries.deliver("z_first", 1, 10, run=False)
    deliveries.deliver("second", 11, 30, run=False)
    deliveries.deliver("again", 11, 20, altitude=F.col("altitude") + 1)
    return deliveries.result(deliveries.facts)


@query
def stream_arrays(m):
    """Metric arrays after three deliveries, one per period."""
    deliveries = _Deliveries(m, with_arrays=True)
    for first in (1, 11, 21):
        deliveries.deliver(f"from_{first}", first, first + 9)
    return deliveries.result(deliveries.arrays)


@query
def stream_arrays_corrected(m):
    """The same, and a correction over the end of one period and the beginning of the next."""
    deliveries = _Deliveries(m, with_arrays=True)
    for first in (1, 11, 21):
        deliveries.deliver(f"from_{first}", first, first + 9)
    deliveries.deliver("again", 8, 14, longitude=F.col("longitude") + 0.25)
    return deliveries.result(deliveries.arrays)


# Stored runs: the scheduled runs over files in a database of their own


class _Stored:
    """A database, and files as they would be delivered, in the checkpoint folder."""

    def __init__(self, m: Marts):
        self.m = m
        self.home = shared_folder(m.spark, "stored")
        self.database = "contrail_" + self.home.rsplit("-", 1)[1]
        m.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.home}/tables'")
        self.warehouse = Warehouse(m.spark, self.database)

    def file(self, df: DataFrame, name: str, form: str = "parquet") -> str:
        df.write.format(form).option("header", True).save(f"{self.home}/{name}")
        return f"{self.home}/{name}"

    def result(self, table: str | DataFrame) -> DataFrame:
        """The table's rows, kept in the checkpoint folder while the database goes."""
        rows = settled(self.warehouse.table(table) if isinstance(table, str) else table)
        self.m.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        return rows

    def monthly_run(self) -> None:
        """Flights come in two files, one with other names and another order of columns."""
        flights, odd = self.m.raw("src_flights"), F.col("id").cast("bigint") % 2 == 1
        turned = flights.where(odd).toDF(*(c.upper() for c in flights.columns)).select([c.upper() for c in reversed(flights.columns)])
        files = [self.file(flights.where(~odd), "flights_a"), self.file(turned, "flights_b")]
        aircrafts = self.file(self.m.raw("src_aircrafts"), "aircrafts", "csv")
        types = self.file(self.m.raw("src_aircraft_types"), "aircraft_types", "csv")
        self.warehouse.monthly_run(files, aircrafts, types)

    def period_runs(self) -> None:
        """Two periods; the airports of the second one have changed."""
        self.monthly_run()
        measurements = self.file(self.m.raw("src_measurements"), "measurements")
        airports = [self.m.raw("src_airports"), _next_airports(self.m)]
        for i, (first, last, moment) in enumerate([(1, 20, LOADED), (11, 30, RELOADED)]):
            days = _batch(self.m.fct_flights, first, last).select(F.col("id").alias("flight_id"))
            events = self.m.raw("src_events").join(days, "flight_id", "left_semi")
            events = self.file(conform(events, schemas.EVENTS), f"events_{i}")
            listed = self.file(airports[i], f"airports_{i}", "csv")
            self.warehouse.period_run(events, measurements, listed, self.m.raw("country_codes"), moment)


@query
def stored_months(m):
    """The months of ``replace_month``, through a stored table."""
    stored = _Stored(m)
    table = stored.warehouse.name("flights")
    moved = m.fct_flights.withColumn("dof", F.date_add("dof", 20))
    store_months(moved, table)
    store_months(moved.where((F.month("dof") == 1) & (F.dayofmonth("dof") % 2 == 0)), table)
    return stored.result("flights")


@query
def stored_merge(m):
    """Flights per day and airport; counts of the later half of the month are merged, those of the earlier one stay."""
    stored = _Stored(m)
    table = stored.warehouse.name("departures")

    def counted(first, last, factor):
        known = _batch(m.fct_flights, first, last).dropna(subset=["adep"])
        flights = (F.count("*") * factor).alias("flights")
        return known.groupBy("adep", "dof").agg(flights, F.min("first_seen").alias("earliest"))

    store_merge(counted(1, 20, 1), table, ["adep", "dof"], ["flights"], "dof")
    store_merge(counted(11, 31, 2), table, ["adep", "dof"], ["flights"], "dof")
    return stored.result("departures")


@query
def monthly_run_flights(m):
    stored = _Stored(m)
    stored.monthly_run()
    return stored.result("fct_flights")


@query
def monthly_run_aircrafts(m):
    stored = _Stored(m)
    stored.monthly_run()
    return stored.result("dim_aircrafts")


@query
def period_run_events(m):
    stored = _Stored(m)
    stored.period_runs()
    return stored.result("fct_events")


@query
def period_run_arrays(m):
    stored = _Stored(m)
    stored.period_runs()
    return stored.result("agg_yearly_metric_array")


@query
def period_run_airports(m):
    """Airport versions after both runs."""
    stored = _Stored(m)
    stored.period_runs()
    return stored.result("dim_airports")


@query
def period_run_checks(m):
    """Failures of the declared tests after both runs, each of which tested only the days it changed."""
    stored = _Stored(m)
    stored.period_runs()
    return stored.result(stored.warehouse.check_report())
