"""All models over one set of raw tables, built lazily from each other."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from contrail.operators import enrich, staging, trajectory
from contrail.operators.incremental import scd2_columns, snapshot_airports
from contrail.operators.skew import hot_keys
from contrail.session import empty_frame


class Marts:
    """Models as attributes; ``raw`` gives a raw table by name.

    Everything is a plan until an action runs. A pipeline that stores the facts passes the stored
    tables on to the operators instead, see ``contrail.sources.tables``.
    """

    def __init__(self, spark: SparkSession, raw: Callable[[str], DataFrame], now: datetime):
        self.spark = spark
        self.raw = raw
        self.now = now

    @cached_property
    def stg_flights(self) -> DataFrame:
        return staging.stg_flights(self.raw("src_flights"))

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw("src_events"))

    @cached_property
    def stg_measurements(self) -> DataFrame:
        return staging.stg_measurements(self.raw("src_measurements"))

    @cached_property
    def stg_aircrafts(self) -> DataFrame:
        return staging.stg_aircrafts(self.raw("src_aircrafts"))

    @cached_property
    def stg_aircraft_types(self) -> DataFrame:
        return staging.stg_aircraft_types(self.raw("src_aircraft_types"))

    @cached_property
    def stg_airports(self) -> DataFrame:
        return staging.stg_airports(self.raw("src_airports"))

    @cached_property
    def fct_flights(self) -> DataFrame:
        return self.stg_flights

    @cached_property
    def hot_flights(self) -> DataFrame:
        """A count over one column of the staged events."""
        return hot_keys(self.stg_events, "flight_id")

    @cached_property
    def int_events(self) -> DataFrame:
        return enrich.int_events(self.stg_events, self.fct_flights, self.hot_flights)

    @cached_property
    def int_measurements(self) -> DataFrame:
        return enrich.int_measurements(self.stg_measurements)

    @cached_property
    def fct_events(self) -> DataFrame:
        return enrich.fct_events(self.int_events, self.int_measurements)

    @cached_property
    def legs(self) -> DataFrame:
        """Events with predecessors and the day of flight. Reads nothing that ``int_events`` lacks."""
        return trajectory.legs(self.int_events, self.hot_flights, carried=["dof"])

    @cached_property
    def airborne_legs(self) -> DataFrame:
        return trajectory.airborne(self.legs)

    @cached_property
    def view_events_lagged(self) -> DataFrame:
        return self.legs.drop("segment", "dof")

    @cached_property
    def view_events_filtered(self) -> DataFrame:
        return self.airborne_legs.drop("segment", "dof")

    @cached_property
    def view_interpolated_steps(self) -> DataFrame:
        return trajectory.view_interpolated_steps(self.legs)

    @cached_property
    def int_aircraft_types(self) -> DataFrame:
        return enrich.int_aircraft_types(self.stg_aircraft_types)

    @cached_property
    def dim_aircrafts(self) -> DataFrame:
        return enrich.dim_aircrafts(self.stg_aircrafts, self.int_aircraft_types)

    @cached_property
    def scd_airports(self) -> DataFrame:
        """The snapshot's first run: every airport opens a version."""
        nothing = empty_frame(self.spark, scd2_columns(self.stg_airports.schema))
        return snapshot_airports(nothing, self.raw("src_airports"), self.now)

    @cached_property
    def dim_airports(self) -> DataFrame:
        return enrich.dim_airports(self.scd_airports, self.raw("country_codes"))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return enrich.dim_customers(self.raw("stg_customers"), self.raw("country_codes"))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return enrich.fact_orders(self.raw("stg_orders"), self.raw("stg_payments"))

    @cached_property
    def agg_orders(self) -> DataFrame:
        return enrich.agg_orders(self.fact_orders)
