"""The two scheduled runs: monthly flights and aircraft, 10-day events and airports.

Each loads its files, passes the gates, and only then stores; a failed gate leaves every table as it
was. When and in which order runs start is the caller's business; the 10-day run fails while the
flights of its events are not loaded.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.functions.geo import DEFAULT_RESOLUTION
from contrail.operators import enrich, staging
from contrail.operators.accumulate import sum_yearly_metric_array
from contrail.operators.incremental import scd2_columns, snapshot_airports
from contrail.operators.quality import added_up, enforce_gate
from contrail.operators.trajectory import legs, view_events_filtered, view_events_lagged, view_interpolated_steps
from contrail.plans.model_tests import declared
from contrail.sources import schemas
from contrail.sources.files import load_csv, load_parquet
from contrail.sources.tables import open_versions, read, replace, settled, store_months, store_versions
from contrail.streaming.ingest import checks_table, event_batches


@dataclass
class Warehouse:
    """Where the marts are stored. ``csv_formats`` has ``load_csv`` options per source."""

    spark: SparkSession
    database: str
    resolution: int = DEFAULT_RESOLUTION
    csv_formats: dict[str, dict[str, Any]] = field(default_factory=dict)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return read(self.spark, self.name(table))

    def _csv(self, source: str, path: str | list[str]) -> DataFrame:
        schema = {"aircrafts": schemas.AIRCRAFTS, "aircraft_types": schemas.AIRCRAFT_TYPES, "airports": schemas.AIRPORTS}
        raw = load_csv(self.spark, path, schema[source], **self.csv_formats.get(source, {}))
        enforce_gate(raw, schemas.GATED_COLUMNS[source])
        return raw

    def _parquet(self, source: str, path: str | list[str]) -> DataFrame:
        schema = {"flights": schemas.FLIGHTS, "events": schemas.EVENTS, "measurements": schemas.MEASUREMENTS}
        raw = load_parquet(self.spark, path, schema[source])
        enforce_gate(raw, schemas.GATED_COLUMNS[source])
        return raw

    def monthly_run(self, flights: str | list[str], aircrafts: str | list[str], aircraft_types: str | list[str]) -> None:
        """Replace the months of the flight file and rebuild the aircraft dimension."""
        raw_flights = self._parquet("flights", flights)
        raw_aircrafts = self._csv("aircrafts", aircrafts)
        raw_types = self._csv("aircraft_types", aircraft_types)
        store_months(staging.stg_flights(raw_flights), self.name("fct_flights"))
        types = enrich.int_aircraft_types(staging.stg_aircraft_types(raw_types))
        replace(enrich.dim_aircrafts(staging.stg_aircrafts(raw_aircrafts), types), self.name("dim_aircrafts"))

    def period_run(
        self,
        events: str | list[str],
        measurements: str | list[str],
        airports: str | list[str],
        countries: DataFrame,
        now: datetime,
    ) -> None:
        """Replace the day range of the event file, advance the arrays, version the airports."""
        raw_events = self._parquet("events", events)
        raw_measurements = self._parquet("measurements", measurements)
        raw_airports = self._csv("airports", airports)
        handle = event_batches(
            self.table("fct_flights"),
            raw_measurements,
            self.name("fct_events"),
            self.name("agg_yearly_metric_array"),
            self.resolution,
            gated=True,
            checks=declared("fct_events"),
        )
        handle(raw_events, 0)
        self._version_airports(raw_airports, countries, now)

    def check_report(self) -> DataFrame:
        """(test, failures) of the stored events, added up from what the runs counted on the days they changed."""
        facts = self.name("fct_events")
        return added_up(read(self.spark, checks_table(facts)), declared("fct_events"), self.table("fct_events").schema)

    def _version_airports(self, raw_airports: DataFrame, countries: DataFrame, now: datetime) -> None:
        snapshot = self.name("scd_airports")
        schema = scd2_columns(staging.stg_airports(raw_airports).schema)
        # Versions that ended in earlier runs take no part.
        versions = settled(snapshot_airports(open_versions(self.spark, snapshot, schema), raw_airports, now))
        ended = F.col("dbt_valid_to").isNotNull()
        store_versions(versions.where(ended), versions.where(~ended), snapshot)
        replace(enrich.dim_airports(self.table("scd_airports"), countries), self.name("dim_airports"))

    def create_views(self) -> None:
        """Temporary views of the session over the stored facts."""
        events = self.table("fct_events")
        views = {
            "view_events_lagged": view_events_lagged(events),
            "view_events_filtered": view_events_filtered(events),
            "view_interpolated_steps": view_interpolated_steps(legs(events)),
            "sum_yearly_metric_array": sum_yearly_metric_array(self.table("agg_yearly_metric_array")),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(name)
