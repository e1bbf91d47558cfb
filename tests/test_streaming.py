from datetime import date

import pytest
from helpers import rows
from pyspark.errors import StreamingQueryException

from contrail.operators import hexagons, trajectory
from contrail.sources import schemas
from contrail.sources.tables import read
from contrail.streaming import ingest


@pytest.fixture
def landing(spark, tmp_path, database):
    class Landing:
        facts, arrays = f"{database}.facts", f"{database}.arrays"
        flights = spark.createDataFrame(
            [(f"f{day}", date(2024, 1, day)) for day in range(1, 31)], "id string, dof date"
        )
        measurements = spark.createDataFrame([("m", "e1", "Time Passed (s)", 7.0, "v")], schemas.MEASUREMENTS)

        def land(self, name, *entries):
            """Raw events given as (id, flight day, hour, longitude)."""
            raw = [
                (i, f"f{d}", "landing", f"2024-01-{d:02} {h:02}:00:00", x, 47.0, 100, "osn", "v", None) for i, d, h, x in entries
            ]
            df = spark.createDataFrame(raw, schemas.EVENTS).coalesce(1)
            df.write.parquet(f"{tmp_path}/in/{name}")

        def run(self, **options):
            stream = ingest.arrivals(spark, f"{tmp_path}/in", schemas.EVENTS, **options)
            handle = ingest.event_batches(self.flights, self.measurements, self.facts, self.arrays)
            return ingest.run_once(stream, handle, f"{tmp_path}/progress")

        def ids(self):
            return [r[0] for r in rows(read(spark, self.facts), "id")]

        def state(self):
            return {r.hex: r.metric_array for r in read(spark, self.arrays).collect()}

    return Landing()


def test_files_are_taken_once_and_late_ones_replace_their_range(spark, landing):
    landing.land("p1", ("e1", 1, 1, 5.0), ("e2", 1, 2, 5.5), ("e3", 3, 1, 5.0), ("e4", 3, 2, 5.1))
    landing.land("p2", ("e5", 11, 1, 5.0), ("e6", 11, 2, 5.0))
    assert landing.run(files_per_batch=1) == 2
    assert landing.run() == 0
    assert landing.ids() == ["e1", "e2", "e3", "e4", "e5", "e6"]
    assert read(spark, landing.facts).where("id = 'e1'").first().time_passed == 7.0
    before = landing.state()
    assert {len(a) for a in before.values()} == {2}

    landing.land("p1_again", ("e1", 1, 1, 5.0), ("e2", 1, 2, 5.5), ("e9", 2, 1, 5.0))
    assert landing.run() == 1
    assert landing.ids() == ["e1", "e2", "e3", "e4", "e5", "e6", "e9"]

    legs = trajectory.airborne(trajectory.legs(read(spark, landing.facts)))
    first = legs.where("event_time < TIMESTAMP_NTZ '2024-01-11'")
    expected = dict(rows(hexagons.hex_traffic(first)))
    assert {h: a[0] for h, a in landing.state().items() if a[0]} == expected


def test_a_backlog_is_taken_delivery_by_delivery(spark, landing):
    """A period and its correction wait together: what is corrected is not stored twice."""
    landing.land("z_first", ("e1", 1, 1, 5.0), ("e2", 1, 2, 5.5), ("e3", 3, 1, 5.0))
    landing.land("a_again", ("e1", 1, 1, 6.0), ("e2", 1, 2, 5.5))
    assert landing.run() == 1
    assert landing.ids() == ["e1", "e2", "e3"]
    assert read(spark, landing.facts).where("id = 'e1'").first().longitude == 6.0


def test_failed_gate_stops_and_the_batch_stays_pending(spark, landing):
    landing.land("p1", ("e1", 1, 1, 5.0))
    assert landing.run() == 1
    landing.land("bad", ("e2", 2, 1, None))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="longitude_is_not_null_check"):
            landing.run()
    assert landing.ids() == ["e1"]


def test_events_before_their_flights_stop(spark, landing):
    landing.flights = landing.flights.where("dof > DATE '2024-01-20'")
    landing.land("p1", ("e1", 1, 1, 5.0))
    with pytest.raises(StreamingQueryException, match="load the flights"):
        landing.run()
