from datetime import date

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contrail.sources import files, schemas
from contrail.session import empty_frame, shared_folder


def test_parquet_is_matched_by_name_in_any_case_and_cast(spark, tmp_path):
    path = f"{tmp_path}/flight_events.parquet"
    spark.sql("SELECT 7 AS ALTITUDE, 1.5F AS Longitude, 'e1' AS ID, 'gone' AS other").write.parquet(path)
    df = files.load_parquet(spark, path, schemas.EVENTS)
    assert df.schema == schemas.EVENTS
    row = df.first()
    assert (row.id, row.altitude, row.longitude, row.latitude) == ("e1", 7, 1.5, None)


def test_parquet_files_of_mixed_columns_keep_their_values(spark, tmp_path):
    first, second, both = (f"{tmp_path}/{n}" for n in ("jan", "feb", "both"))
    one = spark.sql("SELECT 'a' AS id, 'X' AS adep")
    two = spark.sql("SELECT 'Y' AS ADES, 'C2' AS Icao24, 'b' AS ID")
    one.write.parquet(first)
    two.write.parquet(second)
    one.write.parquet(both)
    two.select("Icao24", "ADES", F.col("ID").alias("id")).write.mode("append").parquet(both)
    want = [("a", "X", None, None), ("b", None, "Y", "C2")]
    for path in ([first, second], [second, first], [both]):
        df = files.load_parquet(spark, path, schemas.FLIGHTS)
        assert rows(df, "id", "adep", "ades", "icao24") == want


def test_csv_files_have_headers_of_their_own(spark, tmp_path):
    (tmp_path / "one.csv").write_text("icao24,country,registration\nA1,CH,HB1\n")
    (tmp_path / "two.csv").write_text("registration,icao24,country\nHB2,A2,DE\n")
    paths = [f"{tmp_path}/one.csv", f"{tmp_path}/two.csv"]
    df = files.load_csv(spark, paths, schemas.AIRCRAFTS)
    assert rows(df, "icao24", "country", "registration") == [("A1", "CH", "HB1"), ("A2", "DE", "HB2")]
    with pytest.raises(Exception, match="header does not conform"):
        files.load_csv(spark, str(tmp_path), schemas.AIRCRAFTS).collect()


def test_csv_is_matched_by_header(spark, tmp_path):
    file = tmp_path / "airports.csv"
    file.write_text('"ident";"id";"name";"latitude_deg";"elevation_ft"\n"LSZH";7;"Zürich; ""Kloten""";47.5;\n')
    row = files.load_csv(spark, str(file), schemas.AIRPORTS, separator=";").first()
    assert (row.id, row.ident, row.name, row.latitude_deg) == (7, "LSZH", 'Zürich; "Kloten"', 47.5)
    assert row.elevation_ft is None and row.keywords is None


def test_csv_value_of_another_type_fails(spark, tmp_path):
    file = tmp_path / "airports.csv"
    file.write_text("id,ident\nx,LSZH\n")
    with pytest.raises(PySparkException):
        files.load_csv(spark, str(file), schemas.AIRPORTS).collect()


def test_schemas_have_the_declared_widths():
    widths = [len(s) for s in (schemas.FLIGHTS, schemas.EVENTS, schemas.MEASUREMENTS, schemas.AIRPORTS)]
    assert widths == [9, 10, 5, 18]
    assert (len(schemas.AIRCRAFTS), len(schemas.AIRCRAFT_TYPES)) == (31, 8)


def test_file_names():
    assert files.month_file("d/", date(2024, 1, 1)) == "d/flight_list_202401.parquet"
    start, end = next(files.periods(date(2024, 1, 1), date(2024, 1, 31)))
    assert files.period_file("d", start, end) == "d/flight_events_20240101_20240111.parquet"
    assert files.period_file("d", start, end, "measurements") == "d/measurements_20240101_20240111.parquet"
    starts = [s for s, _ in files.periods(date(2024, 1, 1), date(2024, 1, 31))]
    assert starts == [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2024, 1, 31)]


def test_period_comes_from_the_file_name(spark, tmp_path):
    """File names are set by writing one part file and linking it under the expected names."""
    spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/out")
    part = next((tmp_path / "out").glob("part-*.parquet"))
    for path in (
        files.period_file(str(tmp_path), date(2024, 1, 1), date(2024, 1, 11)),
        files.month_file(str(tmp_path), date(2024, 2, 1)),
        f"{tmp_path}/other.parquet",
    ):
        with open(path, "wb") as target:
            target.write(part.read_bytes())
    df = spark.read.parquet(*(str(p) for p in tmp_path.glob("*.parquet")))
    found = {(r.file_start, r.file_end) for r in files.with_file_period(df).collect()}
    assert found == {(date(2024, 1, 1), date(2024, 1, 11)), (date(2024, 2, 1), date(2024, 3, 1)), (None, None)}


def test_raw_table_is_replaced(spark, database):
    name = f"{database}.raw"
    files.replace_raw_table(spark.range(3), name)
    assert files.replace_raw_table(spark.range(2).withColumnRenamed("id", "x"), name).columns == ["x"]
    assert spark.table(name).count() == 2


def test_empty_frame_is_known_to_be_empty(spark):
    plan = empty_frame(spark, schemas.EVENTS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation <empty>")


def test_shared_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark, "x")
    assert configured is None or folder.startswith(configured.rstrip("/"))
    assert shared_folder(spark, "x") != folder
