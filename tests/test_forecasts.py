import datetime as dt
import json

import pytest

from aerowx import contracts as C
from aerowx.plans import forecasts as plan
from aerowx.sources.files import json_documents, parse_documents


def step(text, **more):
    base = {
        "main": {"temp": 50.5, "feels_like": 49, "temp_min": 48.0, "temp_max": 52.25,
                 "pressure": 1012, "sea_level": 1012, "grnd_level": 990, "humidity": 40,
                 "temp_kf": 0.1},
        "weather": [{"id": 500, "main": "Rain", "description": "light rain", "icon": "10d"}],
        "clouds": {"all": 75},
        "wind": {"speed": 3.5, "deg": 200, "gust": 6.1},
        "visibility": 10000,
        "pop": 0,
        "sys": {"pod": "d"},
        "dt_txt": text,
    }
    return {**base, **more}


def document(steps, name="Somewhere"):
    return {
        "cod": "200", "message": 0, "cnt": len(steps), "list": steps,
        "city": {"id": 9, "name": name, "country": "US", "population": 10, "timezone": -14400,
                 "sunrise": 1700000000, "sunset": 1700040000, "coord": {"lat": 0.0, "lon": 0.0}},
    }


@pytest.fixture
def table(spark):
    documents = [
        ("ATL", document([step("2024-03-01 00:00:00", rain={"3h": 1.5}),
                          step("2024-03-01 03:00:00", rain={}),
                          step("2024-03-01 06:00:00", weather=[])])),
        ("DAL", document([step("not a time")])),
        ("EMP", document([])),
        ("XXX", document([step("2024-03-01 03:30:00", rain=None)])),
    ]
    texts = spark.createDataFrame(
        [(c, json.dumps(d)) for c, d in documents], "airport_code string, json string"
    )
    places = spark.createDataFrame(
        [("ATL", (-84.4, 33.6)), ("DAL", (-96.8, 32.8)), ("EMP", (0.0, 0.0))],
        "airport_code string, coordinates struct<lon:double,lat:double>",
    )
    parsed = parse_documents(texts, "json", C.FORECAST_DOCUMENT)
    return plan.forecasts(plan.place_documents(parsed, places)).cache()


def test_contract_and_rows(table):
    assert table.schema.simpleString() == C.FORECASTS.simpleString()
    codes = sorted(r[0] for r in table.select("airport_code").collect())
    assert codes == ["ATL", "ATL", "ATL", "DAL", "XXX"]


def test_code_and_coordinates_replace_the_city(table):
    row = table.where("airport_code = 'ATL'").first()
    assert (row["latitude"], row["longitude"], row["country"]) == (33.6, -84.4, "US")
    assert table.where("airport_code = 'XXX'").first()["latitude"] is None


def test_missing_rain_is_zero(table):
    rain = [r["rain_3hr"] for r in table.where("airport_code = 'ATL'").orderBy("datetime_recorded").collect()]
    assert rain == [1.5, 0.0, 0.0]
    assert table.where("airport_code = 'XXX'").first()["rain_3hr"] == 0.0


def test_empty_weather_and_bad_time_are_null(table):
    assert table.where("weather_main IS NULL").count() == 1
    assert table.where("airport_code = 'DAL'").first()["datetime_recorded"] is None


def test_no_rain_anywhere_still_reads(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([document([step("2024-03-01 00:00:00")])], indent=4))
    read = json_documents(spark, str(tmp_path), C.FORECAST_DOCUMENT)
    assert plan.forecasts(read).first()["rain_3hr"] == 0.0


def test_lookup_by_day_and_hour(table):
    found = plan.forecast_table(table, "ATL", dt.datetime(2024, 3, 1, 3, 15))
    assert found.columns == list(C.FORECAST_LOOKUP_COLUMNS)
    assert [r["datetime_recorded"].hour for r in found.collect()] == [3]
    assert plan.forecast_table(table, "ATL", dt.datetime(2024, 3, 2, 3)).count() == 0


def test_series_of_an_allowed_variable(table):
    one = plan.forecast_series(table, "ATL", "wind_speed").collect()
    assert [r["wind_speed"] for r in one] == [3.5, 3.5, 3.5]
    assert plan.forecast_series(table, None, "humidity").count() == 5
    with pytest.raises(ValueError):
        plan.forecast_series(table, "ATL", "sunrise")
