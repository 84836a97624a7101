import json

import pytest

from aerowx import contracts as C
from aerowx.operators.quality import duplicate_keys, too_long
from aerowx.plans import airports as plan


def record(code, country="Canada", **more):
    base = {
        "column_1": code,
        "airport_name": f"{code} field",
        "city_name": "Town",
        "country_name": country,
        "country_code": country[:2].upper(),
        "latitude": 1.5,
        "longitude": -2.5,
        "world_area_code": 7,
        "city_name_geo_name_id": "123",
        "country_name_geo_name_id": "\\N",
        "coordinates": {"lon": -2.5, "lat": 1.5},
    }
    return {**base, **more}


@pytest.fixture
def records(spark, tmp_path):
    already = record(None, "Canada")
    del already["column_1"]
    already["airport_code"] = "OLD"
    pages = [
        [record(f"U{i:02d}", "United States") for i in range(55)],
        [record(f"P{i:02d}", "Peru") for i in range(12)],
        [record("YUB"), already, record("DUP"), record("DUP"), record(None)],
        [],
        [record("FRA", "France")],
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps({"results": page}, indent=2))
    return plan.airport_records(spark, str(tmp_path))


def test_pages_become_typed_rows(records):
    table = plan.airports(records, limits=None)
    assert table.schema.simpleString() == C.AIRPORTS.simpleString()
    assert table.count() == 55 + 12 + 5 + 1
    row = table.where("airport_code = 'YUB'").first()
    assert row["city_name_geo_name_id"] == 123
    assert row["country_name_geo_name_id"] is None
    assert table.where("airport_code = 'OLD'").count() == 1


def test_limits_per_country(records):
    table = plan.airports(records, C.COUNTRY_LIMITS)
    counts = {r["country_name"]: r["count"] for r in table.groupBy("country_name").count().collect()}
    assert counts == {"United States": 50, "Peru": 10, "Canada": 5}
    codes = {r[0] for r in table.where("country_name = 'Peru'").select("airport_code").collect()}
    assert codes == {f"P{i:02d}" for i in range(10)}


def test_map_keeps_unknown_codes_and_drops_wrong_places(records):
    shown = plan.airport_map(plan.airports(records, C.COUNTRY_LIMITS))
    codes = [r["airport_code"] for r in shown.collect()]
    assert "YUB" not in codes
    assert None in codes
    assert shown.columns == list(C.AIRPORT_MAP_COLUMNS)


def test_key_and_length_checks(records):
    table = plan.airports(records, limits=None)
    assert [tuple(r) for r in duplicate_keys(table, "airport_code").collect()] == [("DUP", 2)]
    assert too_long(table, C.AIRPORT_LENGTHS).count() == 0
    # "None field" is the only name over nine letters.
    assert too_long(table, {"airport_name": 9}).count() == 2


def test_fixed_lists():
    assert len(C.EXCLUDED_CODES) == 8
    assert sum(C.COUNTRY_LIMITS.values()) == 160
    assert len(C.STAGING_NAMES) == 17
    assert (len(C.AIRPORTS), len(C.HISTORIC), len(C.FORECASTS)) == (10, 18, 26)
