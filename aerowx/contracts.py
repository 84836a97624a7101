"""Table contracts, fixed values and defaults shared by the jobs.

Every scan binds one of these schemas, so a missing optional field reads as NULL
and an empty input still has its columns.
"""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def _struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(n, _KINDS[k] if isinstance(k, str) else k) for n, k in fields.items()]
    )


def _fields(text: str) -> T.StructType:
    return _struct(**dict(line.split() for line in text.strip().splitlines()))


AIRPORTS = _fields(
    """
    airport_code string
    airport_name string
    city_name string
    country_name string
    country_code string
    latitude double
    longitude double
    world_area_code int
    city_name_geo_name_id int
    country_name_geo_name_id int
    """
)

# Longest text each airport column may hold.
AIRPORT_LENGTHS = {
    "airport_code": 10,
    "airport_name": 100,
    "city_name": 100,
    "country_name": 100,
    "country_code": 10,
}

HISTORIC = _fields(
    """
    airport_code string
    date_recorded date
    temperature_max float
    temperature_avg float
    temperature_min float
    dew_point_max float
    dew_point_avg float
    dew_point_min float
    humidity_max int
    humidity_avg int
    humidity_min int
    wind_speed_max float
    wind_speed_avg float
    wind_speed_min float
    pressure_max float
    pressure_avg float
    pressure_min float
    precipitation float
    """
)

FORECASTS = _fields(
    """
    airport_code string
    datetime_recorded timestamp_ntz
    temperature double
    feels_like double
    temperature_min double
    temperature_max double
    pressure int
    sea_level int
    ground_level int
    humidity int
    weather_main string
    weather_description string
    clouds_all int
    wind_speed double
    wind_deg int
    wind_gust double
    visibility int
    pop double
    rain_3hr double
    pod string
    country string
    timezone int
    latitude double
    longitude double
    sunrise bigint
    sunset bigint
    """
)
FORECAST_LENGTHS = {"airport_code": 10, "pod": 1, "country": 2}

TABLES = {"airports": AIRPORTS, "historic_weather": HISTORIC, "weather_forecasts": FORECASTS}

# Staging name -> target name of the scraped monthly table (fixed values).
STAGING_NAMES = {
    "Date": "date_recorded",
    "Temperature (°F), max": "temperature_max",
    "Temperature (°F), avg": "temperature_avg",
    "Temperature (°F), min": "temperature_min",
    "Dew Point (°F), max": "dew_point_max",
    "Dew Point (°F), avg": "dew_point_avg",
    "Dew Point (°F), min": "dew_point_min",
    "Humidity (%), max": "humidity_max",
    "Humidity (%), avg": "humidity_avg",
    "Humidity (%), min": "humidity_min",
    "Wind Speed (mph), max": "wind_speed_max",
    "Wind Speed (mph), avg": "wind_speed_avg",
    "Wind Speed (mph), min": "wind_speed_min",
    "Pressure (in), max": "pressure_max",
    "Pressure (in), avg": "pressure_avg",
    "Pressure (in), min": "pressure_min",
    "Precipitation (in)": "precipitation",
}
STAGING = T.StructType([T.StructField(name, T.StringType()) for name in STAGING_NAMES])

_COORDINATES = _struct(lon="double", lat="double")

# One landed page of the airport service.
AIRPORT_PAGE = _struct(
    results=T.ArrayType(
        _struct(
            column_1="string",
            airport_code="string",
            airport_name="string",
            city_name="string",
            country_name="string",
            country_code="string",
            latitude="double",
            longitude="double",
            world_area_code="int",
            city_name_geo_name_id="string",
            country_name_geo_name_id="string",
            coordinates=_COORDINATES,
        )
    )
)

# One landed forecast document.
FORECAST_DOCUMENT = _struct(
    cod="string",
    message="bigint",
    cnt="bigint",
    city=_struct(
        id="bigint",
        name="string",
        country="string",
        population="bigint",
        timezone="int",
        sunrise="bigint",
        sunset="bigint",
        coord=_COORDINATES,
        coordinates=_COORDINATES,
    ),
    list=T.ArrayType(
        _struct(
            main=_struct(
                temp="double",
                feels_like="double",
                temp_min="double",
                temp_max="double",
                pressure="int",
                sea_level="int",
                grnd_level="int",
                humidity="int",
                temp_kf="double",
            ),
            weather=T.ArrayType(
                _struct(id="int", main="string", description="string", icon="string")
            ),
            clouds=_struct(all="int"),
            wind=_struct(speed="double", deg="int", gust="double"),
            visibility="int",
            pop="double",
            rain=_struct(**{"3h": "double"}),
            sys=_struct(pod="string"),
            dt_txt="string",
        )
    ),
)

# A raster as a table: one row per scene, cell and band; a NULL value is a masked pixel.
PIXELS = _fields(
    """
    scene_ts timestamp_ntz
    row int
    col int
    band string
    value double
    """
)

# Fixed values.
FORECAST_VARIABLES = ("temperature", "wind_speed", "visibility", "pressure", "humidity")
HISTORIC_VARIABLES = (
    "temperature_avg",
    "dew_point_avg",
    "humidity_avg",
    "wind_speed_avg",
    "pressure_avg",
)
FORECAST_LOOKUP_COLUMNS = (
    "airport_code",
    "datetime_recorded",
    "temperature",
    "wind_speed",
    "wind_deg",
    "wind_gust",
    "visibility",
    "pop",
    "rain_3hr",
    "weather_description",
)
AIRPORT_MAP_COLUMNS = ("airport_code", "airport_name", "latitude", "longitude", "country_name")

# Airports whose published coordinates are wrong (fixed values).
EXCLUDED_CODES = ("ZWI", "TEH", "OIA", "TCS", "SZL", "PUO", "YUB", "YTK")

# Airports taken per country (fixed values).
COUNTRY_LIMITS = {
    "United States": 50,
    "Canada": 20,
    "Argentina": 20,
    "Brazil": 20,
    "Mexico": 20,
    "Peru": 10,
    "Colombia": 20,
}

# History pages (fixed values): address, error text, and the tables that hold the month.
HISTORY_URL = "https://www.wunderground.com/history/monthly/%s/date/%d-%d"
MISSING_PAGE_TEXT = "Error 404: Page Not Found"
FIRST_HISTORY_TABLE = 3
LAST_HISTORY_TABLE = 9

# Path of one monthly file: code, then year-month, as the whole name (fixed values).
MONTHLY_FILE = r"(?:^|[/\\])([A-Z]+)_([0-9]{4}-[0-9]+)\.parquet$"

# Training-set defaults (fixed values).
NUM_DATES = 15
NUM_BINS = 10
MAX_REQUESTS = 10
MIN_BATCH_SIZE = 20
PATCH_SIZE = 5
MAX_PRECIPITATION = 30
MAX_ELEVATION = 6000
INPUT_HOURS = (-4, -2, 0)
LABEL_HOURS = (2, 6)
LOOKBACK_HOURS = 24
PRECIPITATION_BAND = "precipitationCal"
IMAGER_BANDS = "CMI_C.*"
REGION = ((-140.0, 60.0), (-140.0, -60.0), (-10.0, -60.0), (-10.0, 60.0))

# Map styling breaks (fixed values).
PRECIPITATION_SHOWN_ABOVE = 0.1
PRECIPITATION_PALETTE = (
    "000096",
    "0064ff",
    "00b4ff",
    "33db80",
    "9beb4a",
    "ffeb00",
    "ffb300",
    "ff6400",
    "eb1e00",
    "af0000",
)
PRECIPITATION_STRETCH = (0.0, 20.0)
ELEVATION_PALETTE = (
    "000000",
    "478FCD",
    "86C58E",
    "AFC35E",
    "8F7131",
    "B78D4F",
    "E2B8A6",
    "FFFFFF",
)
ELEVATION_STRETCH = (0.0, 3000.0)
