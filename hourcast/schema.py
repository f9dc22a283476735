"""Raw observation schema and column groups.

Fixed values: the 46 observation column names (English and Korean, same order), the columns where a
negative reading is impossible, and the columns always excluded from features. They must equal the
source data layout, so they are stated verbatim.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (source data layout) -------------------------------------------------------
WEATHER_COLUMNS = [
    "ObservationTime", "StationID", "WindDirection",
    "WindSpeed", "GustDirection", "GustSpeed", "GustTime",
    "LocalPressure", "SeaLevelPressure", "PressureTrend",
    "PressureChange", "Temperature", "DewPointTemperature",
    "RelativeHumidity", "VaporPressure",
    "HourlyRainfall", "DailyRainfall", "CumulativeRainfall",
    "RainfallIntensity", "SnowDepth3Hr",
    "DailySnowDepth", "TotalSnowDepth", "CurrentWeatherCode",
    "PastWeatherCode", "WeatherCode",
    "TotalCloudCover", "MidLowCloudCover", "LowestCloudHeight",
    "CloudType", "UpperCloudType",
    "MidCloudType", "LowCloudType", "Visibility", "SunshineDuration",
    "SolarRadiation", "GroundCondition",
    "GroundTemperature", "SoilTemperature5cm",
    "SoilTemperature10cm", "SoilTemperature20cm",
    "SoilTemperature30cm",
    "SeaCondition", "WaveHeight", "MaxWindForce",
    "PrecipitationData", "ObservationType",
]

WEATHER_KOREAN_COLUMNS = [
    "관측시각", "지점번호", "풍향",
    "풍속", "돌풍방향", "돌풍속도",
    "돌풍시각", "현지기압", "해면기압", "기압경향",
    "기압변화량", "기온", "이슬점온도",
    "상대습도", "수증기압", "시간강수량",
    "일강수량", "누적강수량", "강수강도", "3시간적설",
    "일적설", "총적설", "현재날씨코드",
    "과거날씨코드", "일기코드", "전운량",
    "중하층운량", "최저운고", "운형", "상층운형",
    "중층운형", "하층운형", "시정", "일조시간",
    "일사량", "지면상태", "지면온도",
    "5cm지중온도", "10cm지중온도", "20cm지중온도", "30cm지중온도",
    "해면상태", "파고", "최대풍력", "강수자료", "관측유형",
]

# Columns where a negative reading is impossible (clamped to 0).
IMPOSSIBLE_NEGATIVE_COLUMNS = [
    "GustSpeed", "HourlyRainfall", "DailyRainfall", "CumulativeRainfall",
    "RainfallIntensity", "SnowDepth3Hr", "DailySnowDepth", "TotalSnowDepth",
    "LowestCloudHeight", "SunshineDuration", "SolarRadiation",
    "WaveHeight", "MaxWindForce",
]

# Columns always dropped by feature selection.
FIXED_EXCLUDE_COLUMNS = ["WeatherCode", "StationID", "ObservationTime", "CurrentWeatherCode", "PastWeatherCode"]

# Columns dropped from the outlier list on domain grounds.
OUTLIER_DOMAIN_EXCLUDE = ["PastWeatherCode", "ObservationType", "PrecipitationData", "CurrentWeatherCode", "GustTime"]

TIME_PART_COLUMNS = ["year", "month", "day", "hour"]
LEADING_COLUMNS = ["year", "month", "day", "hour", "Temperature"]
MISSING_TOKEN = "-"
MISSING_REPLACEMENT = "Other"
# ------------------------------------------------------------------------------------------------

STRING_COLUMNS = {"StationID", "WeatherCode", "CloudType"}

RAW_SCHEMA = T.StructType(
    [T.StructField("ObservationTime", T.TimestampNTZType())]
    + [
        T.StructField(c, T.StringType() if c in STRING_COLUMNS else T.DoubleType())
        for c in WEATHER_COLUMNS[1:]
    ]
)

PARTITION_COLUMNS = ["year", "month", "day"]


def numeric_columns(schema: T.StructType, exclude=()) -> list[str]:
    """Columns of a numeric Spark type (the dtype split the profiling steps rely on)."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def categorical_columns(schema: T.StructType, exclude=()) -> list[str]:
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
