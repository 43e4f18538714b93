"""Schemas of the layered epidemic-report lake, and its column maps.

Everything in this module is a fixed value: the column names, orders and
types the raw files carry and the trusted / refined tables publish.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, StringType,
    StructField, StructType,
)

# Raw column names of the "general" daily reports (the ones used).
RAW_GENERAL_COLUMNS = [
    "Province_State", "Country_Region", "Last_Update", "Lat", "Long_",
    "Confirmed", "Deaths", "Recovered", "Active", "Incident_Rate",
    "Case_Fatality_Ratio", "Admin2",
]
# Raw column names of the "us" daily reports (the ones used).
RAW_US_COLUMNS = [
    "Province_State", "Country_Region", "Last_Update", "Lat", "Long_",
    "Confirmed", "Deaths", "Recovered", "Active", "Incident_Rate",
    "Mortality_Rate",
]

# Other header names of the same columns, and the columns that some layouts lack.
RAW_ALIASES = {
    "Province_State": ["Province/State"],
    "Country_Region": ["Country/Region"],
    "Last_Update": ["Last Update"],
    "Lat": ["Latitude"],
    "Long_": ["Longitude"],
    "Incident_Rate": ["Incidence_Rate"],
    "Case_Fatality_Ratio": ["Case-Fatality_Ratio"],
    "Mortality_Rate": ["Case_Fatality_Ratio"],
}
RAW_OPTIONAL = ["Lat", "Long_", "Active", "Incident_Rate", "Case_Fatality_Ratio", "Admin2", "Mortality_Rate"]

# Raw -> harmonised names per source.
GENERAL_RENAME = {
    "Province_State": "STATE",
    "Last_Update": "DATE_ID",
    "Country_Region": "COUNTRY",
    "Long_": "LONG",
    "Lat": "LAT",
    "Confirmed": "CONFIRMED",
    "Deaths": "DEATHS",
    "Recovered": "RECOVERED",
    "Active": "ACTIVE",
    "Incident_Rate": "INCIDENT_RATE",
    "Case_Fatality_Ratio": "CASE_FATALITY_RATIO",
}
US_RENAME = {
    "Country_Region": "COUNTRY",
    "Province_State": "STATE",
    "Last_Update": "DATE_ID",
    "Lat": "LAT",
    "Long_": "LONG",
    "Confirmed": "CONFIRMED",
    "Deaths": "DEATHS",
    "Recovered": "RECOVERED",
    "Incident_Rate": "INCIDENT_RATE",
    "Active": "ACTIVE",
    "Mortality_Rate": "CASE_FATALITY_RATIO",
}

# Source tags, tag column, county column of the general source.
SOURCE_COLUMN = "FONTE"
TAG_GENERAL = "GENERAL"
TAG_US = "US"
COUNTY_COLUMN = "Admin2"

# Harmonised columns in order, and their types.
HARMONISED_COLUMNS = [
    "FONTE", "STATE", "COUNTRY", "DATE_ID", "LAT", "LONG", "CONFIRMED",
    "DEATHS", "RECOVERED", "ACTIVE", "INCIDENT_RATE", "CASE_FATALITY_RATIO",
]
HARMONISED_CASTS = {
    "FONTE": "string",
    "STATE": "string",
    "COUNTRY": "string",
    "DATE_ID": "date",
    "LAT": "string",
    "LONG": "string",
    "CONFIRMED": "int",
    "DEATHS": "int",
    "RECOVERED": "int",
    "ACTIVE": "int",
    "INCIDENT_RATE": "decimal(10,0)",
    "CASE_FATALITY_RATIO": "decimal(10,0)",
}

COUNTERS = ["CONFIRMED", "DEATHS", "RECOVERED", "ACTIVE"]
LOCATION = ["STATE", "COUNTRY"]

TRUSTED_COLUMNS = [
    "FONTE", "STATE", "COUNTRY", "DATE_ID", "LAT", "LONG",
    "CONFIRMED_AC", "DEATHS_AC", "RECOVERED_AC", "ACTIVE_AC",
    "INCIDENT_RATE", "CASE_FATALITY_RATIO",
    "CONFIRMED", "DEATHS", "RECOVERED", "ACTIVE",
]

TRUSTED = StructType([
    StructField("FONTE", StringType()),
    StructField("STATE", StringType()),
    StructField("COUNTRY", StringType()),
    StructField("DATE_ID", DateType()),
    StructField("LAT", StringType()),
    StructField("LONG", StringType()),
    StructField("CONFIRMED_AC", IntegerType()),
    StructField("DEATHS_AC", IntegerType()),
    StructField("RECOVERED_AC", IntegerType()),
    StructField("ACTIVE_AC", IntegerType()),
    StructField("INCIDENT_RATE", DecimalType(10, 0)),
    StructField("CASE_FATALITY_RATIO", DoubleType()),
    StructField("CONFIRMED", IntegerType()),
    StructField("DEATHS", IntegerType()),
    StructField("RECOVERED", IntegerType()),
    StructField("ACTIVE", IntegerType()),
])

DIM_LOCATION_COLUMNS = ["LOCATION_KEY", "COUNTRY", "STATE", "LAT", "LONG"]

FACT_COLUMNS = [
    "LOCATION_KEY", "DATE_ID", "FONTE", "CONFIRMED", "DEATHS", "RECOVERED",
    "ACTIVE", "CONFIRMED_AC", "DEATHS_AC", "RECOVERED_AC", "ACTIVE_AC",
    "INCIDENT_RATE", "CASE_FATALITY_RATIO",
]
FACT_PARTITION = "DATE_KEY_PART"

# Listings: what the source offers and what the lake holds.
SOURCE_LISTING = StructType([
    StructField("Cam_Git", StringType()),
    StructField("DATE_KEY", StringType()),
    StructField("Tipo", StringType()),
])
LAKE_LISTING = StructType([
    StructField("Cam_Lake", StringType()),
    StructField("DATE_KEY", StringType()),
])
MISSING_LIST = StructType([StructField("DATE_KEY", StringType())])
