"""Values fixed by the source data formats and the reporting rules."""

from __future__ import annotations

import datetime as dt

# --- fixed values: defaults ------------------------------------------------
DEFAULT_MIN_YEAR = 2010
BOOTSTRAP_PERIOD = dt.date(2010, 1, 1)
REPORTING_THROUGH = dt.date(2025, 12, 31)

# --- fixed values: rows that carry totals next to their components ----------
TOTAL_SECTOR = "Total"
TOTAL_PRODUCER = "Total Electric Power Industry"
TOTAL_SOURCE = "Total"
NATIONAL_STATE = "US-TOTAL"

# --- fixed values: sector order in the wide retail sheet --------------------
SECTORS = ("Residential", "Commercial", "Industrial", "Transportation", "Total")
RETAIL_SHEET = "Monthly-States"
RETAIL_SKIP_ROWS = 3
RETAIL_COLUMNS = 24

# --- fixed values: generation workbook --------------------------------------
NOTES_SHEET = "EnergySource_Notes"
HEADER_SEARCH_ROWS = 15
HEADER_REQUIRED = ("YEAR", "MONTH", "STATE")

# --- fixed values: raw and curated locations --------------------------------
RAW_FOLDER = {
    "climate": "noaa/climate",
    "retail": "eia/retail",
    "generation": "eia/generation",
}
RAW_WORKBOOK = {
    "retail": "HS861M_2010-current",
    "generation": "generation_monthly",
}
CURATED_FOLDER = {
    "climate": "climate",
    "retail": "eia/retail",
    "generation": "eia/generation",
}

# --- fixed values: one climate text file per metric --------------------------
CLIMATE_FILE_PREFIX = {
    "avg_temperature": "climdiv-tmpcst-",
    "cooling_degree_days": "climdiv-cddcst-",
    "heating_degree_days": "climdiv-hddcst-",
    "precipitation": "climdiv-pcpnst-",
}
CLIMATE_ELEMENT = {
    "precipitation": "001",
    "avg_temperature": "002",
    "heating_degree_days": "025",
    "cooling_degree_days": "026",
}
CLIMATE_MISSING = {
    "precipitation": -9.99,
    "avg_temperature": -99.90,
    "heating_degree_days": -9999.0,
    "cooling_degree_days": -9999.0,
}

# --- fixed values: climate state codes ---------------------------------------
CLIMATE_STATES = (
    ("001", "AL", "Alabama"),
    ("002", "AZ", "Arizona"),
    ("003", "AR", "Arkansas"),
    ("004", "CA", "California"),
    ("005", "CO", "Colorado"),
    ("006", "CT", "Connecticut"),
    ("007", "DE", "Delaware"),
    ("008", "FL", "Florida"),
    ("009", "GA", "Georgia"),
    ("010", "ID", "Idaho"),
    ("011", "IL", "Illinois"),
    ("012", "IN", "Indiana"),
    ("013", "IA", "Iowa"),
    ("014", "KS", "Kansas"),
    ("015", "KY", "Kentucky"),
    ("016", "LA", "Louisiana"),
    ("017", "ME", "Maine"),
    ("018", "MD", "Maryland"),
    ("019", "MA", "Massachusetts"),
    ("020", "MI", "Michigan"),
    ("021", "MN", "Minnesota"),
    ("022", "MS", "Mississippi"),
    ("023", "MO", "Missouri"),
    ("024", "MT", "Montana"),
    ("025", "NE", "Nebraska"),
    ("026", "NV", "Nevada"),
    ("027", "NH", "New Hampshire"),
    ("028", "NJ", "New Jersey"),
    ("029", "NM", "New Mexico"),
    ("030", "NY", "New York"),
    ("031", "NC", "North Carolina"),
    ("032", "ND", "North Dakota"),
    ("033", "OH", "Ohio"),
    ("034", "OK", "Oklahoma"),
    ("035", "OR", "Oregon"),
    ("036", "PA", "Pennsylvania"),
    ("037", "RI", "Rhode Island"),
    ("038", "SC", "South Carolina"),
    ("039", "SD", "South Dakota"),
    ("040", "TN", "Tennessee"),
    ("041", "TX", "Texas"),
    ("042", "UT", "Utah"),
    ("043", "VT", "Vermont"),
    ("044", "VA", "Virginia"),
    ("045", "WA", "Washington"),
    ("046", "WV", "West Virginia"),
    ("047", "WI", "Wisconsin"),
    ("048", "WY", "Wyoming"),
    ("049", "HI", "Hawaii"),
    ("050", "AK", "Alaska"),
)

# --- fixed values: state without a climate record ------------------------------
DC_CODE = "DC"
DC_NAME = "District of Columbia"

# --- fixed values: energy source classification ---------------------------------
ENERGY_CATEGORIES = {
    "Renewable": (
        "Geothermal",
        "Hydroelectric Conventional",
        "Other Biomass",
        "Solar Thermal and Photovoltaic",
        "Wind",
        "Wood and Wood Derived Fuels",
    ),
    "Fossil": ("Coal", "Natural Gas", "Other Gases", "Petroleum"),
    "Nuclear": ("Nuclear",),
    "Storage": ("Pumped Storage",),
}
OTHER_CATEGORY = "Other"

# --- fixed values: result row of a passed quality gate ----------------------------
DQ_PASS = ("PASS", "All staging data quality checks passed.")

# --- fixed values: cell texts a spreadsheet reader takes as missing ---------------
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: failed-run alert ------------------------------------------------
ALERT_WINDOW = "15 minutes"
ALERT_EVERY = "5 minutes"
ALERT_THRESHOLD = 1
ALERT_SEVERITY = 2
