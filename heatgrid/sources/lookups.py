"""Fixed lookup tables of the station onboarding flow.

These are fixed values that must equal the reference's for identical results:
city name -> balancing authority (BA), state -> primary BA, state -> FIPS code.
They are stated once, in their natural order, and turned into small
DataFrames; each has a size bound by construction, so broadcasting is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heatgrid.sources.local import local_table

# ---- fixed values: city name (lower case) -> BA code
CITY_TO_BA = {
    'new york': 'NYIS',
    'los angeles': 'CISO',
    'chicago': 'PJM',
    'houston': 'ERCO',
    'phoenix': 'AZPS',
    'philadelphia': 'PJM',
    'san antonio': 'ERCO',
    'san diego': 'CISO',
    'dallas': 'ERCO',
    'san jose': 'CISO',
    'austin': 'ERCO',
    'jacksonville': 'JEA',
    'fort worth': 'ERCO',
    'columbus': 'PJM',
    'charlotte': 'DUK',
    'san francisco': 'CISO',
    'indianapolis': 'MISO',
    'seattle': 'SCL',
    'denver': 'PSCO',
    'washington': 'PJM',
    'boston': 'ISNE',
    'el paso': 'EPE',
    'detroit': 'MISO',
    'nashville': 'TVA',
    'portland': 'PGE',
    'memphis': 'TVA',
    'oklahoma city': 'SWPP',
    'las vegas': 'NEVP',
    'louisville': 'LGEE',
    'baltimore': 'PJM',
    'milwaukee': 'MISO',
    'albuquerque': 'PNM',
    'tucson': 'TEPC',
    'fresno': 'CISO',
    'sacramento': 'CISO',
    'kansas city': 'SWPP',
    'long beach': 'CISO',
    'mesa': 'SRP',
    'atlanta': 'SOCO',
    'colorado springs': 'PSCO',
    'miami': 'FPL',
    'raleigh': 'CPLE',
    'omaha': 'MISO',
    'minneapolis': 'MISO',
    'tulsa': 'SWPP',
    'cleveland': 'PJM',
    'wichita': 'SWPP',
    'arlington': 'ERCO',
    'new orleans': 'MISO',
    'bakersfield': 'CISO',
    'tampa': 'TEC',
    'honolulu': 'HECO',
    'aurora': 'PSCO',
    'anaheim': 'CISO',
    'santa ana': 'CISO',
    'st. louis': 'MISO',
    'pittsburgh': 'PJM',
    'corpus christi': 'ERCO',
    'riverside': 'CISO',
    'cincinnati': 'PJM',
    'lexington': 'LGEE',
    'anchorage': 'MEA',
    'stockton': 'CISO',
    'toledo': 'MISO',
    'saint paul': 'MISO',
    'newark': 'PJM',
    'greensboro': 'DUK',
    'plano': 'ERCO',
    'henderson': 'NEVP',
    'lincoln': 'MISO',
    'orlando': 'FPC',
    'jersey city': 'PJM',
    'chula vista': 'CISO',
    'buffalo': 'NYIS',
    'fort wayne': 'MISO',
    'chandler': 'SRP',
    'laredo': 'ERCO',
    'madison': 'MISO',
    'durham': 'CPLE',
    'lubbock': 'ERCO',
    'winston-salem': 'DUK',
    'garland': 'ERCO',
    'glendale': 'SRP',
    'reno': 'NEVP',
    'hialeah': 'FPL',
    'boise': 'IPCO',
    'scottsdale': 'SRP',
    'irving': 'ERCO',
    'chesapeake': 'PJM',
    'north las vegas': 'NEVP',
    'fremont': 'CISO',
    'baton rouge': 'MISO',
    'richmond': 'PJM',
    'san bernardino': 'CISO',
    'spokane': 'AVA',
    'des moines': 'MISO',
    'tacoma': 'TPWR',
    'montgomery': 'SOCO',
    'little rock': 'MISO',
    'salt lake city': 'PACE',
}

# ---- fixed values: state name (lower case) -> primary BA code
STATE_TO_BA = {
    'alabama': 'SOCO',
    'alaska': 'None',
    'arizona': 'AZPS',
    'arkansas': 'MISO',
    'california': 'CISO',
    'colorado': 'PSCO',
    'connecticut': 'ISNE',
    'delaware': 'PJM',
    'district of columbia': 'PJM',
    'florida': 'FPL',
    'georgia': 'SOCO',
    'hawaii': 'HECO',
    'idaho': 'IPCO',
    'illinois': 'PJM',
    'indiana': 'MISO',
    'iowa': 'MISO',
    'kansas': 'SWPP',
    'kentucky': 'LGEE',
    'louisiana': 'MISO',
    'maine': 'ISNE',
    'maryland': 'PJM',
    'massachusetts': 'ISNE',
    'michigan': 'MISO',
    'minnesota': 'MISO',
    'mississippi': 'MISO',
    'missouri': 'MISO',
    'montana': 'NWMT',
    'nebraska': 'MISO',
    'nevada': 'NEVP',
    'new hampshire': 'ISNE',
    'new jersey': 'PJM',
    'new mexico': 'PNM',
    'new york': 'NYIS',
    'north carolina': 'DUK',
    'north dakota': 'MISO',
    'ohio': 'PJM',
    'oklahoma': 'SWPP',
    'oregon': 'PGE',
    'pennsylvania': 'PJM',
    'rhode island': 'ISNE',
    'south carolina': 'SCEG',
    'south dakota': 'MISO',
    'tennessee': 'TVA',
    'texas': 'ERCO',
    'utah': 'PACE',
    'vermont': 'ISNE',
    'virginia': 'PJM',
    'washington': 'SCL',
    'west virginia': 'PJM',
    'wisconsin': 'MISO',
    'wyoming': 'PACE',
}

# ---- fixed values: state name -> two-digit FIPS code
STATE_FIPS = {
    'Alabama': '01',
    'Alaska': '02',
    'Arizona': '04',
    'Arkansas': '05',
    'California': '06',
    'Colorado': '08',
    'Connecticut': '09',
    'Delaware': '10',
    'District of Columbia': '11',
    'Florida': '12',
    'Georgia': '13',
    'Hawaii': '15',
    'Idaho': '16',
    'Illinois': '17',
    'Indiana': '18',
    'Iowa': '19',
    'Kansas': '20',
    'Kentucky': '21',
    'Louisiana': '22',
    'Maine': '23',
    'Maryland': '24',
    'Massachusetts': '25',
    'Michigan': '26',
    'Minnesota': '27',
    'Mississippi': '28',
    'Missouri': '29',
    'Montana': '30',
    'Nebraska': '31',
    'Nevada': '32',
    'New Hampshire': '33',
    'New Jersey': '34',
    'New Mexico': '35',
    'New York': '36',
    'North Carolina': '37',
    'North Dakota': '38',
    'Ohio': '39',
    'Oklahoma': '40',
    'Oregon': '41',
    'Pennsylvania': '42',
    'Rhode Island': '44',
    'South Carolina': '45',
    'South Dakota': '46',
    'Tennessee': '47',
    'Texas': '48',
    'Utah': '49',
    'Vermont': '50',
    'Virginia': '51',
    'Washington': '52',
    'West Virginia': '54',
    'Wisconsin': '55',
    'Wyoming': '56',
}


def city_ba_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(CITY_TO_BA.items()), "city_token string, city_ba string")


def state_ba_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(STATE_TO_BA.items()), "state_key string, state_ba string")


def fips_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(STATE_FIPS.items()), "state string, fips string")


def values_sql(d: dict, cols: tuple[str, str]) -> str:
    """The same table as a SQL VALUES list (used by the oracle)."""
    rows = ", ".join("(%s, %s)" % (_q(k), _q(v)) for k, v in d.items())
    return f"select * from (values {rows}) t({cols[0]}, {cols[1]})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
