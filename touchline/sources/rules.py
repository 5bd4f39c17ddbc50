"""Rule tables as data: scoring formats, league rosters, model constants, team metadata.

All of these are tiny, fixed-size literal tables, so broadcasting them is safe
by construction (their size never grows with the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the published rules for results to match.
# ---------------------------------------------------------------------------

# Scoring formats: stat column -> points.  Columns in natural order:
# pass_yard_pts, pass_td_pts, pass_int_pts, rush_yard_pts, rush_td_pts, rec_pts,
# rec_yard_pts, rec_td_pts, fumble_lost_pts, two_pt_pts, bonus_100_rush_yds,
# bonus_100_rec_yds, bonus_300_pass_yds, te_premium
SCORING_COLUMNS = (
    "pass_yard_pts", "pass_td_pts", "pass_int_pts", "rush_yard_pts", "rush_td_pts", "rec_pts",
    "rec_yard_pts", "rec_td_pts", "fumble_lost_pts", "two_pt_pts", "bonus_100_rush_yds",
    "bonus_100_rec_yds", "bonus_300_pass_yds", "te_premium",
)
SCORING_FORMATS = {
    "ppr":       (0.04, 4.0, -2.0, 0.1, 6.0, 1.0, 0.1, 6.0, -2.0, 2.0, 0.0, 0.0, 0.0, 0.0),
    "half_ppr":  (0.04, 4.0, -2.0, 0.1, 6.0, 0.5, 0.1, 6.0, -2.0, 2.0, 0.0, 0.0, 0.0, 0.0),
    "standard":  (0.04, 4.0, -2.0, 0.1, 6.0, 0.0, 0.1, 6.0, -2.0, 2.0, 0.0, 0.0, 0.0, 0.0),
    "my_league": (0.04, 6.0, -2.0, 0.1, 6.0, 1.0, 0.1, 6.0, -2.0, 2.0, 0.0, 0.0, 0.0, 0.5),
}

# Stat (canonical name) -> scoring column that prices it, in scoring order.
POINT_PAIRS = (
    ("pass_yards", "pass_yard_pts"),
    ("pass_tds", "pass_td_pts"),
    ("interceptions", "pass_int_pts"),
    ("rush_yards", "rush_yard_pts"),
    ("rush_tds", "rush_td_pts"),
    ("receptions", "rec_pts"),
    ("rec_yards", "rec_yard_pts"),
    ("rec_tds", "rec_td_pts"),
    ("fumbles_lost", "fumble_lost_pts"),
    ("two_pt", "two_pt_pts"),
)

SKILL_POSITIONS = ("QB", "RB", "WR", "TE")
FLEX_POSITIONS = ("RB", "WR", "TE")
# Flex roster keys in the order they are filled, with the positions each draws from.
FLEX_KEYS = (
    ("FLEX", ("RB", "WR", "TE")),
    ("WRT", ("RB", "WR", "TE")),
    ("REC_FLEX", ("WR", "TE")),
    ("SUPERFLEX", ("QB", "RB", "WR", "TE")),
    ("SFLEX", ("QB", "RB", "WR", "TE")),
    ("QFLEX", ("QB", "RB", "WR", "TE")),
)

# Recency weights (most recent season first) and games weights.
RECENCY = (0.6, 0.3, 0.1)
GAMES_RECENCY = (0.7, 0.3)
MAX_GAMES = 17
# Shrinkage strength per rate.
SHRINK_K = {
    "pass_yards": 250.0,
    "pass_td": 450.0,
    "pass_int": 350.0,
    "rush_yards": 120.0,
    "rush_td": 260.0,
    "rec_catch": 70.0,
    "rec_yards": 70.0,
    "rec_td": 200.0,
}
# Red-zone factor clamp.
RZ_CLAMP = (0.5, 1.8)
# Floor/ceiling band: coefficient of variation per position, fallback, and z.
POSITION_COV = {"QB": 0.43, "RB": 0.57, "WR": 0.56, "TE": 0.54}
DEFAULT_COV = 0.33
BAND_Z = 1.0
# Regular season ends at week 18.
REGULAR_SEASON_MAX_WEEK = 18
# Calibration sweep: seasons need 3 earlier seasons; default sweeps the last 4.
MIN_LOOKBACK = 3
DEFAULT_NUM_SEASONS = 4
# Board defaults.
TIER_FACTOR = 2.0
DEFAULT_LEAGUE = {
    "league_id": "home_league",
    "scoring_format": "ppr",
    "teams": 12,
    "roster": {"QB": 1, "RB": 2, "WR": 2, "TE": 1, "FLEX": 1, "K": 1, "DST": 1, "BENCH": 6},
}
# Team code aliases -> current canonical code (anything else maps to itself).
TEAM_CODE_ALIASES = {
    "OAK": "LV", "SD": "LAC", "STL": "LA", "LAR": "LA", "SL": "LA", "WSH": "WAS",
    "ARZ": "ARI", "BLT": "BAL", "CLV": "CLE", "HST": "HOU", "JAC": "JAX",
}
# Franchises: (franchise_id, canonical_name).
FRANCHISES = (
    (1, "Cardinals"), (2, "Falcons"), (3, "Ravens"), (4, "Bills"), (5, "Panthers"),
    (6, "Bears"), (7, "Bengals"), (8, "Browns"), (9, "Cowboys"), (10, "Broncos"),
    (11, "Lions"), (12, "Packers"), (13, "Texans"), (14, "Colts"), (15, "Jaguars"),
    (16, "Chiefs"), (17, "Chargers"), (18, "Rams"), (19, "Raiders"), (20, "Dolphins"),
    (21, "Vikings"), (22, "Patriots"), (23, "Saints"), (24, "Giants"), (25, "Jets"),
    (26, "Eagles"), (27, "Steelers"), (28, "Seahawks"), (29, "49ers"), (30, "Buccaneers"),
    (31, "Titans"), (32, "Commanders"),
)
# Team metadata: (abbr, franchise_id, city, name, conference, division).
TEAM_META = (
    ("ARI", 1, "Arizona", "Cardinals", "NFC", "West"),
    ("ATL", 2, "Atlanta", "Falcons", "NFC", "South"),
    ("BAL", 3, "Baltimore", "Ravens", "AFC", "North"),
    ("BUF", 4, "Buffalo", "Bills", "AFC", "East"),
    ("CAR", 5, "Carolina", "Panthers", "NFC", "South"),
    ("CHI", 6, "Chicago", "Bears", "NFC", "North"),
    ("CIN", 7, "Cincinnati", "Bengals", "AFC", "North"),
    ("CLE", 8, "Cleveland", "Browns", "AFC", "North"),
    ("DAL", 9, "Dallas", "Cowboys", "NFC", "East"),
    ("DEN", 10, "Denver", "Broncos", "AFC", "West"),
    ("DET", 11, "Detroit", "Lions", "NFC", "North"),
    ("GB", 12, "Green Bay", "Packers", "NFC", "North"),
    ("HOU", 13, "Houston", "Texans", "AFC", "South"),
    ("IND", 14, "Indianapolis", "Colts", "AFC", "South"),
    ("JAX", 15, "Jacksonville", "Jaguars", "AFC", "South"),
    ("KC", 16, "Kansas City", "Chiefs", "AFC", "West"),
    ("LAC", 17, "Los Angeles", "Chargers", "AFC", "West"),
    ("LA", 18, "Los Angeles", "Rams", "NFC", "West"),
    ("LV", 19, "Las Vegas", "Raiders", "AFC", "West"),
    ("MIA", 20, "Miami", "Dolphins", "AFC", "East"),
    ("MIN", 21, "Minnesota", "Vikings", "NFC", "North"),
    ("NE", 22, "New England", "Patriots", "AFC", "East"),
    ("NO", 23, "New Orleans", "Saints", "NFC", "South"),
    ("NYG", 24, "New York", "Giants", "NFC", "East"),
    ("NYJ", 25, "New York", "Jets", "AFC", "East"),
    ("PHI", 26, "Philadelphia", "Eagles", "NFC", "East"),
    ("PIT", 27, "Pittsburgh", "Steelers", "AFC", "North"),
    ("SEA", 28, "Seattle", "Seahawks", "NFC", "West"),
    ("SF", 29, "San Francisco", "49ers", "NFC", "West"),
    ("TB", 30, "Tampa Bay", "Buccaneers", "NFC", "South"),
    ("TEN", 31, "Tennessee", "Titans", "AFC", "South"),
    ("WAS", 32, "Washington", "Commanders", "NFC", "East"),
)
# Foreign id columns carried by the player-hub snapshot, in crosswalk order.
HUB_ID_SOURCES = (
    ("sleeper", "sleeper_id"), ("gsis", "gsis_id"), ("espn", "espn_id"), ("yahoo", "yahoo_id"),
    ("rotowire", "rotowire_id"), ("rotoworld", "rotoworld_id"), ("sportradar", "sportradar_id"),
    ("stats", "stats_id"), ("swish", "swish_id"), ("fantasy_data", "fantasy_data_id"),
    ("oddsjam", "oddsjam_id"),
)
# Closing-line snapshot label.
CLOSING_BOOK = "nflverse_closing"
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

SCORING_SCHEMA = T.StructType(
    [T.StructField("scoring_format", T.StringType(), False)]
    + [T.StructField(c, T.DoubleType(), False) for c in SCORING_COLUMNS]
)


def scoring_settings(spark: SparkSession, formats: list[str] | None = None) -> DataFrame:
    """SRC-13 / DOM-2: the scoring formats as a wide literal table (NULL -> 0.0 already)."""
    names = formats or sorted(SCORING_FORMATS)
    rows = [(n, *[float(v) for v in SCORING_FORMATS[n]]) for n in names]
    return spark.createDataFrame(rows, SCORING_SCHEMA)


def load_scoring_settings(table: DataFrame) -> DataFrame:
    """DOM-2: a stored scoring table as weights: decimals and numbers become doubles, a NULL or missing weight 0.0."""
    weight = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in table.columns else F.lit(0.0).alias(c) for c in SCORING_COLUMNS]
    return table.select("scoring_format", *weight)


def franchises(spark: SparkSession) -> DataFrame:
    """SRC-7: the franchise list as an inline relation."""
    return spark.createDataFrame(list(FRANCHISES), "franchise_id int, canonical_name string")


def team_meta(spark: SparkSession) -> DataFrame:
    """SRC-7: static team metadata keyed by canonical code."""
    return spark.createDataFrame(
        list(TEAM_META),
        "abbr string, franchise_id int, city string, name string, conference string, division string",
    )
