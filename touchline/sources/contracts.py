"""Table contracts of the marts (SNK-6), their checks, and empty typed shells (FLT-9).

A contract names types, required columns, defaults, the key, other unique column groups and
references.  ``violations`` checks any number of tables against theirs in one pass: every
row gives one probe a rule, probes of all tables meet by (rule, key), and one grouping
counts how often a key is owned, referred to or missing.  A hot key is counted before the
shuffle, so it costs a row a task.  Until a rule is found broken it is a number, and a key of
whole numbers stays as it is; texts are made for broken rules only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """Columns that, where none is null, must be found as ``parent_columns`` of another table."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType  # a field that is not nullable is required
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    defaults: tuple[tuple[str, object], ...] = ()  # of columns that are not given; NOW is the write's time

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


NOW = "now()"


_SIMPLE = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
           "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}


def _fields(columns: str) -> list[T.StructField]:
    """``name type [not null]``, separated by a comma and a blank.  (Spark's own DDL reader wants a session.)"""
    out = []
    for column in columns.split(", "):
        name, kind, *rest = column.split()
        of = _SIMPLE.get(kind) or T.DecimalType(*map(int, kind.removeprefix("decimal(").removesuffix(")").split(",")))
        out.append(T.StructField(name, of, not rest))
    return out


def contract(name: str, columns: str, key: Sequence[str] = (), unique: Iterable[Sequence[str]] = (), references: Iterable[Reference] = (),
             defaults: Mapping[str, object] | None = None) -> Contract:
    """A contract from its columns (``name type [not null], ...``); key columns are required."""
    fields = [T.StructField(f.name, f.dataType, f.nullable and f.name not in key) for f in _fields(columns)]
    return Contract(name, T.StructType(fields), tuple(key), tuple(map(tuple, unique)), tuple(references), tuple((defaults or {}).items()))


def _columns(kind: str, names: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names.split())


# FIXED VALUES: names, types, keys, references and defaults of the mart tables.
_SNAPSHOT = ("snapshot_date", "source", "player_id", "season", "week", "scoring_format")
_SNAPSHOT_DDL = "snapshot_date date not null, source string not null, player_id int not null, season int not null, week int not null, scoring_format string not null"
CONTRACTS: dict[str, Contract] = {c.name: c for c in (
    contract("dim_players", "player_id int, full_name string not null, first_name string, last_name string, position string, birthdate date, "
             + _columns("int", "height_inches weight_lbs") + ", college string, " + _columns("int", "draft_year draft_round draft_pick debut_season")
             + ", status string, created_at timestamp_ntz, updated_at timestamp_ntz", ("player_id",), defaults={"created_at": NOW, "updated_at": NOW}),
    contract("player_id_crosswalk", "player_id int not null, source string, source_id string", ("source", "source_id")),
    contract("dim_franchises", "franchise_id int, canonical_name string", ("franchise_id",)),
    contract("dim_teams", "team_id int, franchise_id int, season int not null, abbr string not null, " + _columns("string", "city name conference division"),
             ("team_id",), (("season", "abbr"),), (Reference(("franchise_id",), "dim_franchises", ("franchise_id",)),)),
    contract("player_team_history", "player_id int, team_id int not null, season int, week_start int, week_end int, jersey_number int, depth_chart_pos string",
             ("player_id", "season", "week_start")),
    contract("dim_games", "game_id string, season int not null, week int not null, season_type string, game_date date, kickoff_time timestamp_ntz, "
             + _columns("int", "home_team_id away_team_id home_score away_score") + ", " + _columns("string", "stadium surface roof") + ", "
             + _columns("int", "weather_temp_f weather_wind_mph") + ", weather_desc string", ("game_id",),
             references=(Reference(("home_team_id",), "dim_teams", ("team_id",)), Reference(("away_team_id",), "dim_teams", ("team_id",)))),
    contract("fct_player_game_stats", "player_id int, game_id string, season int not null, week int not null, team_id int, opponent_id int, position string, "
             "offensive_snaps int, offensive_snap_pct decimal(5,2), "
             + _columns("int", "routes_run pass_attempts pass_completions pass_yards pass_tds interceptions sacks_taken pass_air_yards")
             + ", pass_epa decimal(7,3), cpoe decimal(5,2), " + _columns("int", "rush_attempts rush_yards rush_tds")
             + ", rush_yards_before_contact decimal(6,2), rush_yards_over_expected decimal(6,2), "
             + _columns("int", "targets receptions rec_yards rec_tds air_yards yac")
             + ", target_share decimal(5,2), air_yards_share decimal(5,2), avg_separation decimal(4,2), avg_cushion decimal(4,2), "
             + _columns("int", "rz_carries rz_targets inside_5_carries inside_5_targets fumbles fumbles_lost two_pt_conversions")
             + ", ingested_at timestamp_ntz", ("player_id", "game_id"), defaults={"ingested_at": NOW}),
    contract("fct_team_game_stats", "team_id int, game_id string, season int not null, week int not null, opponent_id int, is_home boolean, "
             + _columns("int", "points total_yards pass_yards rush_yards plays") + ", seconds_per_play decimal(4,2), pass_rate decimal(5,2), pace_neutral decimal(5,2), "
             + _columns("int", "points_allowed yards_allowed pass_yards_allowed rush_yards_allowed sacks interceptions"), ("team_id", "game_id")),
    contract("fct_vegas_lines", "game_id string, snapshot_at timestamp_ntz, sportsbook string, spread_home decimal(4,1), spread_away decimal(4,1), total decimal(4,1), "
             + _columns("int", "home_moneyline away_moneyline") + ", home_implied_total decimal(4,1), away_implied_total decimal(4,1)",
             ("game_id", "snapshot_at", "sportsbook")),
    contract("fct_projections", _SNAPSHOT_DDL + ", projected_points decimal(5,2), floor decimal(5,2), ceiling decimal(5,2), proj_pass_yards decimal(6,2), "
             "proj_pass_tds decimal(4,2), proj_rush_yards decimal(6,2), proj_rush_tds decimal(4,2), proj_receptions decimal(5,2), proj_rec_yards decimal(6,2), "
             "proj_rec_tds decimal(4,2)", _SNAPSHOT),
    contract("fct_rankings", _SNAPSHOT_DDL + ", position string, " + _columns("int", "overall_rank position_rank tier"), _SNAPSHOT),
    contract("fct_player_status", "snapshot_date date, player_id int, season int, week int, " + _columns("string", "practice_status game_status injury_description"),
             ("snapshot_date", "player_id")),
    contract("scoring_settings", "scoring_format string, pass_yard_pts decimal(4,3), pass_td_pts decimal(4,1), pass_int_pts decimal(4,1), rush_yard_pts decimal(4,3), "
             "rush_td_pts decimal(4,1), rec_pts decimal(4,1), rec_yard_pts decimal(4,3), rec_td_pts decimal(4,1), fumble_lost_pts decimal(4,1), two_pt_pts decimal(4,1), "
             "bonus_100_rush_yds decimal(4,1), bonus_100_rec_yds decimal(4,1), bonus_300_pass_yds decimal(4,1), te_premium decimal(4,1)", ("scoring_format",),
             defaults={"pass_yard_pts": 0.04, "pass_td_pts": 4.0, "pass_int_pts": -2.0, "rush_yard_pts": 0.1, "rush_td_pts": 6.0, "rec_pts": 1.0, "rec_yard_pts": 0.1,
                       "rec_td_pts": 6.0, "fumble_lost_pts": -2.0, "two_pt_pts": 2.0, "bonus_100_rush_yds": 0.0, "bonus_100_rec_yds": 0.0,
                       "bonus_300_pass_yds": 0.0, "te_premium": 0.0}),
)}


def _key_text(columns: Sequence[str]) -> Column:
    """The values of a key as one text, each with its length, so that no two keys look alike; null if any is null."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t, F.lit(" "))])


def _given(columns: Sequence[str]) -> Column:
    found = F.lit(True)
    for c in columns:
        found = found & F.col(c).isNotNull()
    return found


@dataclass(frozen=True)
class _Probe:
    """What a row says about a rule: one more that counts, or a parent that is there."""

    rule: str
    columns: tuple[str, ...]  # the key; a required column has none
    when: Column
    counts: bool = True


def _probes(name: str, of: Contract, referred: Iterable[tuple[str, Reference]]) -> list[_Probe]:
    return [*(_Probe(f"{name} required {c}", (), F.col(c).isNull()) for c in of.required),
            *(_Probe(f"{name} unique {','.join(c)}", c, _given(c)) for c in (of.key, *of.unique) if c),
            *(_Probe(f"{name} refers {','.join(r.columns)}", r.columns, _given(r.columns)) for r in of.references),
            *(_Probe(f"{child} refers {','.join(r.columns)}", r.parent_columns, _given(r.parent_columns), False) for child, r in referred)]


def _probed(df: DataFrame, probes: Sequence[_Probe], rules: Sequence[str], slots: Mapping[str, int], width: int) -> DataFrame:
    """(rule's number, k0, k1, ..., text, n, parent) of every probe of a table, in one scan; whole-number keys fill the slots, others are a text."""
    out = []
    for p in probes:
        whole = p.columns if p.rule in slots else ()
        keys = [F.col(c).cast("long") for c in whole] + [F.lit(None).cast("long")] * (width - len(whole))
        text = _key_text(p.columns) if p.columns and not whole else F.lit(None).cast("string")
        out.append(F.when(p.when, F.struct(F.lit(rules.index(p.rule)).alias("rule"), *[k.alias(f"k{i}") for i, k in enumerate(keys)], text.alias("text"),
                                           F.lit(int(p.counts)).alias("n"), F.lit(int(not p.counts)).alias("parent"))))
    return df.select(F.explode(F.array(*out)).alias("p")).where("p is not null").select("p.*")


def violations(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """(table, kind, columns, key, n): every broken rule of every table, in one pass over each.

    kind ``required``: n rows have a null there (key null); ``unique``: n rows share the key;
    ``refers``: n rows refer to a key that the parent lacks.  Rows with a null in a unique or
    referring group are not compared there.  A parent that is not among ``tables`` is not
    checked.  Columns that a required rule names must exist.
    """
    probes, widths = {}, {}
    for name, df in tables.items():
        of = contracts[name]
        own = Contract(of.name, of.schema, of.key, of.unique, tuple(r for r in of.references if r.parent in tables))
        probes[name] = _probes(name, own, [(child, r) for child in tables for r in contracts[child].references if r.parent == name])
        for p in probes[name]:  # a key's width, 0 where it is compared as text
            whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in p.columns)
            widths.setdefault(p.rule, set()).add(len(p.columns) if whole else 0)
    rules = list(widths)
    slots = {rule: max(of) for rule, of in widths.items() if len(of) == 1 and max(of)}
    width = max(slots.values(), default=0)
    parts = [_probed(df, probes[name], rules, slots, width) for name, df in tables.items() if probes[name]]
    found = reduce(DataFrame.unionByName, parts)
    keys = [f"k{i}" for i in range(width)]
    counted = found.groupBy("rule", *keys, "text").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    unique = [i for i, rule in enumerate(rules) if rule.split(" ")[1] == "unique"]
    broken = counted.where((F.col("parent") == 0) & (F.col("n") > F.when(F.col("rule").isin(unique), 1).otherwise(0)))
    key = F.col("text")
    if width:
        texts = [F.col(k).cast("string") for k in keys]
        lengths = F.concat_ws("", *[F.concat(F.length(t).cast("string"), F.lit(":"), t, F.lit(" ")) for t in texts])  # without the slots not filled
        key = F.coalesce(key, F.when(F.col("k1").isNull(), texts[0]).otherwise(lengths) if width > 1 else texts[0])
    parts = F.split(F.element_at(F.array(*map(F.lit, rules)), F.col("rule") + 1), " ")
    return broken.select(parts[0].alias("table"), parts[1].alias("kind"), parts[2].alias("columns"), key.alias("key"), "n")


def enforce(df: DataFrame, of: Contract, now: str | None = None) -> DataFrame:
    """The contract's columns, cast, ready to be written: columns not given take their default, and a null in a required one raises.

    As in a database, a default stands in for an absent column only, not for a null.  Text or
    numbers that do not fit a type raise (ANSI casts).  ``now`` is the time that NOW stands for.
    """
    defaults, columns = dict(of.defaults), []
    for f in of.schema.fields:
        if f.name in df.columns:
            value = F.col(f.name)
        elif defaults.get(f.name) == NOW:
            value = F.lit(now) if now else F.current_timestamp()
        else:
            value = F.lit(defaults.get(f.name))
        value = value.cast(f.dataType)
        if not f.nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"{of.name}.{f.name} is required")).cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


# --- shells -------------------------------------------------------------------------------------

#: The projection snapshot as it is computed: points as doubles, before they are stored by ``CONTRACTS``.
FCT_PROJECTIONS = T.StructType([
    T.StructField(f.name, T.LongType() if f.name == "player_id" else T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType, f.nullable)
    for f in CONTRACTS["fct_projections"].schema.fields])
PROJECTION_KEY = _SNAPSHOT
FCT_TEAM_GAME_STATS = CONTRACTS["fct_team_game_stats"].schema


def empty_shell(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """FLT-9: an always-empty relation with the table's typed columns."""
    return spark.createDataFrame([], schema)
