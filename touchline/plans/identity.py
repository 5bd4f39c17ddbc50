"""Identity resolution: hub snapshot staging, surrogate ids, crosswalk, player dimension.

The hub snapshot (one row per player, carrying foreign ids to many systems) and
the player master (every historical id) are resolved into one internal
``player_id``.  Two reference defects are fixed (SURVEY §4.4 items 1-2): every
new id is minted above the maximum of *both* registries, and a hub player whose
master id is already registered reuses that id instead of splitting in two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.scalars import blank_to_null, clean_id, try_date
from touchline.operators.keys import dense_ids, lowest_per_key, mint_mixed, max_id
from touchline.operators.scan import ordered_scan
from touchline.operators.setops import unpivot_ids, union_first_wins
from touchline.operators.upsert import preserve_created
from touchline.sources import rules

HUB_FOREIGN_IDS = [c for _, c in rules.HUB_ID_SOURCES if c != "sleeper_id"]


def _txt(df: DataFrame, name: str):
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def stage_hub(raw: DataFrame) -> DataFrame:
    """DOM-21 (hub): ids as clean text ('' and '0' -> NULL), typed bio, rows without a name dropped."""
    def try_int(name):
        # D1b: number text rounds half away from zero, blanks and junk become NULL
        return F.round(F.expr(f"try_cast(trim(cast(`{name}` as string)) as double)"), 0).cast("int") if name in raw.columns \
            else F.lit(None).cast("int")
    out = raw.select(
        F.col("player_id").cast("string").alias("sleeper_id"),
        *[clean_id(_txt(raw, c)).alias(c) for c in HUB_FOREIGN_IDS],
        *[blank_to_null(_txt(raw, c)).alias(c) for c in ("first_name", "last_name", "full_name", "position", "team")],
        try_int("age").alias("age"),
        (try_date("birth_date") if "birth_date" in raw.columns else F.lit(None).cast("date")).alias("birth_date"),
        blank_to_null(_txt(raw, "college")).alias("college"),
        try_int("height").alias("height_inches"),
        try_int("weight").alias("weight_lbs"),
        try_int("years_exp").alias("years_exp"),
        blank_to_null(_txt(raw, "status")).alias("status"),
        (F.col("active").cast("boolean") if "active" in raw.columns else F.lit(None).cast("boolean")).alias("active"),
        try_int("search_rank").alias("search_rank"),
        blank_to_null(_txt(raw, "depth_chart_position")).alias("depth_chart_position"),
        try_int("depth_chart_order").alias("depth_chart_order"),
        try_int("number").alias("jersey_number"),
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
    )
    return out.filter(F.col("full_name").isNotNull())


def latest_snapshot_rows(staged: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """FLT-6: rows of the newest snapshot (max over a partition column, joined back as one row)."""
    latest = staged.agg(F.max(col).alias("_latest"))
    return staged.join(F.broadcast(latest), F.col(col) == F.col("_latest"), "left_semi")


def hub_keys(hub: DataFrame, existing: DataFrame | None = None,
             master_keys: DataFrame | None = None) -> DataFrame:
    """WIN-1 / WIN-2: internal ids keyed on the hub id.

    First build: 1..N in key order.  Later builds: existing ids untouched; a new
    hub id whose master id is already registered reuses it; the rest are minted
    above the maximum of both registries.  Returns the full registry.
    """
    if existing is None:
        return dense_ids(hub, "sleeper_id")
    new = hub.select("sleeper_id", "gsis_id").filter(F.col("sleeper_id").isNotNull()) \
        .join(existing.select("sleeper_id"), "sleeper_id", "left_anti")
    if master_keys is None:
        reuse = new.sparkSession.createDataFrame([], "sleeper_id string, _rid long")
        floors = [existing]
    else:
        # an id that a hub row owns is not given again, and each remaining id goes to one hub row, the lowest
        free = master_keys.select("gsis_id", F.col("player_id").alias("_rid")).join(
            existing.select(F.col("player_id").alias("_rid")), "_rid", "left_anti")
        once = lowest_per_key(new.join(free, "gsis_id").select("sleeper_id", "_rid"), ["sleeper_id"], "_rid")
        reuse = lowest_per_key(once, ["_rid"], "sleeper_id").select("sleeper_id", "_rid")
        floors = [existing, master_keys]
    minted = mint_mixed(new, "sleeper_id", reuse, "_rid", floors)
    return existing.select("player_id", "sleeper_id").unionByName(minted)


def master_keys(master: DataFrame, hub_registry: DataFrame, hub: DataFrame,
                existing: DataFrame | None = None) -> DataFrame:
    """WIN-3: master ids reuse the hub's id when the hub carries that id (lowest on
    duplicates); others are minted above every registry's max, numbered among
    the unmatched only.  Returns the full registry (existing rows untouched)."""
    hub_ids = hub.filter(F.col("gsis_id").isNotNull()).select("sleeper_id", "gsis_id") \
        .join(hub_registry, "sleeper_id").select("gsis_id", "player_id")
    reuse = lowest_per_key(hub_ids, ["gsis_id"], "player_id")
    floors = [hub_registry]
    minted = mint_mixed(master.select("gsis_id"), "gsis_id", reuse, "player_id", floors, existing=existing)
    if existing is None:
        return minted
    return existing.select("player_id", "gsis_id").unionByName(minted)


def crosswalk(hub_registry: DataFrame, hub: DataFrame, master_registry: DataFrame, master: DataFrame) -> DataFrame:
    """SET-3 + WIN-4: (source, source_id) -> player_id; one scan unpivots all hub ids;
    the master adds gsis/pfr/espn; duplicates keep the lowest player_id."""
    players = hub_registry.join(hub, "sleeper_id")
    hub_long = unpivot_ids(players, "player_id", list(rules.HUB_ID_SOURCES))
    m = master_registry.join(master, "gsis_id")
    master_long = unpivot_ids(m, "player_id", [("gsis", "gsis_id"), ("pfr", "pfr_id"), ("espn", "espn_id")])
    allx = hub_long.unionByName(master_long)
    return lowest_per_key(allx, ["source", "source_id"], "player_id").select(
        F.col("player_id").cast("long").alias("player_id"), "source", "source_id")


def stage_master(raw: DataFrame) -> DataFrame:
    """The player master's typed bio (text casts with the reference's rounding)."""
    def try_int_txt(name):
        return F.round(F.expr(f"try_cast(trim(cast(`{name}` as string)) as double)"), 0).cast("int") \
            if name in raw.columns else F.lit(None).cast("int")
    return raw.filter(F.col("gsis_id").isNotNull()).select(
        "gsis_id",
        _txt(raw, "display_name").alias("full_name"),
        _txt(raw, "first_name").alias("first_name"),
        _txt(raw, "last_name").alias("last_name"),
        _txt(raw, "position").alias("position"),
        (try_date("birth_date") if "birth_date" in raw.columns else F.lit(None).cast("date")).alias("birthdate"),
        try_int_txt("height").alias("height_inches"),
        try_int_txt("weight").alias("weight_lbs"),
        _txt(raw, "college_name").alias("college"),
        try_int_txt("draft_year").alias("draft_year"),
        try_int_txt("draft_round").alias("draft_round"),
        try_int_txt("draft_pick").alias("draft_pick"),
        try_int_txt("rookie_season").alias("debut_season"),
        F.lower(_txt(raw, "status")).alias("status"),
        _txt(raw, "pfr_id").alias("pfr_id"),
        _txt(raw, "espn_id").alias("espn_id"),
    )


DIM_PLAYER_COLUMNS = ("player_id", "full_name", "first_name", "last_name", "position", "birthdate",
                      "height_inches", "weight_lbs", "college", "draft_year", "draft_round", "draft_pick",
                      "debut_season", "status")


def dim_players(hub_registry: DataFrame, hub: DataFrame, master_registry: DataFrame, master: DataFrame,
                previous: DataFrame | None = None, now: str | None = None, with_timestamps: bool = True) -> DataFrame:
    """SET-1 + JOI-8 + SNK-7: hub bio wins; master bio fills players the hub lacks."""
    hub_rows = hub_registry.join(hub, "sleeper_id").select(
        F.col("player_id").cast("long").alias("player_id"), "full_name", "first_name", "last_name", "position",
        F.col("birth_date").alias("birthdate"), "height_inches", "weight_lbs", "college",
        *[F.lit(None).cast("int").alias(c) for c in ("draft_year", "draft_round", "draft_pick", "debut_season")],
        "status")
    m_rows = master_registry.join(master, "gsis_id").filter(F.col("full_name").isNotNull()).select(
        F.col("player_id").cast("long").alias("player_id"), *DIM_PLAYER_COLUMNS[1:])
    # JOI-8: the master branch excludes every id the hub registry minted
    m_rows = m_rows.join(hub_registry.select(F.col("player_id").cast("long").alias("player_id")),
                         "player_id", "left_anti")
    out = union_first_wins(hub_rows, m_rows, "player_id")
    return preserve_created(out, previous, "player_id", now) if with_timestamps else out


__all__ = ["stage_hub", "latest_snapshot_rows", "hub_keys", "master_keys", "crosswalk", "stage_master",
           "dim_players", "max_id", "ordered_scan"]
