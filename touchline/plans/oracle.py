"""DuckDB SQL twins of the graded queries.

Each string runs on the raw views (region, nation, customer, supplier, part,
orders, lineitem, events, ...) and must return the same columns, names and
values as the Spark query of the same name.  Doubles are printed in exponent
form so DuckDB reads them as DOUBLE (a plain ``0.6`` would be a DECIMAL).
"""

from __future__ import annotations

from touchline.plans import binding
from touchline.plans.projection import (
    ACTUAL_FIELDS, BASELINE_RATES, PER_GAME_FIELDS, TOTAL_FIELDS, WEIGHTED_FIELDS,
    recency_weight_table,
)
from touchline.sources import rules

SKILL = ", ".join(f"'{p}'" for p in rules.SKILL_POSITIONS)


def d(v: float) -> str:
    """A double literal DuckDB parses exactly."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def case_map(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {d(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def scoring_values() -> str:
    cols = ", ".join(("scoring_format",) + rules.SCORING_COLUMNS)
    rows = ",\n    ".join(
        "(" + ", ".join([f"'{n}'"] + [d(v) for v in vals]) + ")"
        for n, vals in sorted(rules.SCORING_FORMATS.items()))
    return f"scoring_settings AS (SELECT * FROM (VALUES\n    {rows}) AS t({cols}))"


def score_sql(inputs: dict[str, str], position: str | None, s: str = "ss") -> str:
    pts = d(0.0)
    for stat, wcol in rules.POINT_PAIRS:
        pts = f"({pts} + coalesce({inputs[stat]}, {d(0.0)}) * {s}.{wcol})"
    if position is not None:
        pts = (f"CASE WHEN {position} = 'TE' THEN ({pts} + coalesce({inputs['receptions']}, {d(0.0)})"
               f" * {s}.te_premium) ELSE {pts} END")
    return pts


def mode_cte(name: str, src: str, keys: list[str], value: str, where: str = "TRUE") -> str:
    """Most frequent ``value`` per ``keys``; ties go to the lowest value."""
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, {value} AS mode_value FROM (
    SELECT {k}, {value}, row_number() OVER (PARTITION BY {k} ORDER BY n DESC, {value} ASC) AS rn
    FROM (SELECT {k}, {value}, count(*) AS n FROM {src} WHERE {where} GROUP BY {k}, {value}) c
  ) r WHERE rn = 1
)"""


def season_totals_ctes(name: str = "season_totals", where: str = f"position IN ({SKILL})",
                       by_season: bool = True, fields=TOTAL_FIELDS) -> str:
    keys = ["player_id", "season"] if by_season else ["player_id"]
    k = ", ".join(keys)
    join = " AND ".join(f"m.{x} = g.{x}" for x in keys)
    sums = ",\n    ".join(f"CAST(sum(coalesce(g.{src}, 0)) AS DOUBLE) AS {n}" for n, src in fields)
    return f"""{mode_cte(name + '_mode', 'player_games', keys, 'position', where)},
{name} AS (
  SELECT {', '.join('g.' + x for x in keys)}, m.mode_value AS position, count(*) AS games,
    {sums}
  FROM player_games g JOIN {name}_mode m ON {join}
  WHERE {where.replace('position', 'g.position').replace('week', 'g.week')}
  GROUP BY {', '.join('g.' + x for x in keys)}, m.mode_value
)"""


def _weight_case(table: dict, n: str, rk: str) -> str:
    whens = " ".join(f"WHEN {n} = {a} AND {rk} = {b} THEN {d(w)}" for (a, b), w in table.items())
    return f"CASE {whens} ELSE {d(0.0)} END"


def _shrink(num: str, den: str, base: str, k: float) -> str:
    alpha = f"({den} / ({den} + {d(k)}))"
    return f"(CASE WHEN {den} <= 0 THEN {base} ELSE ({alpha} * ({num} / {den}) + ({d(1.0)} - {alpha}) * {base}) END)"


def _rz(rz: str, opp: str, base: str) -> str:
    lo, hi = rules.RZ_CLAMP
    return (f"(CASE WHEN {opp} <= 0 OR {base} <= 0 THEN {d(1.0)} ELSE "
            f"greatest({d(lo)}, least({d(hi)}, ({rz} / {opp}) / {base})) END)")


def projection_ctes(target_filter: str = "TRUE", totals: str = "season_totals") -> str:
    """CTEs ``win``, ``baselines``, ``lines`` mirroring plans.projection.project_lines."""
    nums = sorted({n for _, n, _ in BASELINE_RATES} | {dd for *_, dd in BASELINE_RATES})
    base_sums = ", ".join(f"sum({c}) AS {c}" for c in nums)
    base_rates = ",\n    ".join(
        f"coalesce({num} / nullif({den}, 0), {d(0.0)}) AS b_{name}" for name, num, den in BASELINE_RATES)
    w = _weight_case(recency_weight_table(rules.RECENCY), "n", "rk")
    gw = _weight_case(recency_weight_table(rules.GAMES_RECENCY), f"least(n, {len(rules.GAMES_RECENCY)})", "rk")
    pg = ",\n    ".join(f"sum(w * {f} / games) AS {f}_pg" for f in PER_GAME_FIELDS)
    wt = ",\n    ".join(f"sum(w * {f}) AS w_{f}" for f in WEIGHTED_FIELDS)
    b = {name: f"coalesce(b.b_{name}, {d(0.0)})" for name, _, _ in BASELINE_RATES}
    k = rules.SHRINK_K
    wg = f"(CASE WHEN x.wg = 0 THEN {d(1.0)} ELSE x.wg END)"
    games = f"greatest({d(1.0)}, least({d(float(rules.MAX_GAMES))}, x.g_raw))"
    return f"""win AS (
  SELECT t.*, t.season + k.k AS target
  FROM {totals} t CROSS JOIN (VALUES (1), (2), (3)) AS k(k)
  WHERE t.games > 0 AND ({target_filter.replace('target', '(t.season + k.k)')})
),
baselines AS (
  SELECT target, position,
    {base_rates}
  FROM (SELECT target, position, {base_sums} FROM win GROUP BY target, position) s
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY target, player_id ORDER BY season DESC) AS rk,
    count(*) OVER (PARTITION BY target, player_id) AS n
  FROM win
),
weighted AS (SELECT *, {w} AS w, {gw} AS gw FROM ranked),
blend AS (
  SELECT target, player_id, arg_max(position, season) AS position, sum(w) AS wg,
    sum(gw * games) AS g_raw,
    {pg},
    {wt}
  FROM weighted GROUP BY target, player_id
),
rates AS (
  SELECT x.target, x.player_id, x.position,
    {games} AS games_raw,
    (x.pass_att_pg / {wg} * {games}) AS v_pass_att,
    (x.rush_att_pg / {wg} * {games}) AS v_rush_att,
    (x.targets_pg / {wg} * {games}) AS v_targets,
    (x.fumbles_lost_pg / {wg} * {games}) AS fumbles_lost,
    (x.two_pt_pg / {wg} * {games}) AS two_pt,
    {_shrink('x.w_pass_yards', 'x.w_pass_att', b['yards_per_att'], k['pass_yards'])} AS ypa,
    {_shrink('x.w_pass_tds', 'x.w_pass_att', b['td_per_att'], k['pass_td'])} AS td_att,
    {_shrink('x.w_interceptions', 'x.w_pass_att', b['int_per_att'], k['pass_int'])} AS int_att,
    {_shrink('x.w_rush_yards', 'x.w_rush_att', b['yards_per_carry'], k['rush_yards'])} AS ypc,
    ({_shrink('x.w_rush_tds', 'x.w_rush_att', b['rush_td_per_carry'], k['rush_td'])}
      * {_rz('x.w_rz_carries', 'x.w_rush_att', b['rz_carry_rate'])}) AS rush_td_rate,
    {_shrink('x.w_receptions', 'x.w_targets', b['catch_rate'], k['rec_catch'])} AS catch,
    {_shrink('x.w_rec_yards', 'x.w_targets', b['yards_per_target'], k['rec_yards'])} AS ypt,
    ({_shrink('x.w_rec_tds', 'x.w_targets', b['rec_td_per_target'], k['rec_td'])}
      * {_rz('x.w_rz_targets', 'x.w_targets', b['rz_target_rate'])}) AS rec_td_rate
  FROM blend x LEFT JOIN baselines b ON b.target = x.target AND b.position = x.position
),
lines AS (
  SELECT target AS season, player_id, position, round(games_raw, 1) AS games,
    v_pass_att * ypa AS proj_pass_yards,
    v_pass_att * td_att AS proj_pass_tds,
    v_rush_att * ypc AS proj_rush_yards,
    v_rush_att * rush_td_rate AS proj_rush_tds,
    v_targets * catch AS proj_receptions,
    v_targets * ypt AS proj_rec_yards,
    v_targets * rec_td_rate AS proj_rec_tds,
    v_pass_att * int_att AS interceptions,
    fumbles_lost, two_pt
  FROM rates
)"""


LINE_INPUTS = {
    "pass_yards": "l.proj_pass_yards", "pass_tds": "l.proj_pass_tds", "interceptions": "l.interceptions",
    "rush_yards": "l.proj_rush_yards", "rush_tds": "l.proj_rush_tds", "receptions": "l.proj_receptions",
    "rec_yards": "l.proj_rec_yards", "rec_tds": "l.proj_rec_tds", "fumbles_lost": "l.fumbles_lost",
    "two_pt": "l.two_pt",
}


def band_sql(points: str, position: str, games: str) -> tuple[str, str]:
    cov = case_map(position, rules.POSITION_COV, d(rules.DEFAULT_COV))
    spread = f"({d(rules.BAND_Z)} * ({cov} * sqrt({d(float(rules.MAX_GAMES))} / greatest({d(1.0)}, {games}))))"
    return (f"greatest({d(0.0)}, {points} * ({d(1.0)} - {spread}))", f"{points} * ({d(1.0)} + {spread})")


def with_base(*ctes: str) -> str:
    return "WITH " + binding.sql_player_games() + ",\n" + scoring_values() + (
        ",\n" + ",\n".join(ctes) if ctes else "")


