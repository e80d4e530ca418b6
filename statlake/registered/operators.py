"""Operators over whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from statlake import functions as S
from statlake.functions.naming import leaderboard_name, rename_by, short_name
from statlake.operators import joins, match, merge, ranking, scope, unions
from statlake.plans import leaderboards
from statlake.plans.loads import SPIN_TYPES
from statlake.registered.base import Registry, Tables, key_sql, with_inputs
from statlake.sources.payloads import json_record, json_value
from statlake.streaming import cursors, status

REGISTRY = Registry()
_MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def _money(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)"))


# ---- projections and filters -----------------------------------------------------------

@REGISTRY.add(
    "rename_and_cast",
    """
    SELECT o_orderkey AS game_id, o_orderstatus AS league_id, CAST(o_totalprice AS VARCHAR) AS price_text,
      CAST(CAST(o_totalprice AS DECIMAL(18,3)) AS DOUBLE) AS price FROM orders
    """,
)
def _(t: Tables):
    price = F.col("o_totalprice").cast("string")
    return unions.project(
        t.orders,
        {
            "game_id": F.col("o_orderkey"),
            "league_id": F.col("o_orderstatus"),
            "price_text": price,
            "price": S.parse_decimal(price),
        },
    )


@REGISTRY.add("star_except", "SELECT * EXCLUDE (l_tax, l_shipdate) FROM lineitem")
def _(t: Tables):
    return t.lineitem.drop("l_tax", "l_shipdate")


@REGISTRY.add(
    "lateral_alias",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) + l_linenumber AS reached,
      (CAST(l_quantity AS BIGINT) + l_linenumber) * 2 AS reached_twice FROM lineitem
    """,
)
def _(t: Tables):
    return t.lineitem.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "cast(l_quantity as bigint) + l_linenumber AS reached",
        "reached * 2 AS reached_twice",
    )


@REGISTRY.add(
    "label_if_absent",
    "SELECT *, '2024' AS year FROM customer",
)
def _(t: Tables):
    return unions.label_if_absent(t.customer, {"year": 2024, "c_name": "kept as it is"})


@REGISTRY.add(
    "negated_filter",
    "SELECT * EXCLUDE (o_orderdate) FROM orders WHERE NOT (year(o_orderdate) >= 1998 AND o_orderstatus = 'F')",
)
def _(t: Tables):
    drop = (F.year("o_orderdate") >= 1998) & (F.col("o_orderstatus") == "F")
    return t.orders.where(~drop).drop("o_orderdate")


@REGISTRY.add(
    "text_year_filter",
    with_inputs("SELECT playerid, yearid, votes FROM raw_hall_of_fame WHERE TRY_CAST(yearid AS INTEGER) = 1997"),
)
def _(t: Tables):
    rows = t.raw_hall_of_fame.where(scope.text_year_is(F.col("yearid"), 1997))
    return rows.select("playerid", "yearid", "votes")


@REGISTRY.add(
    "null_key_drop",
    with_inputs("SELECT lahman_id, person_id FROM lookup WHERE person_id IS NOT NULL AND lahman_id IS NOT NULL"),
)
def _(t: Tables):
    return t.lookup.dropna(subset=["person_id", "lahman_id"]).select("lahman_id", "person_id")


@REGISTRY.add(
    "header_rows_dropped",
    "SELECT event_id, event_type FROM events WHERE event_type <> 'view'",
)
def _(t: Tables):
    return t.events.where(F.col("event_type") != "view").select("event_id", "event_type")


@REGISTRY.add(
    "date_scope",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1999-01-01'
    """,
)
def _(t: Tables):
    wanted = scope.make_scope(earliest=1995, today=dt.date(2001, 8, 1), start_season=1996, end_season=1998)
    return t.orders.where(scope.in_dates(F.col("o_orderdate"), scope.scope_dates(wanted))).select(
        "o_orderkey", "o_custkey"
    )


@REGISTRY.add(
    "season_scope",
    with_inputs("SELECT playerid, season, war FROM raw_fg_batting WHERE season BETWEEN 1995 AND 1997"),
)
def _(t: Tables):
    wanted = scope.make_scope(earliest=1995, today=dt.date(2001, 8, 1), start_season=1995, end_season=1997)
    return t.raw_fg_batting.where(scope.in_seasons(F.col("season"), wanted.seasons)).select(
        "playerid", "season", "war"
    )


@REGISTRY.add(
    "name_subset",
    """
    SELECT 'customer' AS resource, CAST(count(*) AS BIGINT) AS row_count FROM customer
    UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM orders
    """,
)
def _(t: Tables):
    available = {name: getattr(t, name) for name in ("customer", "orders", "lineitem")}
    chosen = scope.choose_resources(available, ["customer", "orders"])
    counts = {name: df.agg(F.count(F.lit(1)).alias("row_count")) for name, df in chosen.items()}
    return unions.union_labelled(counts, "resource")


# ---- joins -----------------------------------------------------------------------------

@REGISTRY.add(
    "left_enrich",
    """
    SELECT s_suppkey, s_name, n_name, r_name FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def _(t: Tables):
    found = joins.left_enrich(t.supplier, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    found = joins.left_enrich(found, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return found.select("s_suppkey", "s_name", "n_name", "r_name")


@REGISTRY.add(
    "left_enrich_shuffled",
    with_inputs("SELECT o_orderkey, o_custkey, person_id FROM orders LEFT JOIN crosswalk ON o_custkey = fangraphs_id"),
)
def _(t: Tables):
    found = joins.left_enrich(t.orders, t.crosswalk, {"o_custkey": "fangraphs_id"}, ["person_id"], strategy="merge")
    return found.select("o_orderkey", "o_custkey", "person_id")


@REGISTRY.add(
    "inner_enrich",
    """
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def _(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey")
    return joins.inner_enrich(orders, t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment"])


_ROLES_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, b.n_name AS batter_nation, p.n_name AS pitcher_nation
    FROM lineitem LEFT JOIN nation b ON l_suppkey % 25 = b.n_nationkey
    LEFT JOIN nation p ON l_partkey % 31 = p.n_nationkey
"""


def _roles(t: Tables, strategy: str | None = None, dimension=None):
    fact = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "cast(l_suppkey % 25 as int) AS batter", "cast(l_partkey % 31 as int) AS pitcher",
    )
    roles = {"batter": "batter_nation", "pitcher": "pitcher_nation"}
    names = t.nation if dimension is None else dimension
    return joins.resolve_roles(fact, names, roles, "n_nationkey", "n_name", strategy).drop("batter", "pitcher")


REGISTRY.add("role_playing_joins", _ROLES_SQL)(_roles)
REGISTRY.add("role_playing_joins_shuffled", _ROLES_SQL)(lambda t: _roles(t, "merge"))

# A dimension whose keys repeat, some of them with a null value.
_REPEATED = """
    SELECT n_nationkey, n_name FROM nation
    UNION ALL SELECT s_nationkey, CASE WHEN s_suppkey % 4 > 0 THEN s_name END FROM supplier WHERE s_suppkey <= 12
"""
_REPEATED_SQL = f"""
    WITH people AS ({_REPEATED}) {_ROLES_SQL.replace('JOIN nation', 'JOIN people')}
"""
REGISTRY.add("role_playing_repeated_ids", _REPEATED_SQL)(lambda t: _roles(t, None, t.sql(_REPEATED)))
REGISTRY.add("role_playing_repeated_ids_shuffled", _REPEATED_SQL)(lambda t: _roles(t, "merge", t.sql(_REPEATED)))


@REGISTRY.add(
    "conditional_key_join",
    with_inputs("""
    SELECT event_id, event_type, user_id, person_id FROM events LEFT JOIN crosswalk
      ON 'b' || user_id = CASE event_type WHEN 'purchase' THEN baseball_reference_id
        WHEN 'click' THEN replace(baseball_reference_minor_league_id, 'm', 'b') END
    """),
)
def _(t: Tables):
    events = t.events.select(
        "event_id", "event_type", "user_id", F.concat(F.lit("b"), F.col("user_id").cast("string")).alias("player_id")
    )
    people = t.crosswalk.withColumn(
        "minor_id", F.replace("baseball_reference_minor_league_id", F.lit("m"), F.lit("b"))
    )
    found = joins.conditional_key_enrich(
        events, people, "event_type", "player_id",
        {"purchase": "baseball_reference_id", "click": "minor_id"}, ["person_id"],
    )
    return found.drop("player_id")


@REGISTRY.add(
    "two_key_join",
    with_inputs("""
    SELECT o_orderkey, i.franchID AS franchise FROM orders
    LEFT JOIN raw_team_ids i ON 'T' || (o_custkey % 30) = i.teamID AND CAST(year(o_orderdate) AS VARCHAR) = i.yearID
    """),
)
def _(t: Tables):
    orders = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("T"), (F.col("o_custkey") % 30).cast("string")).alias("team"),
        F.year("o_orderdate").cast("string").alias("year"),
    )
    found = joins.left_enrich(
        orders, t.raw_team_ids, {"team": "teamID", "year": "yearID"}, {"franchID": "franchise"}
    )
    return found.select("o_orderkey", "franchise")


# Size ranges as they may come: overlapping (the first wins) and with gaps.
_RANGES = [("ECONOMY", 1, 1, 9, 72), ("ECONOMY", 2, 8, 20, 63), ("STANDARD", 1, 5, 30, 40), ("PROMO", 1, 31, 31, 5)]


@REGISTRY.add(
    "range_lookup",
    f"""
    WITH ranges(kind, position, first, last, rounds) AS (VALUES {', '.join(str(r) for r in _RANGES)})
    SELECT p_partkey, p_type, p_size, COALESCE((
      SELECT rounds FROM ranges WHERE kind = p_type AND p_size BETWEEN first AND last ORDER BY position LIMIT 1), 0)
      AS rounds
    FROM part
    """,
)
def _(t: Tables):
    ranges = t.spark.createDataFrame(_RANGES, "p_type string, position int, start int, end int, rounds int")
    found = joins.range_value(t.part, ranges, ["p_type"], "p_size", "rounds", "rounds")
    return found.select("p_partkey", "p_type", "p_size", "rounds")


# No other name shares more letters with a name and a digit than the name itself.
@REGISTRY.add(
    "best_match",
    """
    SELECT p_partkey, p_type AS season, p_name || CAST(p_partkey % 10 AS VARCHAR) AS team,
      max(p_partkey) OVER (PARTITION BY p_type, p_name) AS best_part, TRUE AS is_matched
    FROM part
    """,
)
def _(t: Tables):
    digit = (F.col("p_partkey") % 10).cast("string")
    wanted = t.part.select("p_partkey", F.col("p_type").alias("season"), F.concat("p_name", digit).alias("team"))
    candidates = t.part.select(
        F.col("p_type").alias("season"), F.col("p_name").alias("team"),
        F.col("p_partkey").alias("place"), F.col("p_partkey").alias("best_part"),
    )
    return match.best_matches(wanted, candidates, "season", "team", "place", ["best_part"])


@REGISTRY.add(
    "scope_grid",
    """
    SELECT leg, is_postseason, CAST(season AS INTEGER) AS season, CAST(count(o_orderkey) AS BIGINT) AS orders_seen
    FROM (VALUES ('REG', FALSE), ('WC', TRUE), ('DS', TRUE), ('CS', TRUE), ('WS', TRUE), ('POST', TRUE))
      legs(leg, is_postseason), generate_series(1994, 2002) s(season)
    LEFT JOIN orders ON year(o_orderdate) = season GROUP BY ALL
    """,
)
def _(t: Tables):
    legs = leaderboards.leg_dimension(t.spark).select("leg", "is_postseason")
    grid = scope.scope_grid(t.spark, (1994, 2002), legs)
    seen = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("o_orderkey").alias("orders_seen"))
    found = joins.left_enrich(grid, seen, {"season": "year"}, ["orders_seen"])
    return found.withColumn("orders_seen", F.coalesce("orders_seen", F.lit(0)))


# ---- aggregates ------------------------------------------------------------------------

@REGISTRY.add(
    "sum_group_two_keys",
    f"""
    SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, {_MONEY.format('l_extendedprice')} AS value
    FROM lineitem GROUP BY ALL
    """,
)
def _(t: Tables):
    return t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        _money("l_extendedprice").alias("value")
    )


@REGISTRY.add(
    "top_one",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
    """,
)
def _(t: Tables):
    best = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return ranking.first_per_key(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], best)


@REGISTRY.add(
    "group_field_counts",
    """
    SELECT p_type, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (p_size > 25) AS BIGINT) AS matched,
      CAST(count(*) FILTER (p_size <= 25) AS BIGINT) AS unmatched FROM part GROUP BY p_type
    """,
)
def _(t: Tables):
    return t.part.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("p_size") > 25).alias("matched"),
        F.count_if(F.col("p_size") <= 25).alias("unmatched"),
    )


@REGISTRY.add(
    "failed_slices",
    """
    SELECT year, type, array_to_string(list_sort(list(round)), ',') AS rounds FROM (
      SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS type, l_linenumber AS round
      FROM lineitem WHERE l_discount > 0.08) GROUP BY ALL
    """,
)
def _(t: Tables):
    failures = t.lineitem.where(F.col("l_discount") > 0.08).select(
        F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("type"), F.col("l_linenumber").alias("round")
    )
    rounds = F.array_join(F.transform("rounds", lambda r: r.cast("string")), ",")
    return cursors.failed_slices(failures).withColumn("rounds", rounds)


# ---- windows, sort, sets ---------------------------------------------------------------

@REGISTRY.add(
    "tie_row_number",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey, o_orderkey) AS unique_id FROM orders
    """,
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    order = [F.col("o_custkey"), F.col("o_orderkey")]
    slices = [F.floor(F.col("o_custkey") / 100)]
    return ranking.number_rows(rows, ["o_orderstatus"], order, slices, "unique_id")


@REGISTRY.add(
    "running_index",
    """
    SELECT event_id, user_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS VARCHAR) AS event_index FROM events
    """,
)
def _(t: Tables):
    events = t.events.select("event_id", "user_id", "ts")
    order = [F.col("ts"), F.col("event_id")]
    numbered = ranking.running_index(events, "user_id", order, [F.to_date("ts")], "event_index")
    return numbered.drop("ts")


@REGISTRY.add(
    "sorted_limit",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_totalprice, o_orderkey LIMIT 10
    """,
)
def _(t: Tables):
    rows = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    return rows.orderBy("o_totalprice", "o_orderkey").limit(10)


@REGISTRY.add(
    "union_labelled",
    """
    SELECT 'player' AS type, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'manager', s_suppkey, s_name FROM supplier
    """,
)
def _(t: Tables):
    players = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    managers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return unions.union_labelled({"player": players, "manager": managers}, "type")


@REGISTRY.add(
    "union_padded",
    """
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation
    FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier
    """,
)
def _(t: Tables):
    return unions.union_padded(
        [
            t.customer.selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment"),
            t.supplier.selectExpr("s_suppkey AS id", "s_acctbal AS balance", "s_nationkey AS nation"),
        ]
    )


_STATUS_LABELS = {"regular_season": "F", "all_star_game": "O", "division_series": "P"}


@REGISTRY.add(
    "union_game_types",
    " UNION ALL ".join(
        f"SELECT o_orderkey, o_custkey, '{label}' AS game_type FROM orders WHERE o_orderstatus = '{code}'"
        for label, code in _STATUS_LABELS.items()
    ),
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    parts = {
        label: rows.where(F.col("o_orderstatus") == code).drop("o_orderstatus")
        for label, code in _STATUS_LABELS.items()
    }
    return unions.union_labelled(parts, "game_type")


@REGISTRY.add(
    "union_regular_post",
    with_inputs("""
    SELECT playerid, stint, hr, FALSE AS is_postseason FROM raw_batting
    UNION ALL SELECT playerid, round, hr, TRUE FROM raw_batting_post
    """),
)
def _(t: Tables):
    from statlake.plans.lahman import _both_seasons

    return _both_seasons(t.raw_batting, t.raw_batting_post).select("playerid", "stint", "hr", "is_postseason")


@REGISTRY.add("union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(t: Tables):
    return unions.union_all([t.nation.selectExpr("n_name AS name"), t.region.selectExpr("r_name AS name")])


@REGISTRY.add(
    "diagonal_union",
    "SELECT * EXCLUDE (l_shipdate) FROM lineitem UNION ALL BY NAME SELECT * EXCLUDE (o_orderdate) FROM orders",
)
def _(t: Tables):
    return unions.union_padded([t.lineitem.drop("l_shipdate"), t.orders.drop("o_orderdate")])


@REGISTRY.add(
    "set_difference",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey * 2 FROM orders)",
)
def _(t: Tables):
    return unions.names_missing(t.customer, t.orders.selectExpr("o_custkey * 2 AS c_custkey"), "c_custkey")


@REGISTRY.add(
    "long_labels",
    " UNION ALL ".join(
        f"SELECT c_custkey AS entity_id, c_acctbal * {i} AS spin, '2024' AS year, '{label}' AS spin_type FROM customer"
        for i, label in enumerate(SPIN_TYPES, start=1)
    ),
)
def _(t: Tables):
    frames = {
        label: t.customer.selectExpr("c_custkey AS entity_id", f"c_acctbal * {i} AS spin")
        for i, label in enumerate(SPIN_TYPES, start=1)
    }
    return unions.long_labels(frames, "spin_type", {"year": 2024})


# ---- merge and incremental loads -------------------------------------------------------

@REGISTRY.add(
    "merge_upsert",
    """
    WITH fresh AS (
      SELECT l_orderkey * 2 AS o_orderkey, l_returnflag AS o_orderstatus, CAST(l_quantity AS BIGINT) AS quantity
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey, l_quantity) = 1)
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS BIGINT) AS quantity FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)
    UNION ALL SELECT o_orderkey, NULL, o_orderstatus, quantity FROM fresh
    """,
)
def _(t: Tables):
    # Doubled keys: some orders are replaced, some stay, some keys are new.
    batch = t.lineitem.selectExpr(
        "l_orderkey * 2 AS o_orderkey", "l_returnflag AS o_orderstatus", "cast(l_quantity as bigint) AS quantity",
        "l_linenumber", "l_partkey", "l_suppkey",
    )
    newest = [F.col("l_linenumber").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("quantity")]
    stored = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    merged = merge.merge_by_key(stored, batch, ["o_orderkey"], newest)
    return merged.select("o_orderkey", "o_custkey", "o_orderstatus", "quantity")


_LEDGER_SQL = """
    ledger AS (
      SELECT 'load' || g AS load_id, CASE WHEN g % 4 = 0 THEN 1 ELSE 0 END AS status,
        TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(g AS INTEGER)) AS inserted_at FROM generate_series(0, 29) s(g))
"""


def _ledger(t: Tables):
    number = F.col("id")
    return t.spark.range(30).select(
        F.concat(F.lit("load"), number.cast("string")).alias("load_id"),
        F.when(number % 4 == 0, 1).otherwise(0).cast("bigint").alias("status"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=number.cast("int"))).alias("inserted_at"),
    )


def _orders_with_loads(t: Tables):
    load = F.concat(F.lit("load"), (F.col("o_orderkey") % 40).cast("string"))
    return t.orders.withColumn("_load_id", load)


@REGISTRY.add(
    "table_status",
    f"""
    WITH {_LEDGER_SQL}, t AS (SELECT 'load' || (o_orderkey % 40) AS load_id FROM orders)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM t) AS rows, strftime(max(inserted_at), '%Y-%m-%d %H:%M:%S') AS last_load,
      CAST(count(DISTINCT t.load_id) AS BIGINT) AS load_count
    FROM t JOIN ledger l ON l.load_id = t.load_id WHERE status = 0
    """,
)
def _(t: Tables):
    return status.table_status(_orders_with_loads(t), _ledger(t))


@REGISTRY.add(
    "table_status_of_all",
    f"""
    WITH {_LEDGER_SQL},
    t AS (
      SELECT 'orders' AS table_name, 'load' || (o_orderkey % 40) AS load_id, strftime(o_orderdate, '%Y-%m-%d') AS mark FROM orders
      UNION ALL SELECT 'lineitem', 'load' || (l_orderkey % 7), strftime(l_shipdate, '%Y-%m-%d') FROM lineitem)
    SELECT table_name, max(mark) AS watermark, CAST(count(*) AS BIGINT) AS rows,
      strftime(max(inserted_at), '%Y-%m-%d %H:%M:%S') AS last_load, CAST(count(DISTINCT l.load_id) AS BIGINT) AS load_count
    FROM t LEFT JOIN (SELECT * FROM ledger WHERE status = 0) l ON l.load_id = t.load_id GROUP BY table_name
    """,
)
def _(t: Tables):
    lines = t.lineitem.withColumn("_load_id", F.concat(F.lit("load"), (F.col("l_orderkey") % 7).cast("string")))
    tables = {"orders": _orders_with_loads(t), "lineitem": lines}
    return status.tables_status(tables, {name: _WATERMARKS[name] for name in tables}, _ledger(t))


@REGISTRY.add(
    "load_ledger_join",
    f"""
    WITH {_LEDGER_SQL}
    SELECT o_orderkey, strftime(inserted_at, '%Y-%m-%d %H:%M:%S') AS inserted_at
    FROM orders JOIN ledger ON load_id = 'load' || (o_orderkey % 40) WHERE status = 0
    """,
)
def _(t: Tables):
    good = status.successful(_ledger(t))
    found = joins.inner_enrich(_orders_with_loads(t), good, {"_load_id": "load_id"}, ["inserted_at"])
    return found.select("o_orderkey", "inserted_at")


_WATERMARKS = {
    "orders": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "lineitem": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "customer": "substr(c_name, 10)",
}
_WATERMARK_SQL = """
    SELECT 'orders' AS table_name, max(strftime(o_orderdate, '%Y-%m-%d')) AS watermark FROM orders
    UNION ALL SELECT 'lineitem', max(strftime(l_shipdate, '%Y-%m-%d')) FROM lineitem
    UNION ALL SELECT 'customer', max(substr(c_name, 10)) FROM customer
    UNION ALL SELECT 'absent', NULL
"""


def _watermarks(t: Tables):
    tables = {name: getattr(t, name) for name in _WATERMARKS} | {"absent": None}
    return status.table_watermarks(tables, {**_WATERMARKS, "absent": "season"})


REGISTRY.add("watermark_max", _WATERMARK_SQL)(_watermarks)


def _loader_of(column):
    return F.when(column.isin("orders", "lineitem"), "dated").otherwise("undated")


@REGISTRY.add(
    "laggard_watermark",
    f"""
    WITH w AS ({_WATERMARK_SQL})
    SELECT CASE WHEN table_name IN ('orders', 'lineitem') THEN 'dated' ELSE 'undated' END AS loader,
      CASE WHEN count(*) = count(watermark) THEN min(watermark) END AS laggard FROM w GROUP BY ALL
    """,
)
def _(t: Tables):
    return status.laggard_watermark(_watermarks(t).withColumn("loader", _loader_of(F.col("table_name"))))


_STATUS_SQL = f"""
    WITH {_LEDGER_SQL}, w AS ({_WATERMARK_SQL}),
    registry(loader, full_refresh_only, accepts_dates) AS (
      VALUES ('dated', FALSE, TRUE), ('undated', FALSE, FALSE), ('never', FALSE, FALSE)),
    tables_(loader, name) AS (VALUES ('dated', 'orders'), ('dated', 'lineitem'), ('undated', 'customer'), ('dated', '_loads')),
    loads AS (
      SELECT CASE WHEN CAST(substr(load_id, 5) AS INT) % 2 = 0 THEN 'dated' ELSE 'undated' END AS loader, * FROM ledger),
    laggards AS (
      SELECT CASE WHEN table_name IN ('orders', 'lineitem') THEN 'dated' ELSE 'undated' END AS loader,
        CASE WHEN count(*) = count(watermark) THEN min(watermark) END AS laggard FROM w GROUP BY ALL),
    result AS (
      SELECT r.loader,
        (SELECT CAST(count(*) AS BIGINT) FROM tables_ t WHERE t.loader = r.loader AND name[1] <> '_') AS table_count,
        (SELECT strftime(max(inserted_at), '%Y-%m-%d %H:%M:%S') FROM loads l WHERE l.loader = r.loader AND status = 0) AS last_load,
        (SELECT CAST(count(*) AS BIGINT) FROM loads l WHERE l.loader = r.loader AND status = 0) AS load_count,
        (SELECT laggard FROM laggards g WHERE g.loader = r.loader) AS laggard, full_refresh_only, accepts_dates
      FROM registry r)
"""


def _status(t: Tables):
    registry = t.spark.createDataFrame(
        [("dated", False, True), ("undated", False, False), ("never", False, False)],
        "loader string, full_refresh_only boolean, accepts_dates boolean",
    )
    tables = t.spark.createDataFrame(
        [("dated", "orders"), ("dated", "lineitem"), ("undated", "customer"), ("dated", "_loads")],
        "loader string, name string",
    )
    even = F.substring("load_id", 5, 9).cast("int") % 2 == 0
    ledger = _ledger(t).withColumn("loader", F.when(even, "dated").otherwise("undated"))
    marks = _watermarks(t).withColumn("loader", _loader_of(F.col("table_name")))
    found = status.loader_status(registry.drop("accepts_dates"), tables, ledger, marks)
    return found.join(registry.select("loader", "accepts_dates"), "loader")


REGISTRY.add("loader_status", f"{_STATUS_SQL} SELECT * EXCLUDE (accepts_dates) FROM result")(
    lambda t: _status(t).drop("accepts_dates")
)


@REGISTRY.add(
    "load_plan",
    f"""
    {_STATUS_SQL}
    SELECT loader, laggard, CASE WHEN accepts_dates AND laggard SIMILAR TO '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' THEN 'dates'
        ELSE 'full_history' END AS plan,
      CASE WHEN accepts_dates THEN laggard END AS plan_start, CASE WHEN accepts_dates THEN '2002-01-01' END AS plan_end
    FROM result
    """,
)
def _(t: Tables):
    plan = cursors.load_plan(_status(t), "incremental", F.lit(dt.date(2002, 1, 1)))
    return plan.select("loader", "laggard", "plan", "plan_start", "plan_end")


@REGISTRY.add(
    "cursor_resume",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders WHERE year(o_orderdate) BETWEEN 1998 AND 2000
    """,
)
def _(t: Tables):
    source = t.orders.select("o_orderkey", F.year("o_orderdate").alias("season"))
    stored = t.spark.createDataFrame([("orders", "1998"), ("events", "2024")], "resource string, cursor string")
    return cursors.rows_to_load(source, stored, "orders", "season", 1995, 2000)


@REGISTRY.add(
    "month_chunks",
    """
    SELECT o_custkey, strftime(greatest(month, first), '%Y-%m-%d') AS chunk_start,
      strftime(least(CAST(month + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), last), '%Y-%m-%d') AS chunk_end
    FROM (
      SELECT o_custkey, first, last, CAST(unnest(generate_series(date_trunc('month', first), last, INTERVAL 1 MONTH)) AS DATE) AS month
      FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last
            FROM orders GROUP BY o_custkey))
    """,
)
def _(t: Tables):
    spans = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    chunks = scope.month_chunks(F.col("first"), F.col("last"))
    return spans.select("o_custkey", F.inline(chunks))


# ---- functions -------------------------------------------------------------------------

@REGISTRY.add(
    "safe_divide",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_linenumber - 3 = 0 THEN 0.0
        ELSE round(CAST(l_orderkey AS DOUBLE) / (l_linenumber - 3), 3) + 0.0 END AS ratio
    FROM lineitem
    """,
)
def _(t: Tables):
    ratio = S.safe_divide(F.col("l_orderkey"), F.col("l_linenumber") - 3, 3)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio"))


@REGISTRY.add(
    "outs_to_innings",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS INTEGER) // 3 AS VARCHAR) || '.' ||
      CAST(CAST(l_quantity AS INTEGER) % 3 AS VARCHAR) AS innings FROM lineitem
    """,
)
def _(t: Tables):
    innings = S.outs_to_innings(F.col("l_quantity").cast("int")).alias("innings")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", innings)


@REGISTRY.add(
    "flag_yn",
    with_inputs("""
    SELECT franchid, CASE active WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_active,
      COALESCE(active = 'Y', FALSE) AS is_active_or_false FROM raw_franchises
    """),
)
def _(t: Tables):
    active = F.col("active")
    return t.raw_franchises.select(
        "franchid", S.yes_no(active).alias("is_active"), S.flag_or_false(active, "Y").alias("is_active_or_false")
    )


@REGISTRY.add(
    "code_map",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 3 END AS code FROM events
    """,
)
def _(t: Tables):
    codes = {"click": 1, "view": 2, "error": 3}
    return t.events.select("event_id", S.code_map(F.col("event_type"), codes).alias("code"))


@REGISTRY.add(
    "nullif_coalesce",
    """
    SELECT o_orderkey, NULLIF(o_orderstatus, 'F') AS status, COALESCE(NULLIF(o_orderstatus, 'F'), 'none') AS shown
    FROM orders
    """,
)
def _(t: Tables):
    kept = S.null_texts(F.col("o_orderstatus"), "F")
    return t.orders.select("o_orderkey", kept.alias("status"), F.coalesce(kept, F.lit("none")).alias("shown"))


@REGISTRY.add(
    "int_round_cast",
    """
    SELECT o_orderkey, TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(12,1)) AS VARCHAR) AS INTEGER) AS price,
      TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number FROM orders
    """,
)
def _(t: Tables):
    text = F.col("o_totalprice").cast("decimal(12,1)").cast("string")
    return t.orders.select(
        "o_orderkey", S.parse_int(text).alias("price"), S.parse_int(F.col("o_orderpriority")).alias("not_a_number")
    )


@REGISTRY.add(
    "decimal_casts",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(7,1)) AS DOUBLE) AS tenths,
      CAST(TRY_CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(5,3)) AS DOUBLE) AS thousandths,
      CAST(TRY_CAST(l_returnflag AS DECIMAL(5,3)) AS DOUBLE) AS not_a_number FROM lineitem
    """,
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.parse_decimal(F.col("l_extendedprice").cast("string"), 7, 1).alias("tenths"),
        S.parse_decimal(F.col("l_discount").cast("string"), 5, 3).alias("thousandths"),
        S.parse_decimal(F.col("l_returnflag"), 5, 3).alias("not_a_number"),
    )


@REGISTRY.add(
    "money_parse",
    with_inputs("""
    SELECT ovpck, bonus, TRY_CAST(replace(replace(bonus, '$', ''), ',', '') AS INTEGER) AS amount FROM raw_draft
    """),
)
def _(t: Tables):
    return t.raw_draft.select("ovpck", "bonus", S.parse_money(F.col("bonus")).alias("amount"))


@REGISTRY.add(
    "surrogate_key",
    f"""
    SELECT l_orderkey, l_linenumber, {key_sql('l_orderkey', 'l_linenumber', "NULLIF(l_returnflag, 'N')", 'FALSE')} AS line_id
    FROM lineitem
    """,
)
def _(t: Tables):
    flag = S.null_texts(F.col("l_returnflag"), "N")
    key = S.surrogate_key("l_orderkey", "l_linenumber", flag, F.lit(False))
    return t.lineitem.select("l_orderkey", "l_linenumber", key.alias("line_id"))


@REGISTRY.add(
    "md5_id",
    """
    SELECT o_orderkey, md5(concat(strftime(o_orderdate, '%Y%m%d'), NULLIF(o_orderstatus, 'P'), o_custkey)) AS game_id
    FROM orders
    """,
)
def _(t: Tables):
    parts = (F.date_format("o_orderdate", "yyyyMMdd"), S.null_texts(F.col("o_orderstatus"), "P"), F.col("o_custkey"))
    return t.orders.select("o_orderkey", S.joined_md5(*parts).alias("game_id"))


@REGISTRY.add("strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", S.strip_accents(F.col("text")).alias("plain"))


@REGISTRY.add(
    "safe_date",
    with_inputs("""
    SELECT key_uuid, CASE WHEN CAST(birth_year AS INT) BETWEEN 1800 AND 2026
      THEN CAST(TRY_CAST(birth_year || '-' || birth_month || '-' || birth_day AS DATE) AS VARCHAR) END AS birth_date
    FROM register_raw
    """),
)
def _(t: Tables):
    parts = (F.col(f"birth_{part}") for part in ("year", "month", "day"))
    born = S.guarded_date(*parts, F.lit(dt.date(2026, 1, 1)))
    return t.register_raw.select("key_uuid", born.alias("birth_date"))


@REGISTRY.add(
    "date_cast",
    with_inputs("SELECT parkkey, CAST(TRY_CAST(spanlast AS DATE) AS VARCHAR) AS last_date FROM raw_home_games"),
)
def _(t: Tables):
    return t.raw_home_games.select("parkkey", S.parse_date(F.col("spanlast")).alias("last_date"))


@REGISTRY.add(
    "json_path",
    "SELECT event_id, TRY_CAST(props::JSON ->> 'k' AS INTEGER) AS k, TRY_CAST(props::JSON ->> 'z' AS INTEGER) AS z FROM events",
)
def _(t: Tables):
    props = F.col("props")
    return t.events.select(
        "event_id", json_value(props, "$.k", "int").alias("k"), json_value(props, "$.z", "int").alias("z")
    )


@REGISTRY.add(
    "json_struct",
    "SELECT event_id, TRY_CAST(props::JSON ->> 'k' AS INTEGER) AS k, props::JSON ->> 'name' AS name FROM events",
)
def _(t: Tables):
    record = json_record(F.col("props"), {"k": "int", "name": "string"})
    return t.events.select("event_id", record.alias("r")).select("event_id", "r.k", "r.name")


_NAMES = ["1B", "-RBI", "K/9", "wRC+", "IFFB-", "pfxFA-X"]


@REGISTRY.add(
    "normalise_names",
    """
    SELECT p_partkey AS _1b, p_name AS neg_rbi, p_brand AS k_per_9, p_type AS w_rc_plus, p_size AS iffb_minus,
      p_retailprice AS pfx_fa_x FROM part
    """,
)
def _(t: Tables):
    return rename_by(t.part.toDF(*_NAMES), leaderboard_name)


@REGISTRY.add(
    "short_names",
    """
    SELECT p_partkey AS _1b, p_name AS neg_rbi, p_brand AS k_per_9, p_type AS wrc_plus, p_size AS iffb_minus,
      p_retailprice AS pfxfa_x FROM part
    """,
)
def _(t: Tables):
    return rename_by(t.part.toDF(*_NAMES), short_name)


@REGISTRY.add(
    "rename_dictionary",
    """
    SELECT p_partkey AS _1b, p_partkey AS singles, p_name AS neg_rbi, p_brand AS k_per_9,
      p_type AS wrc_plus, p_type AS weighted_runs_created_plus, p_size AS iffb_minus,
      p_retailprice AS pfxfa_x, p_retailprice AS four_seam_fastball_average_horizontal_movement_inches_sc FROM part
    """,
)
def _(t: Tables):
    dictionary = leaderboards.Dictionary.from_rows(
        [
            {"group": "standard_and_advanced", "raw_name": "1B", "column_name": "singles", "type": "int64"},
            {"group": "value", "raw_name": "wRC+", "column_name": "weighted_runs_created_plus", "type": "int64"},
        ]
    )
    return leaderboards.select_dictionary(t.part.toDF(*_NAMES), _NAMES, dictionary)


@REGISTRY.add(
    "batting_metrics",
    with_inputs("""
    WITH c AS (
      SELECT playerid, yearid, stint, teamid, COALESCE(CAST(ab AS INT), 0) AS ab, COALESCE(CAST(h AS INT), 0) AS h,
        COALESCE(CAST(_2b AS INT), 0) AS d, COALESCE(CAST(_3b AS INT), 0) AS t, COALESCE(CAST(hr AS INT), 0) AS hr
      FROM raw_batting)
    SELECT playerid, yearid, stint, teamid, d + t + hr AS extra_base_hits, h + d + 2 * t + 3 * hr AS total_bases FROM c
    """),
)
def _(t: Tables):
    counts = t.raw_batting.select(
        "playerid", "yearid", "stint", "teamid",
        *[
            S.parse_count(F.col(raw)).alias(name)
            for raw, name in (("h", "hits"), ("_2b", "doubles"), ("_3b", "triples"), ("hr", "home_runs"))
        ],
    )
    return counts.select(
        "playerid", "yearid", "stint", "teamid",
        S.extra_base_hits().alias("extra_base_hits"), S.total_bases().alias("total_bases"),
    )


@REGISTRY.add(
    "mean_and_gap",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity + l_linenumber) / 2 AS average,
      abs(l_quantity - l_linenumber) AS difference FROM lineitem
    """,
)
def _(t: Tables):
    left, right = F.col("l_quantity"), F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.half_sum(left, right).alias("average"), S.absolute_gap(left, right).alias("difference"),
    )


@REGISTRY.add(
    "display_values",
    """
    SELECT o_orderkey, COALESCE(format('{:,}', o_custkey), '-') AS customer,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered, COALESCE(NULLIF(o_orderstatus, 'F'), '-') AS status FROM orders
    """,
)
def _(t: Tables):
    return t.orders.select(
        "o_orderkey",
        S.display_value(F.col("o_custkey"), "count").alias("customer"),
        S.display_value(F.col("o_orderdate"), "timestamp").alias("ordered"),
        S.display_value(S.null_texts(F.col("o_orderstatus"), "F"), "text").alias("status"),
    )


@REGISTRY.add(
    "watermark_parse",
    """
    WITH m AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'Date' END AS mark FROM orders)
    SELECT o_orderkey, mark, CASE WHEN mark <> 'Date' THEN CAST(substr(mark, 1, 4) AS INTEGER) END AS year,
      CASE WHEN length(mark) = 10 THEN mark
        WHEN length(mark) = 8 THEN substr(mark, 1, 4) || '-' || substr(mark, 5, 2) || '-' || substr(mark, 7, 2) END AS day
    FROM m
    """,
)
def _(t: Tables):
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 4
    mark = (
        F.when(form == 0, F.date_format(day, "yyyy"))
        .when(form == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 2, F.date_format(day, "yyyyMMdd"))
        .otherwise("Date")
    )
    marked = t.orders.select("o_orderkey", mark.alias("mark"))
    return marked.withColumns(
        {"year": cursors.watermark_year(F.col("mark")), "day": cursors.watermark_date(F.col("mark"))}
    )
