import datetime as dt
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from statlake.operators import joins, match, merge, ranking, scope, unions

TODAY = dt.date(2024, 6, 1)


# ---- joins -----------------------------------------------------------------------------

@pytest.mark.parametrize("strategy, spread", [(None, ()), ("merge", ()), ("merge", ("n",))])
def test_left_enrich_keeps_null_keys_and_repeats(spark, rows, strategy, spread):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("z", 3), (None, 4)], "k string, n int")
    side = spark.createDataFrame([("a", "p1"), ("a", "p2"), (None, "p3")], "id string, person string")
    found = joins.left_enrich(fact, side, {"k": "id"}, ["person"], spread, strategy)
    assert rows(found) == sorted([("a", 1, "p1"), ("a", 1, "p2"), (None, 2, None), ("z", 3, None), (None, 4, None)], key=str)
    if strategy:
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_conditional_key_has_no_nested_loop(spark, rows):
    fact = spark.createDataFrame(
        [("maj", "x1"), ("min", "x1"), ("NA", "x1"), (None, "x1")], "kind string, id string")
    people = spark.createDataFrame([("x1", "m1", "p1"), ("x9", "x1", "p2")], "major string, minor string, person string")
    df = joins.conditional_key_enrich(fact, people, "kind", "id", {"maj": "major", "min": "minor"}, ["person"])
    assert rows(df) == sorted([("maj", "x1", "p1"), ("min", "x1", "p2"), ("NA", "x1", None), (None, "x1", None)], key=str)
    assert "NestedLoop" not in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("strategy", [None, "merge"])
def test_roles_equal_one_left_join_each(spark, rows, tmp_path, strategy):
    """A dimension with repeated ids, null ids and null values, read from files so that its size is known."""
    fact = spark.createDataFrame([(1, 10, 20), (2, 10, 10), (3, None, 30), (4, None, None), (5, 40, 20)], "n int, a int, b int")
    people = [(10, "ten"), (20, "twenty"), (20, "score"), (None, "none"), (40, None), (40, "forty")]
    spark.createDataFrame(people, "id int, name string").write.parquet(str(tmp_path / "people"))
    side = spark.read.parquet(str(tmp_path / "people"))
    got = joins.resolve_roles(fact, side, {"a": "a_name", "b": "b_name"}, "id", "name", strategy)
    expected = []
    for n, a, b in [(1, 10, 20), (2, 10, 10), (3, None, 30), (4, None, None), (5, 40, 20)]:
        for x in [v for i, v in people if i == a and a is not None] or [None]:
            for y in [v for i, v in people if i == b and b is not None] or [None]:
                expected.append((n, x, y))
    assert rows(got.select("n", "a_name", "b_name")) == sorted(expected, key=str)
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (strategy is None)


@pytest.mark.parametrize("strategy, roles, repeated", [("merge", 2, True), ("merge", 2, False), (None, 6, True), (None, 6, False), (None, 2, True)])
def test_roles_do_not_move_the_fact(spark, rows, monkeypatch, strategy, roles, repeated):
    """Whatever the combinations, only ids are shuffled; with more ids than a task may hold the result is the same."""
    names = [f"r{i}" for i in range(roles)]
    ids = [*range(40), None, 2**40]
    values = [(n, *[ids[(n * (i + 3)) % len(ids)] for i in range(roles)]) for n in range(200)]
    fact = spark.createDataFrame(values, "n int, " + ", ".join(f"{r} long" for r in names)).coalesce(1)
    people = [(i, f"p{i}" if i % 7 else None) for i in range(0, 60, 2)] + [(None, "none")] + [(4, "again")] * repeated
    side = spark.createDataFrame(people, "id long, name string")
    outputs = {r: f"{r}_name" for r in names}
    got = joins.resolve_roles(fact, side, outputs, "id", "name", strategy)
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == [*fact.columns, *outputs.values()]
    if roles == 2:
        found = {i: [v for j, v in people if j == i] or [None] for i in ids}
        found[None] = [None]
        assert rows(got) == sorted([(n, a, b, x, y) for n, a, b in values for x in found[a] for y in found[b]], key=str)
    monkeypatch.setattr(joins, "ROLE_IDS", 3)
    assert rows(joins.resolve_roles(fact, side, outputs, "id", "name", strategy)) == rows(got)


def test_a_wide_fact_is_not_sorted_for_its_join(spark, rows, tmp_path):
    """Where nothing may be broadcast, adaptive execution hashes the dimension instead of sorting the fact."""
    fact = spark.range(2000).selectExpr("id % 90 AS k", "id AS n")
    spark.range(60).selectExpr("id AS k", "concat('p', id) AS person").write.parquet(str(tmp_path / "people"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.left_enrich(fact, spark.read.parquet(str(tmp_path / "people")), {"k": "k"}, ["person"])
        assert rows(found) == sorted([(n % 90, n, f"p{n % 90}" if n % 90 < 60 else None) for n in range(2000)], key=str)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    final = plan.split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


@pytest.mark.parametrize("bucket", [1, 7, 1024])
def test_first_covering_range(spark, bucket):
    ranges = [("u", 2, 5, 40, 7), ("u", 1, 20, 25, 8), ("u", 3, 30, 60, 9), ("v", 1, -12, -3, 4)]
    table = spark.createDataFrame(ranges, "type string, position int, start int, end int, rounds int")
    points = [(k, p) for k in "uvw" for p in range(-15, 65)]
    fact = spark.createDataFrame(points, "type string, year int")
    got = {(r.type, r.year): r.rounds for r in joins.range_value(fact, table, ["type"], "year", "rounds", "rounds", bucket=bucket).collect()}
    for k, p in points:
        held = min(((position, v) for t, position, a, b, v in ranges if t == k and a <= p <= b), default=(0, 0))
        assert got[k, p] == held[1]


def test_long_range_is_not_broadcast(spark):
    ranges = spark.createDataFrame([("u", 1, 1, 5_000_000, 3)], "type string, position int, start int, end int, rounds int")
    fact = spark.range(10).selectExpr("'u' AS type", "cast(id * 1000000 AS int) AS year")
    found = joins.range_value(fact, ranges, ["type"], "year", "rounds", "rounds")
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.rounds for r in found.collect()) == [0] * 5 + [3] * 5


# ---- best match ------------------------------------------------------------------------

def brute_force(wanted, candidates, threshold=0.6):
    """The candidate of highest (score, earlier place); an exact name wins with its last values."""
    found = {}
    for block, name in wanted:
        scored = [(SequenceMatcher(None, name.upper(), n.upper()).ratio(), -i, v) for i, (b, n, v) in enumerate(candidates) if b == block]
        exact = [v for b, n, v in candidates if (b, n) == (block, name)]
        close = [s for s in scored if s[0] >= threshold]
        found[block, name] = exact[-1] if exact else max(close)[2] if close else None
    return found


def test_best_match_equals_brute_force(spark):
    rng = random.Random(7)
    names = ["".join(rng.choice("ABab1 ") for _ in range(rng.randint(1, 9))) for _ in range(160)]
    wanted = sorted({(rng.choice("xy"), rng.choice(names)) for _ in range(120)})
    listed = sorted({(rng.choice("xyz"), rng.choice(names)) for _ in range(120)})
    rng.shuffle(listed)
    candidates = [(b, n, f"v{i}") for i, (b, n) in enumerate(listed)]
    w = spark.createDataFrame(wanted, "block string, name string")
    c = spark.createDataFrame([(b, n, i, v) for i, (b, n, v) in enumerate(candidates)],
                              "block string, name string, place int, found string")
    got = match.best_matches(w, c, "block", "name", "place", ["found"]).collect()
    expected = brute_force(wanted, candidates)
    assert {(r.block, r.name): r.found for r in got} == expected
    assert all(r.is_matched == (expected[r.block, r.name] is not None) for r in got)
    assert len(got) == len(wanted)


def test_similar_pairs_are_complete(spark):
    rng = random.Random(3)
    left = [("b", "".join(rng.choice("ABCDE") for _ in range(rng.randint(2, 12)))) for _ in range(60)]
    right = [("b", "".join(rng.choice("ABCDE") for _ in range(rng.randint(2, 12)))) for _ in range(60)]
    a = spark.createDataFrame(sorted(set(left)), "block string, name string")
    b = spark.createDataFrame(sorted(set(right)), "block string, name string")
    got = {(r.name, r.other) for r in match.similar_pairs(a, b).collect()}
    assert got == {(x, y) for _, x in left for _, y in right if match.similarity(x, y) >= 0.6}


# ---- ranking ---------------------------------------------------------------------------

def test_number_rows_equals_row_number(spark):
    df = spark.range(500).selectExpr("if(id % 3 > 0, 'hot', cast(id % 7 AS string)) AS g", "id * 37 % 501 AS v")
    df = df.withColumn("g", F.when(F.col("v") % 11 != 0, F.col("g")))
    got = ranking.number_rows(df, ["g"], [F.col("v")], [F.floor(F.col("v") / 50)], "n").collect()
    groups = {}
    for row in got:
        groups.setdefault(row.g, []).append((row.v, row.n))
    assert sum(map(len, groups.values())) == 500
    for members in groups.values():
        assert [n for _, n in sorted(members)] == list(range(1, len(members) + 1))


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 AS k", "id AS v")
    best = ranking.first_per_key(df, ["k"], [F.col("v").desc()])
    assert sorted(r.v for r in best.collect()) == [95, 96, 97, 98, 99]
    assert "WindowGroupLimit" in best._jdf.queryExecution().toString()


# ---- unions ----------------------------------------------------------------------------

def test_labels_keep_existing_columns(spark):
    df = spark.createDataFrame([("NYY",)], "team string")
    assert [tuple(r) for r in unions.label_if_absent(df, {"year": 2024, "team": "LAD"}).collect()] == [("NYY", "2024")]


def test_padded_union(spark, rows):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert rows(unions.union_padded([a, b])) == sorted([(1, 2, None), (4, None, 3)], key=str)


# ---- merge -----------------------------------------------------------------------------

def test_merge_newest_wins_and_columns_may_be_added(spark, rows):
    old = spark.createDataFrame([(1, 3, 2), (2, 1, 1)], "pk int, home int, away int")
    new = spark.createDataFrame([(1, 10, 0, "x")], "pk int, home int, away int, note string")
    assert rows(merge.merge_by_key(old, new, ["pk"])) == sorted([(1, 10, 0, "x"), (2, 1, 1, None)], key=str)


def test_merge_replay_and_order(spark, rows):
    rng = random.Random(5)
    data = [(rng.randint(0, 20), i) for i in range(60)]
    order = [F.col("v").desc()]
    batch = spark.createDataFrame(data, "k int, v int")
    once = merge.merge_by_key(None, batch, ["k"], order)
    assert rows(merge.merge_by_key(once, batch, ["k"], order)) == rows(once)
    low, high = batch.where("k < 10"), batch.where("k >= 10")
    one = merge.merge_by_key(merge.merge_by_key(None, low, ["k"], order), high, ["k"], order)
    two = merge.merge_by_key(merge.merge_by_key(None, high, ["k"], order), low, ["k"], order)
    assert rows(one) == rows(two) == rows(once)


def test_null_key_fails(spark):
    batch = spark.createDataFrame([(None, 1)], "k int, v int")
    with pytest.raises(Exception, match="null in key"):
        merge.merge_by_key(None, batch, ["k"]).collect()


# ---- scope -----------------------------------------------------------------------------

@pytest.mark.parametrize(
    "given, seasons",
    [({}, (2024, 2024)), ({"season": 2020}, (2020, 2020)), ({"start_season": 2019, "end_season": 2021}, (2019, 2021)),
     ({"full_history": True}, (1871, 2024))])
def test_season_scopes(given, seasons):
    assert scope.make_scope(earliest=1871, today=TODAY, **given).seasons == seasons


_CHOICES = {
    "history": {"full_history": True}, "season": {"season": 1987}, "seasons": {"start_season": 1987, "end_season": 1990},
    "day": {"date": TODAY}, "days": {"start_date": TODAY - dt.timedelta(9), "end_date": TODAY},
}
_CONFLICTS = [{**a, **b} for i, a in enumerate(_CHOICES.values()) for b in list(_CHOICES.values())[i + 1 :]]
_HALVES = [{k: v} for choice in (_CHOICES["seasons"], _CHOICES["days"]) for k, v in choice.items()]


@pytest.mark.parametrize("given", _CONFLICTS + _HALVES)
def test_conflicting_scopes(given):
    with pytest.raises(ValueError):
        scope.make_scope(earliest=1871, today=TODAY, **given)


def test_scope_dates():
    day = scope.make_scope(earliest=2008, today=TODAY, date=TODAY)
    assert scope.scope_dates(day) == (TODAY, TODAY)
    seasons = scope.make_scope(earliest=2008, today=TODAY, start_season=2020, end_season=2021)
    assert scope.scope_dates(seasons) == (dt.date(2020, 3, 1), dt.date(2021, 12, 31))


def test_unknown_resource():
    with pytest.raises(ValueError, match="unknown"):
        scope.choose_resources({"a": 1}, ["a", "b"])
    assert scope.choose_resources({"a": 1, "b": 2}, None) == {"a": 1, "b": 2}


def test_month_chunks(spark):
    first, last = dt.date(2019, 12, 30), dt.date(2020, 3, 2)
    df = spark.createDataFrame([(first, last)], "a date, b date")
    got = [tuple(r) for r in df.select(F.inline(scope.month_chunks(F.col("a"), F.col("b")))).collect()]
    days = [d for a, b in got for d in (a + dt.timedelta(i) for i in range((b - a).days + 1))]
    assert days == [first + dt.timedelta(i) for i in range((last - first).days + 1)]
    assert all((a.year, a.month) == (b.year, b.month) for a, b in got) and len(got) == 4
    empty = spark.createDataFrame([(dt.date(2024, 5, 2), dt.date(2024, 5, 1))], "a date, b date")
    assert empty.select(F.inline(scope.month_chunks(F.col("a"), F.col("b")))).count() == 0


def test_ties_are_settled_after_the_shuffle(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, None, "d"), (None, 1, "e")], "k int, n int, v string")
    found = merge.newest_per_key(df, ["k"], [F.col("n").desc()])
    plan = found._jdf.queryExecution().executedPlan().toString()
    plain = ranking.first_per_key(df, ["k"], [F.col("n").desc(), F.xxhash64("n", "v")])
    assert rows(found) == rows(plain)
    assert "xxhash64" in plan and "xxhash64" not in plan[plan.index("Exchange") :]
