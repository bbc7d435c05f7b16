import random

from docsim.llm import jaccard_join as J


def test_members_that_share_many_segments_meet_once(spark):
    rows = [(key, node, node) for key in range(100) for node in (1, 2)]
    rows += [(200, 1, 1), (200, 2, 2), (200, 3, 3)] + [(300 + k, node, 7) for k in range(5) for node in (7, 8)]
    parts = spark.createDataFrame(rows, "key bigint, node bigint, part bigint")
    kept = sorted((r["key"], r["node"]) for r in J._groups_once(parts).collect())
    assert kept == [(0, 1), (0, 2), (200, 1), (200, 2), (200, 3)]


def _parts(spark, rows):
    alike = ", ".join(["'n', 100L", *[f"'p{k}', 0L" for k in range(J.PARITY // 64)]])
    return spark.createDataFrame(rows, "key bigint, node bigint, part bigint").selectExpr("*", f"named_struct({alike}) AS m")


def test_a_pair_that_shares_many_segments_is_opened_once(spark):
    # no two segments have the same members: each has one of its own
    rows = [(key, node, node) for key in range(10) for node in [1, 2, 3, 4, 5, 6, 100 + key]]
    opened = [tuple(r) for r in J._opened(J._groups_once(_parts(spark, rows)), J.SIMILARITY).select("high", "low").collect()]
    assert len(opened) == len(set(opened)) == 15 + 6 * 10


def test_every_pair_of_different_components_under_a_segment_is_opened(spark):
    chance = random.Random(5)
    rows = [(key, node, node // 2) for key in range(60) for node in chance.sample(range(30), 12)]
    opened = [(r["high"], r["low"]) for r in J._opened(_parts(spark, rows), J.SIMILARITY).collect()]
    members = [{node for k, node, _ in rows if k == key} for key in range(60)]
    wanted = {(a, b) for group in members for a in group for b in group if a > b and a // 2 != b // 2}
    assert set(opened) == wanted
    assert len(opened) < 1.1 * len(wanted) < sum(a > b and a // 2 != b // 2 for g in members for a in g for b in g)
