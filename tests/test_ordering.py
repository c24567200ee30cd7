import random
import re

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from offerwise.operators import ordering

OFFSETS = (1, 2, 3, -1, -2, -3)


def specs():
    def cols(prefix, col):
        return {f"{prefix}{k}": (col, k) for k in OFFSETS}

    return [([F.asc("start"), F.asc("id")], cols("s", "start")), ([F.asc("coupon"), F.desc("start"), F.asc("id")], cols("c", "coupon"))]


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer holds a third of all rows, the others a few each."""
    rng = random.Random(5)
    data = [(i, 1 if i % 3 == 0 else rng.randint(2, 60), rng.randint(1, 6), rng.randint(1, 9)) for i in range(900)]
    return spark.createDataFrame(data, "id bigint, customer bigint, start int, coupon int").repartition(5, "id")


def brute(data):
    out = {}
    for prefix, col, key in (("s", "start", lambda r: (r.start, r.id)), ("c", "coupon", lambda r: (r.coupon, -r.start, r.id))):
        groups = {}
        for r in sorted(data, key=key):
            groups.setdefault(r.customer, []).append(r)
        for g in groups.values():
            for i, r in enumerate(g):
                for k in OFFSETS:
                    j = i - k
                    out.setdefault(r.id, {})[f"{prefix}{k}"] = g[j][col] if 0 <= j < len(g) else None
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 40, 5, 1])
def test_shifts_with_and_without_hot_groups(spark, skewed, hot_rows):
    want = brute(skewed.collect())
    got = ordering.shifts(skewed, "customer", specs(), hot_rows)
    have = {r.id: {k: v for k, v in r.asDict().items() if k[0] in "sc" and k[1:].lstrip("-").isdigit()} for r in got.collect()}
    assert have == want


def test_all_orders_share_one_shuffle(spark, skewed):
    assert plan(ordering.shifts(skewed, "customer", specs())).count("Exchange hashpartitioning(customer") == 1


def test_the_hot_path_never_clusters_a_whole_group(spark, skewed):
    text = plan(ordering._shifts_across_tasks(skewed, "customer", [F.asc("start"), F.asc("id")], {"s1": ("start", 1)}))
    assert "rangepartitioning(customer" in text
    shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert shuffles and all("_piece" in x or "_seam" in x for x in shuffles)


def test_fold_sizes(spark):
    df = spark.range(10).repartition(3, "id")
    out = ordering.contiguous_folds(df, 3, [F.asc("id")])
    assert rows(out) == [(i, 0 if i < 4 else 1 if i < 7 else 2) for i in range(10)]
    few = ordering.contiguous_folds(spark.range(2), 3, [F.asc("id")])
    assert rows(few) == [(0, 0), (1, 1)]


def test_positions_do_not_depend_on_the_partitioning(spark, skewed):
    order = [F.asc("customer"), F.desc("start"), F.asc("id")]
    want = sorted(skewed.collect(), key=lambda r: (r.customer, -r.start, r.id))
    for df in (skewed, skewed.repartition(2, "start"), skewed.coalesce(1)):
        got = ordering.global_position(df, order).orderBy("position").collect()
        assert [r.id for r in got] == [r.id for r in want]
        assert [r.position for r in got] == list(range(900))
        assert {r.position_total for r in got} == {900}


def test_top_n_limits_before_the_shuffle(spark, skewed):
    top = ordering.top_n_per_group(skewed, ["customer"], [F.asc("id")], 2, label="T_")
    assert {(r.rn, r.rn_label) for r in top.collect()} == {(1, "T_1"), (2, "T_2")}
    text = plan(top)
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")  # printed top-down: the last one is below the shuffle


def test_group_folds_keep_groups_together(spark, skewed):
    folded = ordering.group_folds(skewed, "customer", 4)
    assert folded.groupBy("customer").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
    assert {r.fold for r in folded.select("fold").distinct().collect()} <= set(range(4))


def test_group_positions_split_and_whole(spark):
    rng = random.Random(4)
    data = [(min(i % 9, 3), rng.randint(0, 50), i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, v int, id int").repartition(5, "id")
    order = [F.desc("v"), F.asc("id")]
    want = {}
    for k in range(4):
        members = sorted((r for r in data if r[0] == k), key=lambda r: (-r[1], r[2]))
        want.update({r[2]: n + 1 for n, r in enumerate(members)})
    for hot_rows in (10**6, 60):
        got = ordering.group_positions(df, "k", order, "n", hot_rows)
        assert {r.id: r.n for r in got.collect()} == want


@pytest.mark.parametrize("rows, k", [
    ([i % 700 for i in range(4000)], 4),
    ([0] * 900 + [1] * 500 + [2] * 300 + [i % 300 + 3 for i in range(2300)], 4),
    ([0] * 3000 + list(range(1, 400)), 5),
    ([None] * 40 + [i % 17 for i in range(300)], 3),
    ([], 3), ([5], 3),
])
def test_group_folds_are_of_one_size(spark, rows, k):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(rows)], "key bigint, i bigint")
    got = [(r.key, r.fold) for r in ordering.group_folds(df, "key", k).collect()]
    assert len(got) == len(rows) and len(set(got)) == len(set(rows))
    assert all(0 <= f < k for _, f in got)
    sizes = [sum(f == n for _, f in got) for n in range(k)]
    each = [rows.count(x) for x in set(rows)]
    limit = ordering.heavy_limit(len(rows), k)
    light = [n for n in each if n <= limit or not limit]
    greedy = [0] * k
    for n in sorted((n for n in each if limit and n > limit), reverse=True):
        greedy[greedy.index(min(greedy))] += n
    want, rest = sorted(greedy), sum(light)
    level = next(x for i in range(1, k + 1) if (x := (sum(want[:i]) + rest) / i) is not None and (i == k or x <= want[i]))
    for have, before in zip(sizes, greedy):
        assert abs(have - max(before, level if light else before)) < max(light, default=1)
