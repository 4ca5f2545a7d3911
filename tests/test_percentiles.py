from __future__ import annotations

import math
import random
from collections import defaultdict
from statistics import pstdev

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from orderlens.operators import comparison as cmp
from orderlens.operators import percentiles as pct
from orderlens.operators.lookup import Workspace
from orderlens.plans import percentile_records, percentile_statistics

KEYS = ("SKU", "year_month")
SCHEMA = "SKU string, year_month string, promotion_count int, amount double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def interpolated(values, p):
    ordered = sorted(values)
    position = (len(ordered) - 1) * p
    low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
    return low + (position - math.floor(position)) * (high - low)


def nearest(values, p):
    return sorted(values)[max(math.ceil(p * len(values)) - 1, 0)]


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    made = {f"n{n}": [rng.randrange(6) for _ in range(n)] for n in (1, 2, 5, 10, 11, 64)}
    made["equal"] = [3] * 9
    return made


@pytest.fixture(scope="module")
def rows(groups):
    rng = random.Random(6)
    return [
        (name, "2022-04", v, None if rng.random() < 0.3 else rng.randrange(100, 999) / 4)
        for name, values in groups.items()
        for v in values
    ]


def test_exact_thresholds(spark, groups, rows):
    found = {r[0]: tuple(r)[2:] for r in pct.exact_thresholds(frame(spark, rows), KEYS).collect()}
    assert found == {
        name: (len(v), pytest.approx(interpolated(v, 0.8)), pytest.approx(interpolated(v, 0.9)))
        for name, v in groups.items()
    }


def test_exact_thresholds_match_the_built_in_percentile(spark, rows):
    df = frame(spark, rows)
    ours = pct.exact_thresholds(df, KEYS, probs=(0.0, 0.25, 0.333, 1.0))
    built_in = df.groupBy(*KEYS).agg(F.percentile("promotion_count", [0.0, 0.25, 0.333, 1.0]).alias("x"))
    joined = ours.join(built_in, list(KEYS)).collect()
    for row in joined:
        assert [row["p0"], row["p25"], row["p33_3"], row["p100"]] == pytest.approx(row["x"])


def test_approx_thresholds_are_nearest_rank_on_small_groups(spark, groups, rows):
    found = {r[0]: tuple(r)[2:] for r in pct.approx_thresholds(frame(spark, rows), KEYS).collect()}
    assert found == {name: (len(v), nearest(v, 0.8), nearest(v, 0.9)) for name, v in groups.items()}


def test_guards(spark, rows):
    with pytest.raises(ValueError):
        pct.approx_thresholds(frame(spark, rows), KEYS, accuracy=0)
    with pytest.raises(ValueError):
        pct.exact_thresholds(frame(spark, rows), KEYS, probs=(1.5,))
    assert pct.level_name(0.999) == "p99_9"


def brute_statistics(rows, threshold):
    grouped = defaultdict(list)
    for sku, _, count, amount in rows:
        grouped[sku].append((count, amount))
    out = {}
    for sku, pairs in grouped.items():
        values = [c for c, _ in pairs]
        row = [len(pairs), threshold(values, 0.8), threshold(values, 0.9)]
        for level in row[1:3]:
            picked = [a for c, a in pairs if c >= level]
            amounts = [a for a in picked if a is not None]
            row += [len(picked), len(amounts), pytest.approx(pstdev(amounts) if amounts else 0.0, abs=1e-9)]
        out[sku] = row
    return out


@pytest.mark.parametrize(("method", "threshold"), [("exact", interpolated), ("approx", nearest)])
def test_statistics(spark, rows, method, threshold):
    df = frame(spark, rows)
    levels = getattr(pct, f"{method}_thresholds")(df, KEYS)
    stats = pct.threshold_statistics(df, levels, KEYS)
    assert stats.columns == [
        "SKU", "year_month", "order_count", "p80", "p90", "p80_order_count", "p80_amount_count", "p80_stddev",
        "p90_order_count", "p90_amount_count", "p90_stddev",
    ]
    expected = {k: [*v[:1], *map(pytest.approx, v[1:3]), *v[3:]] for k, v in brute_statistics(rows, threshold).items()}
    assert {r[0]: list(r)[2:] for r in stats.collect()} == expected


def test_groups_without_amounts_or_keys(spark):
    df = frame(spark, [("a", "2022-04", 2, None), ("a", "2022-04", 2, None), ("b", "2022-04", 1, 5.0),
                       (None, "2022-04", 1, 1.0), ("c", None, 1, 1.0)])
    stats = pct.threshold_statistics(df, pct.exact_thresholds(df, KEYS), KEYS)
    assert {r[0]: (r["p80_order_count"], r["p80_amount_count"], r["p80_stddev"]) for r in stats.collect()} == {
        "a": (2, 0, 0.0), "b": (1, 1, 0.0),
    }
    assert pct.exact_thresholds(df, KEYS).count() == 4
    assert rows_of(pct.group_sizes(df, KEYS, 1)) == {(4, 2, 1)}


def test_null_values_are_rows_without_a_place(spark):
    df = frame(spark, [("a", "m", None, 1.0), ("a", "m", 1, 1.0), ("a", "m", 3, 1.0)])
    assert rows_of(pct.exact_thresholds(df, KEYS, probs=(0.5,))) == {("a", "m", 3, 2.0)}


@pytest.mark.parametrize("kept", [False, True])
def test_many_values_in_one_group(spark, tmp_path, kept):
    """Far more values than any sample of a partition holds, some of them huge, infinite or missing."""
    odd = "WHEN id % 1000 = 0 THEN pow(10.0, id % 300) WHEN id = 7 THEN double('inf') WHEN id = 9 THEN -1e300"
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "'hot' AS SKU", "'m' AS year_month", f"CASE {odd} ELSE id * 1.5 END AS promotion_count"
    )
    small = frame(spark, [("cold", "m", 1, None), ("cold", "m", 4, None), ("none", "m", None, None)])
    df = df.unionByName(small.select(*df.columns))
    levels = (0.0, 0.25, 0.8, 0.9, 0.999)
    with Workspace(spark, str(tmp_path)) as workspace:
        profile = pct.value_profile(df, KEYS)
        profile = workspace.stage(profile) if kept else profile
        found = pct.profile_thresholds(profile, KEYS, probs=levels)
        ours = {r[0]: tuple(r)[3:] for r in found.collect()}
    assert ours["none"] == (None,) * 5
    for row in df.groupBy("SKU").agg(F.percentile("promotion_count", list(levels)).alias("x")).collect():
        if row["x"] is not None:
            assert ours[row["SKU"]] == pytest.approx(tuple(row["x"]))


def test_one_hot_group_among_many(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("SKU"),
        F.lit("m").alias("year_month"),
        (F.col("id") * 7919 % 60_000).cast("int").alias("promotion_count"),
    )
    ours = pct.exact_thresholds(df, KEYS)
    built_in = df.groupBy("SKU").agg(F.percentile("promotion_count", [0.8, 0.9]).alias("x"))
    gap = ours.join(built_in, "SKU").agg(
        F.max(F.abs(F.col("p80") - F.col("x")[0])), F.max(F.abs(F.col("p90") - F.col("x")[1])), F.count(F.lit(1))
    )
    low, high, n = gap.first()
    assert n == 501 and low < 1e-6 and high < 1e-6


def test_null_keys_are_groups(spark, rows):
    df = frame(spark, [*rows, (None, None, 2, 1.0), (None, None, 4, 1.0)])
    assert (None, None, 2, 3.0) in rows_of(pct.exact_thresholds(df, KEYS, probs=(0.5,)))


def executed(df):
    """The final physical plan, after the run that adapts it, without the plan it began with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def parquet(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def test_one_read_and_no_join_to_thresholds(spark, rows, tmp_path):
    df = parquet(spark, rows, tmp_path)
    for result in (
        pct.exact_thresholds(df, KEYS),
        pct.exact_statistics(df, KEYS),
        pct.approx_statistics(df, KEYS),
        percentile_statistics(df, amount="amount").comparison,
    ):
        plan = executed(result)
        assert plan.count("FileScan") == 1
        assert plan.count("Exchange ") + plan.count("Exchange(") <= 6


def test_both_methods_stand_side_by_side(spark, rows):
    results = percentile_statistics(frame(spark, rows), amount="amount")
    assert results.comparison.count() == 2 * results.approx.count() == 2 * results.exact.count()


@pytest.mark.parametrize("crowd", [0, 3, 4096])
def test_divided_groups_give_the_same(spark, crowd):
    rng = random.Random(8)
    made = [(name, "m", float(round(draw(rng), 2)), rng.choice((None, rng.randrange(900) / 4)))
            for name, n, draw in [
                ("even", 900, lambda r: r.random() * 100), ("heavy", 900, lambda r: r.paretovariate(0.3)),
                ("equal", 50, lambda r: 7), ("few", 300, lambda r: r.randrange(4)), ("one", 1, lambda r: 5),
                ("edge", 400, lambda r: r.choice((1, 1, 1, r.random()))),
            ] for _ in range(n)]
    made += [("even", "m", None, 1.0), ("none", "m", None, 2.0), (None, "m", 4.0, 2.0), (None, "m", 8.0, 2.0)]
    df = spark.createDataFrame(made, SCHEMA.replace("int", "double"))
    levels = [pct.Level(f"{kind}_{pct.level_name(p)}", p, kind == "e") for kind in "ea" for p in (0.0, 0.1, 0.5, 0.8, 0.9, 1.0)]
    profile = pct.value_profile(df, KEYS, amount="amount")
    found = pct.profile_levels(profile, KEYS, "promotion_count", levels, crowd=crowd)
    for row in found.collect():
        pairs = [(v, a) for k, _, v, a in made if k == row.SKU]
        values = [v for v, _ in pairs if v is not None]
        assert row.order_count == len(pairs)
        for level in levels:
            if not values:
                assert (row[level.name], row[f"{level.name}_order_count"], row[f"{level.name}_stddev"]) == (None, 0, 0.0)
                continue
            expected = interpolated(values, level.probability) if level.exact else nearest(values, level.probability)
            assert row[level.name] == pytest.approx(expected, rel=1e-12)
            picked = [a for v, a in pairs if v is not None and v >= row[level.name]]
            amounts = [a for a in picked if a is not None]
            assert row[f"{level.name}_order_count"] == len(picked)
            assert row[f"{level.name}_amount_count"] == len(amounts)
            assert row[f"{level.name}_stddev"] == pytest.approx(pstdev(amounts) if amounts else 0.0, abs=1e-6)


@pytest.mark.parametrize("crowd", [4096, 10])
def test_approximate_levels_against_the_sketch(spark, crowd, tmp_path):
    """The built-in's own values while its sketch is exact, and within its tolerance of ranks when it is not."""
    path = str(tmp_path / "rows")
    spark.range(4000).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'big' ELSE concat('k', id % 97) END AS SKU", "'m' AS year_month",
        "CAST(id * 7919 % 4001 AS INT) AS promotion_count", "CAST(id % 13 AS DOUBLE) AS amount",
    ).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    probs = (0.0, 0.0001, 0.5, 0.8, 0.9, 1.0)
    built_in = pct.approx_thresholds(df, KEYS, probs=probs)
    levels = [pct.Level(pct.level_name(p), p, exact=False) for p in probs]
    ours = pct.profile_levels(pct.value_profile(df, KEYS, amount="amount"), KEYS, "promotion_count", levels, crowd=crowd)
    assert rows_of(ours) == rows_of(pct.threshold_statistics(df, built_in, KEYS, probs=probs))
    rough = {r.SKU: r for r in pct.approx_thresholds(df, KEYS, accuracy=50).collect()}["big"]
    values = sorted(r.promotion_count for r in df.where("SKU = 'big'").collect())
    mine = {r.SKU: r for r in pct.approx_statistics(df, KEYS, accuracy=50).collect()}["big"]
    for name in ("p80", "p90"):
        assert abs(values.index(mine[name]) - values.index(rough[name])) <= len(values) / 50


def test_comparison(spark, rows):
    df = frame(spark, rows).withColumnRenamed("amount", "amount_value")
    results = percentile_statistics(df)
    found = {(r["SKU"], r["percentile"]): r for r in results.comparison.collect()}
    exact, approx = brute_statistics(rows, interpolated), brute_statistics(rows, nearest)
    assert len(found) == 2 * len(exact)
    for (sku, level), r in found.items():
        i, j = (1, 3) if level == "P80" else (2, 6)
        assert r["approx_threshold"] == approx[sku][i]
        assert r["exact_threshold"] == pytest.approx(exact[sku][i])
        assert r["threshold_diff"] == pytest.approx(abs(approx[sku][i] - exact[sku][i]))
        assert r["changed_order_count"] == abs(approx[sku][j] - exact[sku][j])
    # One selection contains the other, so the count of changes is the size of the difference.
    for sku, (_, e80, e90, *_) in exact.items():
        for level, e, a in (("P80", e80, approx[sku][1]), ("P90", e90, approx[sku][2])):
            changed = [r for r in rows if r[0] == sku and (r[2] >= e) != (r[2] >= a)]
            assert found[sku, level]["changed_order_count"] == len(changed)
    single = cmp.compare_methods(results.approx, results.exact, "p90", KEYS)
    assert rows_of(single) == rows_of(results.comparison.where("percentile = 'P90'"))
    with pytest.raises(ValueError):
        cmp.compare_methods(results.approx, results.exact, "p95", KEYS)


COMPARED = "SKU string, year_month string, percentile string, threshold_diff double, changed_order_count bigint, stddev_diff double"


def test_summary_and_top(spark):
    df = spark.createDataFrame(
        [("a", "m", "P80", 0.5, 1, 2.0), ("b", "m", "P80", 1e-10, 0, 1e-10), ("c", "m", "P90", 1.0, 3, 0.0),
         ("b", "m", "P90", 1.0, 3, 0.0)],
        COMPARED,
    )
    assert [tuple(r) for r in cmp.summarize_comparison(df).collect()] == [
        ("P80", 2, 1, 1, 1, pytest.approx(0.25)), ("P90", 2, 2, 2, 0, 1.0),
    ]
    assert [(r[0], r[2]) for r in cmp.top_changes(df, KEYS, 2).collect()] == [("b", "P90"), ("c", "P90")]
    assert cmp.top_changes(df, KEYS).count() == 3


def test_timing_summary(spark):
    df = spark.createDataFrame([("exact", 1.0), ("exact", 3.0), ("approx", 2.0)], "method string, seconds double")
    assert [tuple(r) for r in cmp.timing_summary(df).collect()] == [
        ("approx", 1, 2.0, None), ("exact", 2, 2.0, pytest.approx(math.sqrt(2))),
    ]


def test_records_count_repeated_promotions(raw):
    df = percentile_records(
        raw(
            {"SKU": " k ", "Date": "04-30-22", "Amount": "1.5", "promotion-ids": "a, a,, ,b"},
            {"SKU": "k", "Date": "bad", "Amount": "", "promotion-ids": None},
        )
    )
    assert rows_of(df.select("SKU", "year_month", "amount_value", "promotion_count")) == {
        (" k ", "2022-04", 1.5, 3), ("k", None, None, 0),
    }


def test_levels_take_one_sort_of_the_histogram(spark):
    df = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 7.0), ("k", 2, 9.0), ("l", 3, 4.0)], "g string, v int, a double")
    levels = [pct.Level("p50", 0.5), pct.Level("near", 0.5, False)]
    out = pct.profile_levels(pct.value_profile(df, ["g"], "v", "a"), ["g"], "v", levels)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 4  # of small and of divided groups, and twice of the ranges
    chosen = out.select("g", "order_count", "p50", "p50_stddev", "near", "near_stddev")
    assert rows_of(chosen) == {("k", 3, 2.0, 1.0, 2.0, 1.0), ("l", 1, 3.0, 0.0, 3.0, 0.0)}
