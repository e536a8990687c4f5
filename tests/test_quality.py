from pyspark.sql import functions as F

from wardline.operators.quality import (Check, CheckFailed, apply_checks, raise_on_failures,
                                        split_by_checks, violation_counts)

ROWS = [(1, 10.0), (2, -1.0), (3, None)]


def frame(spark):
    return spark.createDataFrame(ROWS, "id int, v double")


def test_null_predicate_passes_by_default(spark):
    kept, dropped = split_by_checks(frame(spark), [Check("pos", "v >= 0")])
    assert sorted(r.id for r in kept.collect()) == [1, 3]
    assert [(r.id, r.failed_checks) for r in dropped.collect()] == [(2, ["pos"])]


def test_null_policy_drop(spark):
    kept, _ = split_by_checks(frame(spark), [Check("pos", "v >= 0", null_policy="drop")])
    assert [r.id for r in kept.collect()] == [1]


def test_kept_plus_dropped_is_input(spark):
    df = spark.range(1000).select((F.col("id") % 7 - 3).alias("v"))
    checks = [Check("pos", F.col("v") >= 0), Check("small", "v < 3")]
    kept, dropped = split_by_checks(df, checks)
    assert kept.count() + dropped.count() == 1000


def test_observed_counts_come_from_the_same_job(spark):
    checks = [Check("pos", "v >= 0"), Check("warn_big", "v < 5", action="warn")]
    kept, obs = apply_checks(frame(spark), checks)
    assert kept.count() == 2
    got = obs.get
    assert got["_input_rows"] == 3 and got["pos"] == 1 and got["warn_big"] == 1


def test_fail_action(spark):
    checks = [Check("must_be_pos", "v >= 0", action="fail")]
    kept, obs = apply_checks(frame(spark), checks)
    kept.count()
    try:
        raise_on_failures(obs, checks)
        raise AssertionError("expected failure")
    except CheckFailed:
        pass


def test_violation_counts(spark):
    rows = {r.check_name: (r.violations, r.input_rows)
            for r in violation_counts(frame(spark), [Check("pos", "v >= 0"),
                                                     Check("nn", "v IS NOT NULL")]).collect()}
    assert rows == {"pos": (1, 3), "nn": (1, 3)}


def test_null_columns_form_is_equivalent(spark):
    a = Check("pos", "v >= 0")
    b = Check("pos", "v >= 0", null_columns=("v",))
    df = frame(spark)
    assert sorted(r.id for r in df.where(a.passes).collect()) == sorted(r.id for r in df.where(b.passes).collect())
    assert df.where(a.violates).count() == df.where(b.violates).count() == 1
