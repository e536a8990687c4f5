"""Operator-level queries: one per operator of the inventory.

Each reads the whole input tables (through the bronze derivation or the
silver views) and isolates one operator, so a mismatch with the oracle
points at that operator.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, gen, keys
from ..operators import feeds, feedstore, incremental, quality
from ..operators.dedup import distinct_on_key, dropped_duplicates, keep_first
from ..operators.order import sample_rows, with_position
from ..sources import bronze
from ..sources.sinks import materialize, scratch_path
from . import gold, serving, silver
from .queries import catalog
from .registry import VIEWS, Given, enforce

# Words looked up by code number (modulo lookup).
LOOKUP_WORDS = ["amber", "birch", "cobalt", "dune", "ember", "flint", "grove", "harbor", "iris", "juniper",
                "kelp", "lichen"]

FEED_CURSOR_TS = _dt.datetime(2000, 1, 1, 0, 0, 0)
FEED_PAGE_CURSOR = (_dt.datetime(2000, 1, 1, 5, 0, 0), "ENC00005000")
FEED_PAGE_SIZE = 500
APPEND_ONLY_CUTOFF = _dt.datetime(1999, 1, 1, 0, 0, 0)
TENANT = "HMO-SOUTH"
PRUNE_YEAR = 1998
FACT_CHECKS = gold.fact_encounter.spec.checks


def _bronze(spark, root, name):
    return catalog(spark, root).table(f"bronze.{name}")


def _silver(spark, root, name):
    return catalog(spark, root).table(f"silver.{name}")


# --- sources, sinks, generators --------------------------------------------

def src_range_spine(spark: SparkSession, root: str) -> DataFrame:
    """Distributed row spine over the customer keys, kept where the customer
    table has the key, and numbered from 1 (keys begin at 0)."""
    c = catalog(spark, root).inputs["customer"].select(F.col("c_custkey").alias("id"))
    top = c.agg(F.max("id")).first()[0]
    return (spark.range(0, -1 if top is None else top + 1).join(c, "id", "left_semi")
                 .select((F.col("id") + 1).alias("n"))
                 .select("n", keys.business_key("PAT", F.col("n"), 6).alias("PATIENT_BK")))


def audit_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per bronze table plus the active-bed count: one aggregate, and so
    one scan, per table."""
    cat = catalog(spark, root)
    more = {"raw_bed_assignments": [("active_beds", F.count_if(F.col("released_ts").isNull()))]}
    parts = []
    for t in ("raw_patients", "raw_departments", "raw_providers", "raw_diagnoses", "raw_encounters",
              "raw_lab_orders", "raw_bed_assignments", "raw_patient_coverage"):
        counts = [(t, F.count(F.lit(1))), *more.get(t, [])]
        one = cat.table(f"bronze.{t}").agg(*[c.alias(n) for n, c in counts])
        parts.append(one.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("TABLE_NAME"), F.col(n).alias("ROW_COUNT")) for n, _ in counts])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def agg_coverage_by_insurer(spark: SparkSession, root: str) -> DataFrame:
    """SQL text over a DataFrame argument: patients per insurer code."""
    cov = _bronze(spark, root, "raw_patient_coverage")
    return spark.sql("SELECT hmo_code, count(*) AS patients FROM {cov} "
                     "GROUP BY hmo_code ORDER BY hmo_code", cov=cov)


def interval_arithmetic(spark: SparkSession, root: str) -> DataFrame:
    """Timestamp plus ``make_interval`` written as SQL fragments (``expr``)."""
    o = catalog(spark, root).inputs["orders"]
    admit = F.expr("o_orderdate + make_interval(0, 0, 0, 0, cast(pmod(o_orderkey * 7, 24) as int), "
                   "cast(pmod(o_orderkey * 13, 60) as int), cast(pmod(o_orderkey * 17, 60) as int))")
    return (o.select(keys.business_key("ENC", F.col("o_orderkey"), 8).alias("ENCOUNTER_BK"),
                     admit.alias("ADMIT_TS"), F.col("o_orderkey").alias("_k"))
             .select("ENCOUNTER_BK", "ADMIT_TS",
                     F.expr("ADMIT_TS + make_interval(0, 0, 0, cast(pmod(_k, 17) as int), 0, 0, 0)")
                      .alias("DISCHARGE_TS"),
                     F.expr("ADMIT_TS + make_interval(0, 0, 0, 0, cast(1 + pmod(_k, 71) as int), 0, 0)")
                      .alias("FIRST_RESULT_TS")))


def gen_pick_hash(spark: SparkSession, root: str) -> DataFrame:
    c = catalog(spark, root).inputs["customer"]
    k = F.col("c_custkey")
    return c.select(k.alias("c_custkey"),
                    gen.pick_by(bronze.GENDER_RAW, k * 7 + 3).alias("GENDER_RAW"),
                    gen.pick_by(bronze.BLOOD_GROUP_RAW, k * 3 + 1).alias("BLOOD_GROUP_RAW"))


def gen_null_injection(spark: SparkSession, root: str) -> DataFrame:
    c = catalog(spark, root).inputs["customer"]
    k = F.col("c_custkey")
    return c.select(k.alias("c_custkey"),
                    gen.null_when(gen.pick_by(bronze.CITY_RAW, k * 11 + 5), F.pmod(k, F.lit(50)) == 7)
                       .alias("CITY_RAW"))


def gen_stable_bucket(spark: SparkSession, root: str) -> DataFrame:
    """``pmod(xxhash64(key), n)`` insurer pick over the duplicated patient feed,
    as the facts that must hold for it: each key gets one insurer, computed
    in another plan the same one, all insurers occur, and none gets over
    twice its even share. (The hash has no SQL twin; the tests pin values.)"""
    raw = _bronze(spark, root, "raw_patients").select("patient_bk")
    picked = raw.select("patient_bk", keys.pick_stable(bronze.HMO_CODES, "patient_bk").alias("hmo"))
    c = catalog(spark, root).inputs["customer"]
    bk = keys.business_key("PAT", F.col("c_custkey"), 6)
    again = c.select(bk.alias("patient_bk"), keys.pick_stable(bronze.HMO_CODES, bk).alias("again"))
    per_key = (picked.groupBy("patient_bk").agg(F.count_distinct("hmo").alias("n"), F.min("hmo").alias("hmo"))
                     .join(again, "patient_bk", "full_outer"))
    per_hmo = per_key.groupBy("hmo").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("pairs"),
                                         F.count_if(~F.col("hmo").eqNullSafe(F.col("again"))).alias("moved"))
    return per_hmo.agg(F.sum("keys").alias("N_KEYS"), F.sum("pairs").alias("N_PAIRS"),
                       F.count_distinct("hmo").alias("N_INSURERS"), F.sum("moved").alias("N_MOVED"),
                       (F.max("keys") * len(bronze.HMO_CODES) <= 2 * F.sum("keys")).alias("EVEN"))


def gen_modulo_lookup(spark: SparkSession, root: str) -> DataFrame:
    p = catalog(spark, root).inputs["part"]
    arr = F.array(*[F.lit(v) for v in LOOKUP_WORDS])
    return p.select(keys.business_key("DX-", F.col("p_partkey"), 4).alias("DIAGNOSIS_BK"),
                    F.element_at(arr, (F.pmod(F.col("p_partkey"), F.lit(len(LOOKUP_WORDS))) + 1)
                                 .cast("int")).alias("LOOKED_UP"))


def sample_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Seeded Bernoulli sample of the patient feed, as the facts that must
    hold for it: no row that the feed lacks, a second draw with the seed is
    the same, and its share lies within five standard deviations."""
    raw = _bronze(spark, root, "raw_patients")
    one, two = raw.sample(fraction=0.05, seed=42), raw.sample(fraction=0.05, seed=42)
    drawn = one.agg(F.count(F.lit(1))).scalar()
    n = F.count(F.lit(1))
    return raw.agg(
        n.alias("N_FEED"),
        (F.abs(drawn - 0.05 * n) <= 5 * F.sqrt(n * 0.05 * 0.95) + 1).alias("SHARE_RIGHT"),
        incremental.multiset_minus(one, raw).agg(F.count(F.lit(1))).scalar().alias("N_FOREIGN"),
        incremental.multiset_minus(one, two).agg(F.count(F.lit(1))).scalar().alias("N_UNSTABLE"))


def _raw_pat(spark, root):
    return _bronze(spark, root, "raw_patients").select("patient_bk", "full_name", "dob")


def dedup_latest(spark: SparkSession, root: str) -> DataFrame:
    """Survivor per patient: raw birth-date text ascending, NULLs last."""
    return keep_first(_raw_pat(spark, root), "patient_bk", [F.col("dob").asc_nulls_last()],
                      tie_break=["full_name"])


def dup_inject_dedup(spark: SparkSession, root: str) -> DataFrame:
    """The injected duplicates the dedup removed (input minus survivors)."""
    return dropped_duplicates(_raw_pat(spark, root), "patient_bk", [F.col("dob").asc_nulls_last()],
                              tie_break=["full_name"])


def distinct_on_key_q(spark: SparkSession, root: str) -> DataFrame:
    raw = _bronze(spark, root, "raw_patients").select("patient_bk", "insurance_type", "dob")
    return distinct_on_key(raw, "patient_bk", order_by="dob").select("patient_bk", "insurance_type")


def dob_parse_mixed(spark: SparkSession, root: str) -> DataFrame:
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", "dob", clean.mixed_date("dob").alias("DATE_OF_BIRTH"))


def dob_parse_dayfirst_compat(spark: SparkSession, root: str) -> DataFrame:
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", "dob", clean.mixed_date("dob", dayfirst_compat=True).alias("DATE_OF_BIRTH"))


def dob_parse_leftovers(spark: SparkSession, root: str) -> DataFrame:
    """Birth dates in ways that no layout covers (ordinals, weekday names, times,
    year and month alone, no date at all) among others that one does."""
    c = catalog(spark, root).inputs["customer"]
    k = F.col("c_custkey")
    dob = F.date_add(F.lit("1940-01-01").cast("date"), F.pmod(k * 41, F.lit(20_000)).cast("int"))
    day = F.dayofmonth(dob)
    ending = (F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th"))
    texts = F.array(
        gen.date_text(dob, "dd/MM/yyyy"),
        F.concat(day.cast("string"), ending, F.lit(" of "), gen.date_text(dob, "MMMM yyyy")),
        F.concat(gen.date_text(dob, "MMM "), day.cast("string"), ending, gen.date_text(dob, ", yyyy")),
        gen.date_text(dob, "EEEE, d MMMM yyyy"),
        gen.date_text(dob, "EEE d MMM yyyy"),
        gen.date_text(dob, "yyyy-MM-dd '10:30:00'"),
        gen.date_text(dob, "dd/MM/yyyy '07:45'"),
        gen.date_text(dob, "MMMM yyyy"),
        F.lit("not known"),
        gen.date_text(dob, "d MMMM"))
    kind = F.pmod(k, F.lit(10)).cast("int")
    return c.select("c_custkey", kind.alias("KIND"), F.element_at(texts, kind + 1).alias("_text")).select(
        "c_custkey", "KIND", clean.any_date("_text").alias("DATE_OF_BIRTH"))


def money_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    raw = _bronze(spark, root, "raw_encounters")
    b, p = clean.money("billed_amount_raw"), clean.money("amount_paid_raw")
    return raw.select("encounter_bk", "billed_amount_raw", "amount_paid_raw",
                      b.alias("BILLED_AMOUNT"), p.alias("AMOUNT_PAID"), (b - p).alias("OUTSTANDING_AMOUNT"))


def business_keys_q(spark: SparkSession, root: str) -> DataFrame:
    e = _bronze(spark, root, "raw_encounters")
    return (e.select("encounter_bk", "patient_bk", "provider_bk", "department_bk", "diagnosis_bk")
             .select("*",
                     F.concat("encounter_bk", F.lit("-BED01")).alias("bed_assignment_bk"),
                     F.concat(F.lit("COV"), keys.key_text("patient_bk", 3)).alias("coverage_bk"),
                     F.concat(F.lit("POL-"), keys.key_text("patient_bk", 3)).alias("policy_no")))


def explode_sequence_lines(spark: SparkSession, root: str) -> DataFrame:
    """Child rows 1..n per parent with ``explode(sequence(1, n))``."""
    o = catalog(spark, root).inputs["orders"]
    enc = keys.business_key("ENC", F.col("o_orderkey"), 8)
    lines = o.select(enc.alias("ENCOUNTER_BK"),
                     gen.line_numbers(F.pmod(F.col("o_orderkey"), F.lit(4)) + 1).alias("SEQ"))
    return lines.select("ENCOUNTER_BK", "SEQ",
                        F.concat("ENCOUNTER_BK", F.format_string("-LAB%02d", F.col("SEQ"))).alias("LINE_BK"))


# --- cleansers ---------------------------------------------------------------

def clean_title_case(spark, root):
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", F.col("full_name").alias("RAW_FULL_NAME"), clean.title_case("full_name").alias("FULL_NAME"))


def clean_acronym(spark, root):
    raw = _bronze(spark, root, "raw_departments")
    return raw.select("department_bk", F.col("ward_type").alias("RAW_WARD_TYPE"), clean.acronym_case("ward_type").alias("WARD_TYPE"))


def clean_gender(spark, root):
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", F.col("gender").alias("RAW_GENDER"), clean.gender("gender").alias("GENDER"))


def clean_code(spark, root):
    raw = _bronze(spark, root, "raw_bed_assignments")
    return raw.select("bed_assignment_bk", F.col("ward_no").alias("RAW_WARD_NO"), clean.code("ward_no").alias("WARD_NO"),
                      clean.code("ward_no", squeeze=True).alias("WARD_NO_SQUEEZED"))


def clean_default_unknown(spark, root):
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", F.col("city").alias("RAW_CITY"), clean.or_unknown("city").alias("CITY"))


def classify_payer(spark, root):
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", F.col("insurance_type").alias("RAW_INSURANCE_TYPE"),
                      clean.payer("insurance_type", "Self-Pay").alias("INSURANCE_TYPE"),
                      clean.payer("insurance_type", "SELF_PAY").alias("PAYER_TYPE"),
                      clean.payer("insurance_type", "SELF-PAY").alias("INSURER_CODE"))


def clean_strip_title(spark, root):
    raw = _bronze(spark, root, "raw_providers")
    return raw.select("provider_bk", F.col("provider_name").alias("RAW_PROVIDER_NAME"), clean.strip_title("provider_name").alias("PROVIDER_NAME"))


def phone_normalize(spark, root):
    raw = _bronze(spark, root, "raw_patients")
    return raw.select("patient_bk", F.col("phone").alias("RAW_PHONE"), clean.phone("phone").alias("PHONE"))


def length_of_stay(spark, root):
    e = _silver(spark, root, "encounter_silver")
    return e.select("ENCOUNTER_BK", "ADMIT_TS", "DISCHARGE_TS",
                    clean.length_of_stay("ADMIT_TS", "DISCHARGE_TS").alias("LENGTH_OF_STAY_DAYS"))


def age_years(spark, root):
    cat = catalog(spark, root)
    p = cat.table("silver.patient_silver")
    return p.select("PATIENT_BK", "DATE_OF_BIRTH", clean.age_years("DATE_OF_BIRTH", cat.as_of_col()).alias("AGE"))


# --- filters, joins, aggregates ---------------------------------------------

def filter_open_encounters(spark, root):
    e = _silver(spark, root, "encounter_silver")
    return serving.open_encounters(e).select("ENCOUNTER_BK", "PATIENT_BK", "ADMIT_TS", "STATUS")


def join_left_dim(spark, root):
    cat = catalog(spark, root)
    e = cat.table("silver.encounter_silver").select("ENCOUNTER_BK", "DEPARTMENT_BK")
    d = cat.table("silver.department_silver").select("DEPARTMENT_BK", "DEPARTMENT_NAME", "WARD_TYPE")
    return e.join(d, "DEPARTMENT_BK", "left")


def _labs_joined(enc, labs):
    agg = gold.labs_per_encounter(labs)
    return enc.select("ENCOUNTER_BK").join(agg, "ENCOUNTER_BK", "left").select(
        "ENCOUNTER_BK",
        F.coalesce("NUM_LAB_TESTS", F.lit(0)).alias("NUM_LAB_TESTS"),
        F.coalesce("TOTAL_LAB_COST", F.lit(0).cast("decimal(18,2)")).alias("TOTAL_LAB_COST"))


def join_left_preagg(spark, root):
    cat = catalog(spark, root)
    return _labs_joined(cat.table("silver.encounter_silver"), cat.table("silver.lab_order_silver"))


def join_inner_on_filter(spark, root):
    cat = catalog(spark, root)
    e = cat.table("silver.encounter_silver").select("ENCOUNTER_BK", "PATIENT_BK")
    c = cat.table("silver.patient_coverage_silver").where("IS_HMO").select("PATIENT_BK", "HMO_CODE", "POLICY_NO")
    return e.join(c, "PATIENT_BK", "inner")


def star_join_multi(spark, root):
    cat = catalog(spark, root)
    labs = cat.table("silver.lab_order_silver").select("LAB_ORDER_BK", "ENCOUNTER_BK")
    e = cat.table("silver.encounter_silver").select("ENCOUNTER_BK", "PATIENT_BK", "PROVIDER_BK",
                                                     "DEPARTMENT_BK", "DIAGNOSIS_BK")
    pat = cat.table("silver.patient_silver").select("PATIENT_BK", "FULL_NAME")
    prov = cat.table("silver.provider_silver").select("PROVIDER_BK", F.col("PROVIDER_NAME").alias("ATTENDING_PROVIDER"))
    dept = cat.table("silver.department_silver").select("DEPARTMENT_BK", "DEPARTMENT_NAME")
    dx = cat.table("silver.diagnosis_silver").select("DIAGNOSIS_BK", "DIAGNOSIS_DESC")
    j = (labs.join(e, "ENCOUNTER_BK", "inner").join(pat, "PATIENT_BK", "left")
             .join(prov, "PROVIDER_BK", "left").join(dept, "DEPARTMENT_BK", "left")
             .join(dx, "DIAGNOSIS_BK", "left"))
    return j.select("LAB_ORDER_BK", "PATIENT_BK", "FULL_NAME", "ATTENDING_PROVIDER", "DEPARTMENT_NAME",
                    "DIAGNOSIS_DESC")


def agg_labs_per_encounter(spark, root):
    return gold.labs_per_encounter(_silver(spark, root, "lab_order_silver"))


def agg_admissions_per_patient(spark, root):
    return serving.admission_counts(_silver(spark, root, "encounter_silver"))


def agg_abnormal_per_encounter(spark, root):
    return serving.abnormal_lab_counts(_silver(spark, root, "lab_order_silver"))


# --- data quality ------------------------------------------------------------

def _fact_input(spark, root):
    return _silver(spark, root, "encounter_silver").select(
        "ENCOUNTER_BK", "BILLED_AMOUNT", "LENGTH_OF_STAY_DAYS", "STATUS")


def dq_drop(spark, root):
    kept, _ = quality.split_by_checks(_fact_input(spark, root), FACT_CHECKS)
    return kept


def dq_violation_counts(spark, root):
    return quality.violation_counts(_fact_input(spark, root), FACT_CHECKS)


def dq_null_policy_drop(spark, root):
    strict = [quality.Check(c.name, c.predicate, c.action, "drop", c.null_columns) for c in FACT_CHECKS]
    kept, _ = quality.split_by_checks(_fact_input(spark, root), strict)
    return kept


def dq_quarantine(spark, root):
    """Rows failing a drop-check, with the names of the checks they failed."""
    _, dropped = quality.split_by_checks(_fact_input(spark, root), FACT_CHECKS)
    return dropped.select("ENCOUNTER_BK", F.array_join("failed_checks", ",").alias("FAILED_CHECKS"))


# For each view with checks: a column to break, in rows whose key number is
# divisible by seven, and the value put there. The other checks of these views
# are broken by the input itself.
BROKEN = {
    "silver.patient_silver": ("PATIENT_BK", None, "PATIENT_BK"),
    "silver.lab_order_silver": (None, None, None),
    "silver.bed_assignment_silver": ("ENCOUNTER_BK", None, "ENCOUNTER_BK"),
    "silver.patient_coverage_silver": ("PATIENT_BK", None, "PATIENT_BK"),
    "gold.dim_patient": ("PATIENT_BK", None, "PATIENT_BK"),
    "gold.fact_encounter": ("LENGTH_OF_STAY_DAYS", -1, "ENCOUNTER_BK"),
    "graphql.current_ward_census": (None, None, None),
    "graphql.hmo_encounter_summary": ("HMO_CODE", None, "PATIENT_BK"),
    "graphql.abnormal_lab_alerts": ("RESULTED_TS", None, "ENCOUNTER_BK"),
}


def dq_every_check(spark, root):
    """Violations of every check of every view, over rows that break it."""
    cat = catalog(spark, root)
    parts = []
    for name, (column, value, key) in BROKEN.items():
        rows = VIEWS[name].fn(cat)
        if column:
            bad = F.pmod(keys.key_number(key, 3), F.lit(7)) == 0
            kind = rows.schema[column].dataType
            rows = rows.withColumn(column, F.when(bad, F.lit(value).cast(kind)).otherwise(F.col(column)))
        parts.append(quality.violation_counts(rows, VIEWS[name].checks).select(F.lit(name).alias("view_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


# --- feeds -------------------------------------------------------------------

def _alerts(spark, root):
    return catalog(spark, root).table("graphql.abnormal_lab_alerts").select("ALERT_BK", "RESULTED_TS")


def feed_since(spark, root):
    return feeds.read_since(_alerts(spark, root), "RESULTED_TS", cursor=FEED_CURSOR_TS)


def feed_since_composite(spark, root):
    """One page of ``FEED_PAGE_SIZE`` alerts after a ``(time, key)`` cursor."""
    return feeds.read_since(_alerts(spark, root), "RESULTED_TS", "ALERT_BK", cursor=FEED_PAGE_CURSOR,
                            limit=FEED_PAGE_SIZE)


def feed_since_stored(spark, root):
    """The same page from the feed stored by time: months before the cursor, and
    those after the one that fills the page, are not read."""
    alerts = _alerts(spark, root)
    path = scratch_path(spark, "alert-feed")
    feedstore.write_feed(alerts, path, "RESULTED_TS", "ALERT_BK")
    feed = feedstore.open_feed(spark, path, alerts.schema)
    return feedstore.poll(feed, "RESULTED_TS", "ALERT_BK", cursor=FEED_PAGE_CURSOR, limit=FEED_PAGE_SIZE,
                          digest=feedstore.digests(feed, ["ALERT_BK"]))


EVENT_CURSOR = (_dt.datetime(2024, 1, 2, 0, 0, 0), 0)
EVENT_PAGE_SIZE = 1000


def feed_since_events(spark, root):
    """The cursor read on the raw event stream: one page after ``(ts, event_id)``."""
    ev = catalog(spark, root).inputs["events"].select("event_id", "ts", "event_type")
    return feeds.read_since(ev, "ts", "event_id", cursor=EVENT_CURSOR, limit=EVENT_PAGE_SIZE)


def feed_append_only_check(spark, root):
    """Published snapshot at a cutoff vs the current feed: what has vanished.

    The snapshot also holds alerts of encounters cancelled since (status code
    9 of 11) under their own keys, and shows another test name for line 2 of
    an encounter, so both kinds of loss have a known number."""
    cat = catalog(spark, root)
    cols = ["ALERT_BK", "TEST_NAME", "RESULTED_TS"]

    def stored(name, rows):
        path = scratch_path(spark, f"feed-{name}")
        feedstore.write_feed(rows, path, "RESULTED_TS", "ALERT_BK")
        feed = feedstore.open_feed(spark, path, rows.schema)
        return feed, materialize(feedstore.digests(feed, cols), f"digests-{name}")

    # The abnormal lines are cleansed once, for the feed and for what it has lost.
    # Of the lines a cheap test on the flag leaves a part; only that part's costs
    # are parsed for the checks of the view.
    view = VIEWS["silver.lab_order_silver"]
    abnormal = materialize(enforce(view.fn(cat).where(F.col("RESULT_FLAG") == "Abnormal"), view.checks, stored=False)
                           .select("LAB_ORDER_BK", "ENCOUNTER_BK", "TEST_NAME", "RESULT_FLAG", "RESULTED_TS"), "abnormal-labs")
    alerts = VIEWS["graphql.abnormal_lab_alerts"]
    given = Given({n: abnormal if n == "silver.lab_order_silver" else cat.table(n) for n in alerts.inputs})
    new, new_digest = stored("current", enforce(alerts.fn(given), alerts.checks).select(cols))
    shown = F.when(F.substring("ALERT_BK", 12, 6) == "-LAB02", F.lit("Renamed")).otherwise(F.col("TEST_NAME"))
    cut = F.col("RESULTED_TS") <= F.lit(APPEND_ONLY_CUTOFF)
    gone = (abnormal.where(cut)
               .join(cat.table("silver.encounter_silver").where(F.col("STATUS") == "Cancelled").select("ENCOUNTER_BK"),
                     "ENCOUNTER_BK", "left_semi")
               .select(F.col("LAB_ORDER_BK").alias("ALERT_BK"), "TEST_NAME", "RESULTED_TS"))
    published = new.where(cut).withColumn("TEST_NAME", shown).select(cols)
    old, old_digest = stored("published", published.unionByName(gone))
    removed = feedstore.removed_from_feed(old, new, cols, "ALERT_BK", old_digest, new_digest)
    # One aggregate over the current feed; the removed-row count rides along
    # as a scalar subquery.
    return new.agg(
        F.count_if(F.col("RESULTED_TS") <= F.lit(APPEND_ONLY_CUTOFF)).alias("OLD_ROWS"),
        F.count(F.lit(1)).alias("NEW_ROWS"),
        removed.select(F.count(F.lit(1))).scalar().alias("REMOVED_ROWS"))


def tenant_scope(spark, root):
    """The insurer feed written partitioned by HMO_CODE, read for one tenant."""
    feed = catalog(spark, root).table("graphql.hmo_encounter_summary")
    stored = materialize(feed, "hmo_encounter_summary", partition_by=["HMO_CODE"])
    return feeds.scope_to_tenant_sql(stored, "HMO_CODE", TENANT)


def partition_pruned_year(spark, root):
    fact = catalog(spark, root).table("gold.fact_encounter")
    stored = materialize(fact, "fact_encounter", partition_by=["ADMIT_YEAR"])
    return stored.where(F.col("ADMIT_YEAR") == PRUNE_YEAR).drop(
        "ENCOUNTER_SK", "PATIENT_SK", "PROVIDER_SK", "DEPARTMENT_SK", "DIAGNOSIS_SK")


# --- incremental refresh and change feed ------------------------------------

def _snapshots(spark, root):
    """Two snapshots of the raw encounter feed.

    ``before`` lacks every 10th encounter (k % 10 = 1, inserted since), shows
    an older status for k % 10 = 2 (updated since) and still holds a
    retired copy of k % 10 = 3 under a ``-R`` key (deleted since).
    ``after`` is the current feed.
    """
    after = _bronze(spark, root, "raw_encounters")
    k = keys.key_number("encounter_bk", 3)
    cur = after.withColumn("_k", k)
    before = (cur.where(F.pmod("_k", F.lit(10)) != 1)
                 .withColumn("status", F.when(F.pmod("_k", F.lit(10)) == 2, F.lit("Admitted"))
                             .otherwise(F.col("status"))))
    retired = (cur.where(F.pmod("_k", F.lit(10)) == 3)
                  .withColumn("encounter_bk", F.concat("encounter_bk", F.lit("-R"))))
    return before.unionByName(retired).drop("_k"), after


def change_feed_diff(spark, root):
    """Two stored snapshots, bucketed by key: compared without a shuffle."""
    before, after = [incremental.store_snapshot(df, "encounter_bk", scratch_path(spark, "snapshot"), SNAPSHOT_BUCKETS)
                     for df in _snapshots(spark, root)]
    ch = incremental.change_feed_stored(before, after, "encounter_bk")
    return ch.select("encounter_bk", "status", incremental.CHANGE_COL)


SNAPSHOT_BUCKETS = 8


def order_position(spark, root):
    """Every order's place by price, dearest first."""
    o = catalog(spark, root).inputs["orders"].select("o_orderkey", "o_totalprice", "o_orderdate")
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    return with_position(o, order).select("o_orderkey", "o_totalprice", "POSITION")


SAMPLE_ROWS, SAMPLE_SEED = 250, 11


def sample_exact(spark, root):
    """A sample of an exact size that any partitioning of the input gives."""
    c = catalog(spark, root).inputs["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return sample_rows(c, "o_orderkey", SAMPLE_ROWS, SAMPLE_SEED)


def _encounter_view(raw):
    return silver.encounter_silver(Given({"bronze.raw_encounters": raw}))


def incr_rowwise_equals_full(spark, root):
    """Old silver (from ``before``) refreshed with the change feed; must equal
    the silver view recomputed in full on ``after``."""
    before, after = _snapshots(spark, root)
    old = _encounter_view(before)
    ch = incremental.change_feed(before, after, "encounter_bk")
    return incremental.refresh_rowwise(_encounter_view, old, ch, "encounter_bk", "ENCOUNTER_BK")


def incr_aggregate_equals_full(spark, root):
    """Lab roll-up per encounter stored before labs came, changed and went, then
    kept up by what the change feed adds and takes away (groups that lose their
    last lab included); must equal a full run."""
    cat = catalog(spark, root)
    cols = ["LAB_ORDER_BK", "ENCOUNTER_BK", "TEST_COST"]
    # Lab keys end in a digest as hex text: zstd halves it, the usual codec does not.
    labs = materialize(cat.table("silver.lab_order_silver").select(cols), "labs-now", compression="zstd")
    enc = cat.table("silver.encounter_silver").select("ENCOUNTER_BK")
    # The state before: labs of part 0 (mod 7) had not come yet, those of part 1
    # cost one more, and encounters of part 2 had a line that is gone now (those
    # without other labs lose their group with it).
    part = F.pmod(F.crc32("LAB_ORDER_BK"), F.lit(7))
    was = labs.where(part != 0).withColumn("TEST_COST", F.when(part == 1, F.col("TEST_COST") + 1).otherwise(F.col("TEST_COST"))
                                           .cast("decimal(18,2)"))
    gone = (enc.where(F.pmod(F.crc32("ENCOUNTER_BK"), F.lit(7)) == 2)
               .select(F.concat("ENCOUNTER_BK", F.lit("-GONE")).alias("LAB_ORDER_BK"), "ENCOUNTER_BK",
                       F.lit(1).cast("decimal(18,2)").alias("TEST_COST")))
    before = materialize(was.select(cols).unionByName(gone), "labs-before", compression="zstd")
    state = materialize(incremental.group_state(before, "ENCOUNTER_BK", ["TEST_COST"]), "labs-state")
    changes = incremental.change_feed(before, labs, ["LAB_ORDER_BK", "ENCOUNTER_BK"])
    delta = materialize(incremental.group_delta(changes, "ENCOUNTER_BK", ["TEST_COST"]), "labs-delta")
    now = incremental.group_result(incremental.apply_group_delta(state, delta, "ENCOUNTER_BK"), "ENCOUNTER_BK",
                                   "NUM_LAB_TESTS", {"TEST_COST": "TOTAL_LAB_COST"})
    return enc.join(now, "ENCOUNTER_BK", "left").select(
        "ENCOUNTER_BK", F.coalesce(F.col("NUM_LAB_TESTS").cast("int"), F.lit(0)).alias("NUM_LAB_TESTS"),
        F.coalesce(F.col("TOTAL_LAB_COST").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("TOTAL_LAB_COST"))


# --- scalar function coverage -------------------------------------------------

def scalar_string(spark, root):
    c = catalog(spark, root).inputs["customer"]
    n = F.col("c_name")
    return c.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("TRIMMED"),
        F.lower(n).alias("LOWERED"), F.upper(n).alias("UPPERED"),
        F.initcap(F.lower(F.concat(n, F.lit(" of "), F.col("c_mktsegment")))).alias("INITCAPPED"),
        F.concat(F.lit("C-"), n).alias("CONCATENATED"),
        F.concat_ws(" ", F.col("c_mktsegment"), n).alias("CONCAT_WS"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("LPADDED"),
        F.substring(n, 10, 9).alias("SUBSTRINGED"),
        F.format_number(F.col("c_acctbal").cast("decimal(18,2)"), 2).alias("FORMATTED"),
        F.regexp_replace(n, "[^0-9]", "").alias("DIGITS_ONLY"))


def scalar_datetime(spark, root):
    o = catalog(spark, root).inputs["orders"]
    d = F.to_date("o_orderdate")
    as_of = catalog(spark, root).as_of_col()
    txt = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        "o_orderkey", d.alias("D"),
        F.date_format(d, "dd/MM/yyyy").alias("DATE_TEXT"),
        F.year(d).alias("YEAR"), F.quarter(d).alias("QUARTER"), F.month(d).alias("MONTH"),
        F.dayofmonth(d).alias("DAY"), F.weekofyear(d).alias("WEEK_OF_YEAR"),
        F.datediff(as_of, d).alias("DAYS_TO_AS_OF"),
        F.date_sub(d, 30).alias("MINUS_30"),
        F.from_unixtime(F.unix_timestamp(txt, "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss").alias("ROUNDTRIP"),
        F.to_date(F.date_format(d, "yyyy-MM-dd"), "yyyy-MM-dd").alias("REPARSED"))


def scalar_math(spark, root):
    li = catalog(spark, root).inputs["lineitem"]
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.floor(F.col("l_quantity") / 7).alias("FLOOR_QTY"),
        F.round(price * F.lit(1.07).cast("decimal(3,2)"), 2).alias("ROUND_PRICE"),
        F.abs(F.col("l_quantity") - 25).alias("ABS_DIFF"),
        F.pmod(F.col("l_orderkey") - 1000, F.lit(7)).alias("PMOD"),
        (-F.col("l_quantity")).alias("NEG_QTY"),
        (F.col("l_linenumber") * 3 + 1).alias("ARITH"))


def scalar_array(spark, root):
    o = catalog(spark, root).inputs["orders"]
    k = F.col("o_orderkey")
    seq = F.sequence(F.lit(1), (F.pmod(k, F.lit(5)) + 1).cast("int"))
    return o.select(
        "o_orderkey",
        F.element_at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")),
                     (F.pmod(k, F.lit(3)) + 1).cast("int")).alias("ELEM"),
        F.element_at(seq, -1).alias("SEQ_LAST"),
        F.size(seq).alias("SEQ_SIZE"))


OPERATOR_QUERIES = {
    "src_range_spine": src_range_spine,
    "audit_row_counts": audit_row_counts,
    "agg_coverage_by_insurer": agg_coverage_by_insurer,
    "interval_arithmetic": interval_arithmetic,
    "gen_pick_hash": gen_pick_hash,
    "gen_null_injection": gen_null_injection,
    "gen_stable_bucket": gen_stable_bucket,
    "gen_modulo_lookup": gen_modulo_lookup,
    "sample_duplicates": sample_duplicates,
    "dup_inject_dedup": dup_inject_dedup,
    "dedup_latest": dedup_latest,
    "distinct_on_key": distinct_on_key_q,
    "dob_parse_mixed": dob_parse_mixed,
    "dob_parse_dayfirst_compat": dob_parse_dayfirst_compat,
    "dob_parse_leftovers": dob_parse_leftovers,
    "money_roundtrip": money_roundtrip,
    "business_keys": business_keys_q,
    "explode_sequence_lines": explode_sequence_lines,
    "clean_title_case": clean_title_case,
    "clean_acronym": clean_acronym,
    "clean_gender": clean_gender,
    "clean_code": clean_code,
    "clean_default_unknown": clean_default_unknown,
    "classify_payer": classify_payer,
    "clean_strip_title": clean_strip_title,
    "phone_normalize": phone_normalize,
    "length_of_stay": length_of_stay,
    "age_years": age_years,
    "filter_open_encounters": filter_open_encounters,
    "join_left_dim": join_left_dim,
    "join_left_preagg": join_left_preagg,
    "join_inner_on_filter": join_inner_on_filter,
    "star_join_multi": star_join_multi,
    "agg_labs_per_encounter": agg_labs_per_encounter,
    "agg_admissions_per_patient": agg_admissions_per_patient,
    "agg_abnormal_per_encounter": agg_abnormal_per_encounter,
    "dq_drop": dq_drop,
    "dq_violation_counts": dq_violation_counts,
    "dq_null_policy_drop": dq_null_policy_drop,
    "dq_quarantine": dq_quarantine,
    "dq_every_check": dq_every_check,
    "feed_since": feed_since,
    "feed_since_composite": feed_since_composite,
    "feed_since_stored": feed_since_stored,
    "feed_since_events": feed_since_events,
    "feed_append_only_check": feed_append_only_check,
    "tenant_scope": tenant_scope,
    "partition_pruned_year": partition_pruned_year,
    "change_feed_diff": change_feed_diff,
    "order_position": order_position,
    "sample_exact": sample_exact,
    "incr_rowwise_equals_full": incr_rowwise_equals_full,
    "incr_aggregate_equals_full": incr_aggregate_equals_full,
    "scalar_string": scalar_string,
    "scalar_datetime": scalar_datetime,
    "scalar_math": scalar_math,
    "scalar_array": scalar_array,
}
