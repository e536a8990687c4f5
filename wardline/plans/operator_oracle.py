"""Oracle SQL (DuckDB) for the operator-level queries.

Raw bronze text is rebuilt here from the key rules (``RAW``), clean values
come from the silver relations of :mod:`.oracle`.
"""

from __future__ import annotations

from ..sources import bronze as B
from .oracle import _WITH, AS_OF, _cents_dec, _initcap, _list

_D = "DATE '1930-01-01' + CAST((c_custkey * 37) % 25567 AS INTEGER)"
_DIGITS = "lpad(CAST((c_custkey * 7919 + 104729) % 1000000000 AS VARCHAR), 9, '0')"
_PHONE = f"""CASE WHEN c_custkey % 50 = 1 THEN 'n/a'
     WHEN c_custkey % 6 = 0 THEN '+234' || {_DIGITS}
     WHEN c_custkey % 6 = 1 THEN '0' || {_DIGITS}
     WHEN c_custkey % 6 = 2 THEN '234 ' || {_DIGITS}
     WHEN c_custkey % 6 = 3 THEN '+234-' || substr({_DIGITS}, 1, 3) || '-' || substr({_DIGITS}, 4, 6)
     WHEN c_custkey % 6 = 4 THEN '(+234) ' || {_DIGITS}
     ELSE '+234 0' || {_DIGITS} END"""
_INS = ("CASE c_mktsegment " + " ".join(
    f"WHEN '{s}' THEN CASE WHEN c_custkey % 2 = 0 THEN '{a}' ELSE '{b}' END"
    for s, (a, b) in B.INSURANCE_BY_SEGMENT.items()) + f" ELSE '{B.INSURANCE_OTHER}' END")
_ADMIT = ("o_orderdate + to_seconds(((o_orderkey * 7) % 24) * 3600 + ((o_orderkey * 13) % 60) * 60 "
          "+ (o_orderkey * 17) % 60)")
_BILLED_CENTS = ("CASE WHEN o_orderkey % 67 = 0 THEN -CAST(round(o_totalprice * 100) AS BIGINT) "
                 "ELSE CAST(round(o_totalprice * 100) AS BIGINT) END")


def _money_text(cents: str) -> str:
    return f"'₦' || format('{{:,.2f}}', {_cents_dec(cents)})"


# The layouts of birth-date text, in the order of the generator's.
_LAYOUTS = ["%Y-%m-%d", "%d/%m/%Y", "%Y-%-m-%-d", "%-d %b %Y", "%d-%m-%Y", "%Y/%m/%d", "%d.%m.%Y", "%B %-d, %Y"]


def layout(k: str) -> str:
    return f"CASE ({k}) % 8 " + " ".join(f"WHEN {i} THEN strftime(d, '{f}')" for i, f in enumerate(_LAYOUTS)) + " END"


RAW = {
    "raw_patients_base": f"""
SELECT c_custkey, c_name, {_D} AS d, printf('PAT%06d', c_custkey) AS patient_bk,
       CASE c_custkey % 3 WHEN 0 THEN lower(c_name) WHEN 1 THEN c_name ELSE '  ' || c_name || ' ' END AS full_name,
       {_list(B.GENDER_RAW)}[(c_custkey * 7 + 3) % 10 + 1] AS gender,
       {_list(B.BLOOD_GROUP_RAW)}[(c_custkey * 3 + 1) % 7 + 1] AS blood_group,
       {_PHONE} AS phone,
       CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE {_list(B.CITY_RAW)}[(c_custkey * 11 + 5) % 10 + 1] END AS city,
       {_INS} AS insurance_type
FROM customer""",
    "raw_patients": f"""
SELECT patient_bk, full_name, gender, blood_group, phone, city, insurance_type,
       {layout('c_custkey')} AS dob, c_custkey % 8 AS _lay,
       c_custkey AS _k, d AS _d, FALSE AS _dup
FROM raw_patients_base
UNION ALL
SELECT patient_bk, upper(c_name), gender, blood_group, phone, city, insurance_type,
       CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE {layout('c_custkey + 1')} END, (c_custkey + 1) % 8,
       c_custkey, d, TRUE
FROM raw_patients_base WHERE c_custkey % 20 = 0""",
    "raw_encounters": f"""
SELECT printf('ENC%08d', o_orderkey) AS encounter_bk, o_orderkey AS _k,
       {_list(B.STATUS_RAW)}[o_orderkey % 11 + 1] AS status,
       {_money_text(_BILLED_CENTS)} AS billed_amount_raw,
       {_money_text(f'abs({_BILLED_CENTS}) // 2')} AS amount_paid_raw,
       {_cents_dec(_BILLED_CENTS)} AS BILLED_AMOUNT,
       {_cents_dec(f'abs({_BILLED_CENTS}) // 2')} AS AMOUNT_PAID
FROM orders""",
}

_RAW_WITH = ",\n".join(f"{k} AS ({v})" for k, v in RAW.items())

# Which dedup survivor wins: raw birth-date text ascending, NULLs last,
# then the name text.
_SURVIVORS = """
SELECT patient_bk, full_name, dob FROM (
  SELECT patient_bk, full_name, dob,
         row_number() OVER (PARTITION BY patient_bk ORDER BY dob ASC NULLS LAST, full_name) AS rn
  FROM raw_patients) WHERE rn = 1"""

_FACT_INPUT = "SELECT ENCOUNTER_BK, BILLED_AMOUNT, LENGTH_OF_STAY_DAYS, STATUS FROM encounter_silver"
_PASS_ALL = ("(BILLED_AMOUNT >= 0 OR BILLED_AMOUNT IS NULL) AND (LENGTH_OF_STAY_DAYS >= 0 OR "
             "LENGTH_OF_STAY_DAYS IS NULL) AND (STATUS <> 'Cancelled' OR STATUS IS NULL)")
_LABS_JOINED = """
SELECT e.ENCOUNTER_BK, coalesce(l.NUM_LAB_TESTS, 0) AS NUM_LAB_TESTS,
       coalesce(l.TOTAL_LAB_COST, CAST(0 AS DECIMAL(18,2))) AS TOTAL_LAB_COST
FROM encounter_silver e
LEFT JOIN (SELECT ENCOUNTER_BK, CAST(count(*) AS INTEGER) AS NUM_LAB_TESTS,
                  CAST(sum(TEST_COST) AS DECIMAL(18,2)) AS TOTAL_LAB_COST
           FROM lab_order_silver GROUP BY ENCOUNTER_BK) l ON e.ENCOUNTER_BK = l.ENCOUNTER_BK"""
_ALERTS = """
SELECT l.LAB_ORDER_BK AS ALERT_BK, l.RESULTED_TS
FROM lab_order_silver l JOIN encounter_silver e ON l.ENCOUNTER_BK = e.ENCOUNTER_BK
WHERE l.RESULT_FLAG = 'Abnormal' AND e.STATUS <> 'Cancelled' AND l.RESULTED_TS IS NOT NULL"""

# Rows that dq_every_check breaks, and the ward board before its checks.
_SEVENTH = "CAST(substr({}, 4) AS BIGINT) % 7 = 0"
_IN_BED = """SELECT b.WARD_NO, b.BED_NO FROM encounter_silver e JOIN bed_assignment_silver b ON e.ENCOUNTER_BK = b.ENCOUNTER_BK
WHERE b.IS_ACTIVE AND e.DISCHARGE_TS IS NULL AND e.STATUS <> 'Cancelled'"""

OPERATOR_SQL = {
    "src_range_spine": """
SELECT n, printf('PAT%06d', n) AS PATIENT_BK
FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM customer))) AS n)""",
    "audit_row_counts": """
SELECT 'raw_patients' AS TABLE_NAME, (SELECT count(*) FROM customer) + (SELECT count(*) FROM customer WHERE c_custkey % 20 = 0) AS ROW_COUNT
UNION ALL SELECT 'raw_departments', (SELECT count(*) FROM nation)
UNION ALL SELECT 'raw_providers', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'raw_diagnoses', (SELECT count(*) FROM part)
UNION ALL SELECT 'raw_encounters', (SELECT count(*) FROM orders)
UNION ALL SELECT 'raw_lab_orders', (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'raw_bed_assignments', (SELECT count(*) FROM orders)
UNION ALL SELECT 'raw_patient_coverage', (SELECT count(*) FROM customer)
UNION ALL SELECT 'active_beds', (SELECT count(*) FROM orders WHERE o_orderkey % 13 = 0)""",
    "agg_coverage_by_insurer": """
SELECT HMO_CODE AS hmo_code, count(*) AS patients FROM patient_coverage_silver GROUP BY HMO_CODE ORDER BY HMO_CODE""",
    "interval_arithmetic": """
SELECT printf('ENC%08d', o_orderkey) AS ENCOUNTER_BK, a AS ADMIT_TS,
       a + to_days(CAST(o_orderkey % 17 AS INTEGER)) AS DISCHARGE_TS,
       a + to_hours(1 + o_orderkey % 71) AS FIRST_RESULT_TS
FROM (SELECT o_orderkey, """ + _ADMIT + """ AS a FROM orders)""",
    "gen_pick_hash": f"""
SELECT c_custkey, {_list(B.GENDER_RAW)}[(c_custkey * 7 + 3) % 10 + 1] AS GENDER_RAW,
       {_list(B.BLOOD_GROUP_RAW)}[(c_custkey * 3 + 1) % 7 + 1] AS BLOOD_GROUP_RAW
FROM customer""",
    "gen_null_injection": f"""
SELECT c_custkey, CASE WHEN c_custkey % 50 = 7 THEN NULL
                       ELSE {_list(B.CITY_RAW)}[(c_custkey * 11 + 5) % 10 + 1] END AS CITY_RAW
FROM customer""",
    "gen_stable_bucket": """
SELECT CAST(count(*) AS BIGINT) AS N_KEYS, CAST(count(*) AS BIGINT) AS N_PAIRS, CAST(4 AS BIGINT) AS N_INSURERS,
       CAST(0 AS BIGINT) AS N_MOVED, TRUE AS EVEN FROM customer""",
    "sample_duplicates": """
SELECT count(*) AS N_FEED, TRUE AS SHARE_RIGHT, CAST(0 AS BIGINT) AS N_FOREIGN, CAST(0 AS BIGINT) AS N_UNSTABLE
FROM raw_patients""",
    "gen_modulo_lookup": None,  # filled below (needs the fixed list)
    "dedup_latest": _SURVIVORS,
    "dup_inject_dedup": """
SELECT r.patient_bk, r.full_name, r.dob FROM raw_patients r
WHERE r._dup = (CASE WHEN r._k % 40 = 0 THEN TRUE
                     ELSE (SELECT s.dob FROM raw_patients s WHERE s.patient_bk = r.patient_bk AND NOT s._dup)
                          < (SELECT s.dob FROM raw_patients s WHERE s.patient_bk = r.patient_bk AND s._dup) END)
  AND r._k % 20 = 0""",
    "distinct_on_key": "SELECT DISTINCT patient_bk, insurance_type FROM raw_patients",
    "dob_parse_mixed": """
SELECT patient_bk, dob, CASE WHEN dob IS NULL THEN NULL ELSE _d END AS DATE_OF_BIRTH FROM raw_patients""",
    "dob_parse_dayfirst_compat": """
SELECT patient_bk, dob,
       CASE WHEN dob IS NULL THEN NULL
            WHEN _lay IN (0, 2, 5) AND day(_d) <= 12 THEN make_date(year(_d), day(_d), month(_d))
            ELSE _d END AS DATE_OF_BIRTH
FROM raw_patients""",
    "dob_parse_leftovers": """
SELECT c_custkey, CAST(c_custkey % 10 AS INTEGER) AS KIND,
       CASE WHEN c_custkey % 10 IN (8, 9) THEN NULL
            WHEN c_custkey % 10 = 7 THEN CAST(date_trunc('month', d) AS DATE) ELSE d END AS DATE_OF_BIRTH
FROM (SELECT c_custkey, DATE '1940-01-01' + CAST(c_custkey * 41 % 20000 AS INTEGER) AS d FROM customer)""",
    "money_roundtrip": """
SELECT encounter_bk, billed_amount_raw, amount_paid_raw, BILLED_AMOUNT, AMOUNT_PAID,
       CAST(BILLED_AMOUNT - AMOUNT_PAID AS DECIMAL(19,2)) AS OUTSTANDING_AMOUNT
FROM raw_encounters""",
    "business_keys": """
SELECT e.ENCOUNTER_BK AS encounter_bk, e.PATIENT_BK AS patient_bk, e.PROVIDER_BK AS provider_bk,
       e.DEPARTMENT_BK AS department_bk, e.DIAGNOSIS_BK AS diagnosis_bk,
       e.ENCOUNTER_BK || '-BED01' AS bed_assignment_bk,
       'COV' || substr(e.PATIENT_BK, 4) AS coverage_bk, 'POL-' || substr(e.PATIENT_BK, 4) AS policy_no
FROM encounter_silver e""",
    "explode_sequence_lines": """
SELECT ENCOUNTER_BK, SEQ, ENCOUNTER_BK || printf('-LAB%02d', SEQ) AS LINE_BK
FROM (SELECT printf('ENC%08d', o_orderkey) AS ENCOUNTER_BK,
             CAST(unnest(generate_series(1, o_orderkey % 4 + 1)) AS INTEGER) AS SEQ FROM orders)""",
    "clean_title_case": f"SELECT patient_bk, full_name AS RAW_FULL_NAME, {_initcap('trim(full_name)')} AS FULL_NAME FROM raw_patients",
    "clean_acronym": f"""
SELECT printf('DEP%03d', n_nationkey) AS department_bk,
       {_list(B.WARD_TYPE_RAW)}[n_nationkey % 6 + 1] AS RAW_WARD_TYPE,
       {_list(["Inpatient", "Inpatient", "Outpatient", "Outpatient", "ICU", "ICU"])}[n_nationkey % 6 + 1] AS WARD_TYPE
FROM nation""",
    "clean_gender": """
SELECT patient_bk, gender AS RAW_GENDER,
       CASE WHEN lower(trim(gender)) IN ('m', 'male') THEN 'Male'
            WHEN lower(trim(gender)) IN ('f', 'female') THEN 'Female' ELSE 'Unknown' END AS GENDER
FROM raw_patients""",
    "clean_code": f"""
SELECT printf('ENC%08d', o_orderkey) || '-BED01' AS bed_assignment_bk, w AS RAW_WARD_NO,
       upper(trim(w)) AS WARD_NO, replace(upper(w), ' ', '') AS WARD_NO_SQUEEZED
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 101 = 3 THEN NULL
                  ELSE {_list(B.WARD_PREFIX_RAW)}[o_orderkey % 3 + 1]
                       || printf('%03d', (o_orderkey + o_custkey) % (SELECT count(*) FROM nation)) END AS w
      FROM orders)""",
    "clean_default_unknown": f"""
SELECT patient_bk, city AS RAW_CITY, coalesce({_initcap('trim(city)')}, 'Unknown') AS CITY FROM raw_patients""",
    "classify_payer": """
SELECT patient_bk, insurance_type AS RAW_INSURANCE_TYPE,
       CASE c WHEN 'N' THEN 'NHIS' WHEN 'H' THEN 'HMO' ELSE 'Self-Pay' END AS INSURANCE_TYPE,
       CASE c WHEN 'N' THEN 'NHIS' WHEN 'H' THEN 'HMO' ELSE 'SELF_PAY' END AS PAYER_TYPE,
       CASE c WHEN 'N' THEN 'NHIS' WHEN 'H' THEN 'HMO' ELSE 'SELF-PAY' END AS INSURER_CODE
FROM (SELECT *, CASE WHEN lower(insurance_type) LIKE '%nhis%' THEN 'N'
                     WHEN lower(insurance_type) LIKE '%hmo%' THEN 'H' ELSE 'S' END AS c FROM raw_patients)""",
    "clean_strip_title": f"""
SELECT printf('DOC%04d', s_suppkey) AS provider_bk,
       {_list(B.TITLE_RAW)}[s_suppkey % 4 + 1] || CASE WHEN s_suppkey % 3 = 0 THEN lower(s_name) ELSE s_name END
         AS RAW_PROVIDER_NAME,
       {_initcap('trim(s_name)')} AS PROVIDER_NAME
FROM supplier""",
    "phone_normalize": """
SELECT patient_bk, phone AS RAW_PHONE,
       CASE WHEN c_custkey % 50 = 1 THEN NULL
            ELSE '+234' || NULLIF(ltrim(lpad(CAST((c_custkey * 7919 + 104729) % 1000000000 AS VARCHAR), 9, '0'), '0'), '')
       END AS PHONE
FROM raw_patients r JOIN customer c ON r._k = c.c_custkey""",
    "length_of_stay": "SELECT ENCOUNTER_BK, ADMIT_TS, DISCHARGE_TS, LENGTH_OF_STAY_DAYS FROM encounter_silver",
    "age_years": "SELECT PATIENT_BK, DATE_OF_BIRTH, AGE FROM patient_silver",
    "filter_open_encounters": """
SELECT ENCOUNTER_BK, PATIENT_BK, ADMIT_TS, STATUS FROM encounter_silver
WHERE DISCHARGE_TS IS NULL AND STATUS <> 'Cancelled'""",
    "join_left_dim": """
SELECT e.DEPARTMENT_BK, e.ENCOUNTER_BK, d.DEPARTMENT_NAME, d.WARD_TYPE
FROM encounter_silver e LEFT JOIN department_silver d ON e.DEPARTMENT_BK = d.DEPARTMENT_BK""",
    "join_left_preagg": _LABS_JOINED,
    "incr_aggregate_equals_full": _LABS_JOINED,
    "incr_rowwise_equals_full": "SELECT * FROM encounter_silver",
    "join_inner_on_filter": """
SELECT e.PATIENT_BK, e.ENCOUNTER_BK, c.HMO_CODE, c.POLICY_NO
FROM encounter_silver e JOIN patient_coverage_silver c ON e.PATIENT_BK = c.PATIENT_BK AND c.IS_HMO""",
    "star_join_multi": """
SELECT l.LAB_ORDER_BK, e.PATIENT_BK, p.FULL_NAME, pr.PROVIDER_NAME AS ATTENDING_PROVIDER,
       d.DEPARTMENT_NAME, dx.DIAGNOSIS_DESC
FROM lab_order_silver l JOIN encounter_silver e ON l.ENCOUNTER_BK = e.ENCOUNTER_BK
LEFT JOIN patient_silver p ON e.PATIENT_BK = p.PATIENT_BK
LEFT JOIN provider_silver pr ON e.PROVIDER_BK = pr.PROVIDER_BK
LEFT JOIN department_silver d ON e.DEPARTMENT_BK = d.DEPARTMENT_BK
LEFT JOIN diagnosis_silver dx ON e.DIAGNOSIS_BK = dx.DIAGNOSIS_BK""",
    "agg_labs_per_encounter": """
SELECT ENCOUNTER_BK, CAST(count(*) AS INTEGER) AS NUM_LAB_TESTS, CAST(sum(TEST_COST) AS DECIMAL(18,2)) AS TOTAL_LAB_COST
FROM lab_order_silver GROUP BY ENCOUNTER_BK""",
    "agg_admissions_per_patient": """
SELECT PATIENT_BK, count(*) AS ADMISSION_COUNT FROM encounter_silver GROUP BY PATIENT_BK""",
    "agg_abnormal_per_encounter": """
SELECT ENCOUNTER_BK, count(*) AS NUM_ABNORMAL_LABS FROM lab_order_silver
WHERE RESULT_FLAG = 'Abnormal' GROUP BY ENCOUNTER_BK""",
    "dq_drop": f"SELECT * FROM ({_FACT_INPUT}) WHERE {_PASS_ALL}",
    "dq_null_policy_drop": f"""
SELECT * FROM ({_FACT_INPUT})
WHERE BILLED_AMOUNT >= 0 AND LENGTH_OF_STAY_DAYS >= 0 AND STATUS <> 'Cancelled'""",
    "dq_violation_counts": f"""
SELECT 'non_negative_billed' AS check_name, count(*) FILTER (WHERE BILLED_AMOUNT < 0) AS violations,
       count(*) AS input_rows FROM ({_FACT_INPUT})
UNION ALL SELECT 'non_negative_los', count(*) FILTER (WHERE LENGTH_OF_STAY_DAYS < 0), count(*) FROM ({_FACT_INPUT})
UNION ALL SELECT 'not_cancelled', count(*) FILTER (WHERE STATUS = 'Cancelled'), count(*) FROM ({_FACT_INPUT})""",
    "dq_quarantine": f"""
SELECT ENCOUNTER_BK,
       array_to_string(list_filter([CASE WHEN BILLED_AMOUNT < 0 THEN 'non_negative_billed' END,
                                    CASE WHEN LENGTH_OF_STAY_DAYS < 0 THEN 'non_negative_los' END,
                                    CASE WHEN STATUS = 'Cancelled' THEN 'not_cancelled' END],
                                   lambda x: x IS NOT NULL), ',') AS FAILED_CHECKS
FROM ({_FACT_INPUT}) WHERE NOT ({_PASS_ALL})""",
    "dq_every_check": f"""
SELECT 'silver.patient_silver' AS view_name, 'valid_patient_bk' AS check_name,
       count(*) FILTER (WHERE {_SEVENTH.format('PATIENT_BK')}) AS violations, count(*) AS input_rows FROM patient_silver
UNION ALL SELECT 'silver.lab_order_silver', 'non_negative_cost',
       count(*) FILTER (WHERE (l_partkey * 3 + l_suppkey + l_linenumber) % 97 = 0 AND l_extendedprice > 0), count(*) FROM lineitem
UNION ALL SELECT 'silver.bed_assignment_silver', 'valid_assignment', count(*) FILTER (WHERE o_orderkey % 7 = 0), count(*) FROM orders
UNION ALL SELECT 'silver.patient_coverage_silver', 'valid_coverage', count(*) FILTER (WHERE c_custkey % 7 = 0), count(*) FROM customer
UNION ALL SELECT 'gold.dim_patient', 'valid_patient', count(*) FILTER (WHERE {_SEVENTH.format('PATIENT_BK')}), count(*) FROM patient_silver
UNION ALL SELECT 'gold.fact_encounter', 'non_negative_billed', count(*) FILTER (WHERE BILLED_AMOUNT < 0), count(*) FROM encounter_silver
UNION ALL SELECT 'gold.fact_encounter', 'non_negative_los', count(*) FILTER (WHERE {_SEVENTH.format('ENCOUNTER_BK')}), count(*) FROM encounter_silver
UNION ALL SELECT 'gold.fact_encounter', 'not_cancelled', count(*) FILTER (WHERE STATUS = 'Cancelled'), count(*) FROM encounter_silver
UNION ALL SELECT 'graphql.current_ward_census', 'has_ward', count(*) FILTER (WHERE WARD_NO IS NULL), count(*) FROM ({_IN_BED})
UNION ALL SELECT 'graphql.current_ward_census', 'has_bed', count(*) FILTER (WHERE BED_NO IS NULL), count(*) FROM ({_IN_BED})
UNION ALL SELECT 'graphql.hmo_encounter_summary', 'has_hmo_code', count(*) FILTER (WHERE {_SEVENTH.format('PATIENT_BK')}), count(*)
FROM (SELECT e.PATIENT_BK FROM encounter_silver e JOIN patient_coverage_silver c ON e.PATIENT_BK = c.PATIENT_BK AND c.IS_HMO
      WHERE e.STATUS <> 'Cancelled')
UNION ALL SELECT 'graphql.abnormal_lab_alerts', 'is_resulted', count(*) FILTER (WHERE {_SEVENTH.format('ENCOUNTER_BK')}), count(*)
FROM (SELECT l.ENCOUNTER_BK FROM lab_order_silver l JOIN encounter_silver e ON l.ENCOUNTER_BK = e.ENCOUNTER_BK
      WHERE l.RESULT_FLAG = 'Abnormal' AND e.STATUS <> 'Cancelled')""",
    "feed_since": f"SELECT * FROM ({_ALERTS}) WHERE RESULTED_TS > TIMESTAMP '2000-01-01 00:00:00'",
    "feed_since_composite": f"""
SELECT * FROM ({_ALERTS})
WHERE RESULTED_TS > TIMESTAMP '2000-01-01 05:00:00'
   OR (RESULTED_TS = TIMESTAMP '2000-01-01 05:00:00' AND ALERT_BK > 'ENC00005000')
ORDER BY RESULTED_TS, ALERT_BK LIMIT 500""",
    "feed_since_events": """
SELECT event_id, ts, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-02 00:00:00' OR (ts = TIMESTAMP '2024-01-02 00:00:00' AND event_id > 0)
ORDER BY ts, event_id LIMIT 1000""",
    "feed_append_only_check": f"""
SELECT count(*) FILTER (WHERE RESULTED_TS <= TIMESTAMP '1999-01-01 00:00:00') AS OLD_ROWS,
       count(*) AS NEW_ROWS,
       (SELECT count(*) FROM lab_order_silver l JOIN encounter_silver e ON l.ENCOUNTER_BK = e.ENCOUNTER_BK
        WHERE l.RESULT_FLAG = 'Abnormal' AND l.RESULTED_TS <= TIMESTAMP '1999-01-01 00:00:00'
          AND (e.STATUS = 'Cancelled' OR (e.STATUS <> 'Cancelled' AND substr(l.LAB_ORDER_BK, 12, 6) = '-LAB02'))) AS REMOVED_ROWS
FROM ({_ALERTS})""",
    "tenant_scope": """
SELECT c.HMO_CODE, c.POLICY_NO, e.ENCOUNTER_BK, e.PATIENT_BK, e.ADMIT_DATE, e.STATUS, e.ENCOUNTER_TYPE,
       dx.DIAGNOSIS_DESC, dx.DIAGNOSIS_CATEGORY, e.BILLED_AMOUNT, e.AMOUNT_PAID, e.OUTSTANDING_AMOUNT
FROM encounter_silver e
JOIN patient_coverage_silver c ON e.PATIENT_BK = c.PATIENT_BK AND c.IS_HMO
LEFT JOIN diagnosis_silver dx ON e.DIAGNOSIS_BK = dx.DIAGNOSIS_BK
WHERE e.STATUS <> 'Cancelled' AND c.HMO_CODE = 'HMO-SOUTH'""",
    "partition_pruned_year": """
SELECT e.ENCOUNTER_BK, CAST(strftime(e.ADMIT_DATE, '%Y%m%d') AS INTEGER) AS ADMIT_DATE_SK, e.ADMIT_DATE,
       e.ENCOUNTER_TYPE, e.STATUS, e.LENGTH_OF_STAY_DAYS,
       coalesce(l.NUM_LAB_TESTS, 0) AS NUM_LAB_TESTS,
       coalesce(l.TOTAL_LAB_COST, CAST(0 AS DECIMAL(18,2))) AS TOTAL_LAB_COST,
       e.BILLED_AMOUNT, e.AMOUNT_PAID, e.OUTSTANDING_AMOUNT, e.ADMIT_YEAR
FROM encounter_silver e
LEFT JOIN (SELECT ENCOUNTER_BK, CAST(count(*) AS INTEGER) AS NUM_LAB_TESTS,
                  CAST(sum(TEST_COST) AS DECIMAL(18,2)) AS TOTAL_LAB_COST
           FROM lab_order_silver GROUP BY ENCOUNTER_BK) l ON e.ENCOUNTER_BK = l.ENCOUNTER_BK
WHERE (e.BILLED_AMOUNT >= 0 OR e.BILLED_AMOUNT IS NULL)
  AND (e.LENGTH_OF_STAY_DAYS >= 0 OR e.LENGTH_OF_STAY_DAYS IS NULL)
  AND (e.STATUS <> 'Cancelled' OR e.STATUS IS NULL) AND e.ADMIT_YEAR = 1998""",
    "change_feed_diff": """
SELECT encounter_bk, status, 'insert' AS _change_type FROM raw_encounters WHERE _k % 10 = 1
UNION ALL
SELECT encounter_bk || '-R', status, 'delete' FROM raw_encounters WHERE _k % 10 = 3
UNION ALL
SELECT encounter_bk, 'Admitted', 'update_preimage' FROM raw_encounters WHERE _k % 10 = 2 AND status <> 'Admitted'
UNION ALL
SELECT encounter_bk, status, 'update_postimage' FROM raw_encounters WHERE _k % 10 = 2 AND status <> 'Admitted'""",
    "scalar_string": f"""
SELECT c_custkey, trim('  ' || c_name || ' ') AS TRIMMED, lower(c_name) AS LOWERED, upper(c_name) AS UPPERED,
       {_initcap("lower(c_name || ' of ' || c_mktsegment)")} AS INITCAPPED,
       'C-' || c_name AS CONCATENATED, concat_ws(' ', c_mktsegment, c_name) AS CONCAT_WS,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS LPADDED, substr(c_name, 10, 9) AS SUBSTRINGED,
       format('{{:,.2f}}', CAST(c_acctbal AS DECIMAL(18,2))) AS FORMATTED,
       regexp_replace(c_name, '[^0-9]', '', 'g') AS DIGITS_ONLY
FROM customer""",
    "scalar_datetime": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS D, strftime(o_orderdate, '%d/%m/%Y') AS DATE_TEXT,
       CAST(year(o_orderdate) AS INTEGER) AS YEAR, CAST(quarter(o_orderdate) AS INTEGER) AS QUARTER,
       CAST(month(o_orderdate) AS INTEGER) AS MONTH, CAST(day(o_orderdate) AS INTEGER) AS DAY,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS WEEK_OF_YEAR,
       CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS DAYS_TO_AS_OF,
       CAST(o_orderdate AS DATE) - 30 AS MINUS_30,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ROUNDTRIP,
       CAST(o_orderdate AS DATE) AS REPARSED
FROM orders""",
    "scalar_math": """
SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 7) AS BIGINT) AS FLOOR_QTY,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1.07 AS DECIMAL(3,2)), 2) AS DECIMAL(21,2)) AS ROUND_PRICE,
       abs(l_quantity - 25) AS ABS_DIFF, ((l_orderkey - 1000) % 7 + 7) % 7 AS PMOD,
       -l_quantity AS NEG_QTY, l_linenumber * 3 + 1 AS ARITH
FROM lineitem""",
    "order_position": """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS POSITION FROM orders""",
    "sample_exact": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY substr(md5('11|' || CAST(o_orderkey AS VARCHAR)), 1, 15), o_orderkey LIMIT 250""",
    "scalar_array": """
SELECT o_orderkey, ['low', 'mid', 'high'][o_orderkey % 3 + 1] AS ELEM,
       CAST(o_orderkey % 5 + 1 AS INTEGER) AS SEQ_LAST, CAST(o_orderkey % 5 + 1 AS INTEGER) AS SEQ_SIZE
FROM orders""",
}


def _modulo_lookup() -> str:
    from .operator_queries import LOOKUP_WORDS  # noqa: PLC0415
    return (f"SELECT printf('DX-%04d', p_partkey) AS DIAGNOSIS_BK, "
            f"{_list(LOOKUP_WORDS)}[p_partkey % {len(LOOKUP_WORDS)} + 1] AS LOOKED_UP FROM part")


OPERATOR_SQL["gen_modulo_lookup"] = _modulo_lookup()
OPERATOR_SQL["feed_since_stored"] = OPERATOR_SQL["feed_since_composite"]
# Every operator query may use the raw bronze CTEs as well as the silver ones.
OPERATOR_SQL = {k: _WITH.rstrip("\n") + ",\n" + _RAW_WITH + "\nSELECT * FROM (" + v.strip() + ")"
                for k, v in OPERATOR_SQL.items()}
