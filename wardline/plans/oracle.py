"""Independent SQL oracle (DuckDB dialect) for the registered queries.

The oracle does not re-run our cleansers: for every silver column it computes
the *clean* value straight from the input tables (the bronze dirt is a known
function of the keys, so the clean value is too). The Spark side dirties the
data and cleans it again; both must meet. Gold and serving queries are the
view definitions written in plain SQL over these clean relations.

Surrogate keys (``xxhash64``) have no DuckDB counterpart; queries that
compare with the oracle leave them out, and ``sk_referential`` checks them
by joining through them.
"""

from __future__ import annotations

AS_OF = "2002-01-01"


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def _cents_dec(cents: str, p: int = 18) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01 AS DECIMAL({p},2))"


def _list(vals) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in vals) + "]"


# Clean values that the bronze dirt domains map to (same order as the raw lists).
_GENDER = _list(["Male", "Female", "Male", "Female", "Male", "Female", "Male", "Female", "Unknown", "Unknown"])
_BLOOD = _list(["A+", "A+", "O-", "O+", "B+", "AB-", "AB+"])
_CITY = _list(["Lagos", "Lagos", "Abuja", "Kano", "Ibadan", "Port Harcourt", "Port Harcourt", "Kaduna",
               "Benin", "Benin"])
_WARD_TYPE = _list(["Inpatient", "Inpatient", "Outpatient", "Outpatient", "ICU", "ICU"])
_BUILDING = _list(["Tower 1", "Tower 2", "Pavilion", "Tower 1"])
_SPECIALTY = _list(["Toxicology", "Audiology", "Virology", "Rheumatology", "Pathology"])
_ETYPE = _list(["Inpatient", "Inpatient", "Outpatient", "Outpatient", "Emergency", "Emergency"])
_STATUS = _list(["Discharged"] * 6 + ["Admitted", "Admitted", "Admitted", "Cancelled", "Admitted"])
_TEST = _list(["Ferritin", "Sodium", "Potassium", "Creatinine", "Bilirubin", "Troponin", "Cortisol", "Insulin"])
_HMO = _list(["HMO-NORTH", "HMO-SOUTH", "HMO-EAST", "HMO-WEST"])

_ADMIT = ("o_orderdate + to_seconds(((o_orderkey * 7) % 24) * 3600 + ((o_orderkey * 13) % 60) * 60 "
          "+ (o_orderkey * 17) % 60)")
_BILLED_CENTS = ("CASE WHEN o_orderkey % 67 = 0 THEN -CAST(round(o_totalprice * 100) AS BIGINT) "
                 "ELSE CAST(round(o_totalprice * 100) AS BIGINT) END")
_LAB_CENTS = ("CASE WHEN (l_partkey * 3 + l_suppkey + l_linenumber) % 97 = 0 "
              "THEN -CAST(round(l_extendedprice * 100) AS BIGINT) "
              "ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END")
_LAB_BK = ("printf('ENC%08d', l_orderkey) || printf('-LAB%02d-', l_linenumber) || md5(concat_ws('|', "
           "l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity * 100) AS BIGINT), "
           "CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), "
           "CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y%m%d')))")

SILVER = {
    "patient_silver": f"""
SELECT printf('PAT%06d', c_custkey) AS PATIENT_BK,
       {_initcap('trim(c_name)')} AS FULL_NAME,
       {_GENDER}[(c_custkey * 7 + 3) % 10 + 1] AS GENDER,
       {_BLOOD}[(c_custkey * 3 + 1) % 7 + 1] AS BLOOD_GROUP,
       CASE WHEN c_custkey % 50 = 1 THEN NULL
            ELSE '+234' || NULLIF(ltrim(lpad(CAST((c_custkey * 7919 + 104729) % 1000000000 AS VARCHAR), 9, '0'), '0'), '')
       END AS PHONE,
       CASE WHEN c_custkey % 50 = 7 THEN 'Unknown' ELSE {_CITY}[(c_custkey * 11 + 5) % 10 + 1] END AS CITY,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'HMO' WHEN 'MACHINERY' THEN 'HMO'
                         WHEN 'AUTOMOBILE' THEN 'NHIS' ELSE 'Self-Pay' END AS INSURANCE_TYPE,
       DATE '1930-01-01' + CAST((c_custkey * 37) % 25567 AS INTEGER) AS DATE_OF_BIRTH,
       CAST(date_sub('year', DATE '1930-01-01' + CAST((c_custkey * 37) % 25567 AS INTEGER),
                     DATE '{AS_OF}') AS INTEGER) AS AGE
FROM customer""",
    "department_silver": f"""
SELECT printf('DEP%03d', n_nationkey) AS DEPARTMENT_BK,
       {_initcap('trim(n_name)')} AS DEPARTMENT_NAME,
       {_WARD_TYPE}[n_nationkey % 6 + 1] AS WARD_TYPE,
       {_BUILDING}[(n_nationkey + n_regionkey) % 4 + 1] AS BUILDING
FROM nation""",
    "provider_silver": f"""
SELECT printf('DOC%04d', s_suppkey) AS PROVIDER_BK,
       {_initcap('trim(s_name)')} AS PROVIDER_NAME,
       {_SPECIALTY}[(s_suppkey + s_nationkey) % 5 + 1] AS SPECIALTY,
       printf('DEP%03d', s_nationkey) AS DEPARTMENT_BK
FROM supplier""",
    "diagnosis_silver": f"""
SELECT printf('DX-%04d', p_partkey) AS DIAGNOSIS_BK,
       trim(p_name) AS DIAGNOSIS_DESC,
       {_initcap('trim(p_type)')} AS DIAGNOSIS_CATEGORY
FROM part""",
    "lab_order_silver": f"""
SELECT {_LAB_BK} AS LAB_ORDER_BK,
       printf('ENC%08d', l_orderkey) AS ENCOUNTER_BK,
       {_TEST}[l_partkey % 8 + 1] AS TEST_NAME,
       {_cents_dec(_LAB_CENTS)} AS TEST_COST,
       CASE l_returnflag WHEN 'A' THEN 'Abnormal' WHEN 'N' THEN 'Normal' ELSE 'Unknown' END AS RESULT_FLAG,
       CASE WHEN l_returnflag IN ('A', 'N')
            THEN l_shipdate + to_seconds(((l_partkey * 7 + l_linenumber) % 24) * 3600 + ((l_suppkey * 11) % 60) * 60)
       END AS RESULTED_TS
FROM lineitem
WHERE (l_partkey * 3 + l_suppkey + l_linenumber) % 97 <> 0""",
    "encounter_silver": f"""
SELECT ENCOUNTER_BK, PATIENT_BK, PROVIDER_BK, DEPARTMENT_BK, DIAGNOSIS_BK, ADMIT_TS, DISCHARGE_TS,
       CAST(ADMIT_TS AS DATE) AS ADMIT_DATE,
       CAST(datediff('day', CAST(ADMIT_TS AS DATE), CAST(DISCHARGE_TS AS DATE)) AS INTEGER) AS LENGTH_OF_STAY_DAYS,
       ENCOUNTER_TYPE, STATUS, BILLED_AMOUNT, AMOUNT_PAID,
       CAST(BILLED_AMOUNT - AMOUNT_PAID AS DECIMAL(19,2)) AS OUTSTANDING_AMOUNT,
       CAST(year(ADMIT_TS) AS INTEGER) AS ADMIT_YEAR
FROM (
  SELECT printf('ENC%08d', o_orderkey) AS ENCOUNTER_BK,
         CASE WHEN o_orderkey % 199 = 17 THEN NULL ELSE printf('PAT%06d', o_custkey) END AS PATIENT_BK,
         printf('DOC%04d', (o_orderkey * 7 + o_custkey) % (SELECT count(*) FROM supplier)) AS PROVIDER_BK,
         printf('DEP%03d', (o_orderkey + o_custkey) % (SELECT count(*) FROM nation)) AS DEPARTMENT_BK,
         printf('DX-%04d', (o_orderkey + o_custkey * 7) % (SELECT count(*) FROM part)) AS DIAGNOSIS_BK,
         {_ADMIT} AS ADMIT_TS,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE {_ADMIT} + to_days(CAST(o_orderkey % 17 AS INTEGER)) + to_hours((o_orderkey * 5) % 12) END AS DISCHARGE_TS,
         {_ETYPE}[(o_orderkey * 5) % 6 + 1] AS ENCOUNTER_TYPE,
         {_STATUS}[o_orderkey % 11 + 1] AS STATUS,
         {_cents_dec(_BILLED_CENTS)} AS BILLED_AMOUNT,
         {_cents_dec(f'abs({_BILLED_CENTS}) // 2')} AS AMOUNT_PAID
  FROM orders)""",
    "bed_assignment_silver": f"""
SELECT printf('ENC%08d', o_orderkey) || '-BED01' AS BED_ASSIGNMENT_BK,
       printf('ENC%08d', o_orderkey) AS ENCOUNTER_BK,
       CASE WHEN o_orderkey % 101 = 3 THEN NULL
            ELSE ['W', 'W', 'W '][o_orderkey % 3 + 1] || printf('%03d', (o_orderkey + o_custkey) % (SELECT count(*) FROM nation))
       END AS WARD_NO,
       CASE WHEN o_orderkey % 103 = 5 THEN NULL ELSE 'B' || printf('%02d', (o_orderkey * 3) % 40 + 1) END AS BED_NO,
       {_ADMIT} AS ASSIGNED_TS,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE {_ADMIT} + to_days(CAST(o_orderkey % 17 AS INTEGER)) + to_hours((o_orderkey * 5) % 12) END AS RELEASED_TS,
       o_orderkey % 13 = 0 AS IS_ACTIVE
FROM orders""",
    "patient_coverage_silver": f"""
SELECT 'COV' || printf('%06d', c_custkey) AS COVERAGE_BK,
       printf('PAT%06d', c_custkey) AS PATIENT_BK,
       PAYER AS PAYER_TYPE,
       CASE PAYER WHEN 'HMO' THEN {_HMO}[(instr('0123456789abcdef', right(md5(printf('PAT%06d', c_custkey)), 1)) - 1) % 4 + 1]
                  WHEN 'NHIS' THEN 'NHIS' ELSE 'SELF-PAY' END AS HMO_CODE,
       'POL-' || printf('%06d', c_custkey) AS POLICY_NO,
       DATE '2015-01-01' + CAST((c_custkey * 13) % 1200 AS INTEGER) AS VALID_FROM,
       PAYER = 'HMO' AS IS_HMO
FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'HMO' WHEN 'MACHINERY' THEN 'HMO'
                                  WHEN 'AUTOMOBILE' THEN 'NHIS' ELSE 'SELF_PAY' END AS PAYER
      FROM customer)""",
}

_WITH = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in SILVER.items()) + "\n"


def with_silver(body: str) -> str:
    """Prefix ``body`` with the eight clean silver relations as CTEs."""
    return _WITH + body


_CHECKED_FACT = """
fact AS (
  SELECT e.ENCOUNTER_BK, e.PATIENT_BK, e.PROVIDER_BK, e.DEPARTMENT_BK, e.DIAGNOSIS_BK,
         CAST(strftime(e.ADMIT_DATE, '%Y%m%d') AS INTEGER) AS ADMIT_DATE_SK, e.ADMIT_DATE,
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
    AND (e.STATUS <> 'Cancelled' OR e.STATUS IS NULL))
"""

VIEW_SQL = {
    "silver_patient": "SELECT * FROM patient_silver",
    "silver_department": "SELECT * FROM department_silver",
    "silver_provider": "SELECT * FROM provider_silver",
    "silver_diagnosis": "SELECT * FROM diagnosis_silver",
    "silver_lab_order": "SELECT * FROM lab_order_silver",
    "silver_encounter": "SELECT * FROM encounter_silver",
    "silver_bed_assignment": "SELECT * FROM bed_assignment_silver",
    "silver_patient_coverage": "SELECT * FROM patient_coverage_silver",
    "dim_patient": "SELECT * FROM patient_silver",
    "dim_provider": """
SELECT p.PROVIDER_BK, p.PROVIDER_NAME, p.SPECIALTY, p.DEPARTMENT_BK, d.DEPARTMENT_NAME, d.WARD_TYPE
FROM provider_silver p LEFT JOIN department_silver d ON p.DEPARTMENT_BK = d.DEPARTMENT_BK""",
    "dim_department": "SELECT * FROM department_silver",
    "dim_diagnosis": "SELECT * FROM diagnosis_silver",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DATE_SK, d AS DATE_VALUE,
       CAST(year(d) AS INTEGER) AS YEAR, CAST(quarter(d) AS INTEGER) AS QUARTER,
       CAST(month(d) AS INTEGER) AS MONTH, monthname(d) AS MONTH_NAME,
       CAST(day(d) AS INTEGER) AS DAY_OF_MONTH, dayname(d) AS DAY_NAME,
       CAST(weekofyear(d) AS INTEGER) AS WEEK_OF_YEAR, dayname(d) IN ('Saturday', 'Sunday') AS IS_WEEKEND
FROM (SELECT CAST(unnest(generate_series(
        CAST(date_trunc('year', least(min(ADMIT_DATE), min(CAST(DISCHARGE_TS AS DATE)))) AS DATE),
        CAST(date_trunc('year', greatest(max(ADMIT_DATE), max(CAST(DISCHARGE_TS AS DATE)))) AS DATE)
          + INTERVAL 1 YEAR - INTERVAL 1 DAY,
        INTERVAL 1 DAY)) AS DATE) AS d
      FROM encounter_silver)""",
    "fact_encounter": ", " + _CHECKED_FACT.strip() + """
SELECT ENCOUNTER_BK, ADMIT_DATE_SK, ADMIT_DATE, ENCOUNTER_TYPE, STATUS, LENGTH_OF_STAY_DAYS,
       NUM_LAB_TESTS, TOTAL_LAB_COST, BILLED_AMOUNT, AMOUNT_PAID, OUTSTANDING_AMOUNT, ADMIT_YEAR
FROM fact""",
    "ward_census": f"""
SELECT e.ENCOUNTER_BK, e.PATIENT_BK, p.FULL_NAME, p.GENDER, p.AGE, b.WARD_NO, b.BED_NO,
       d.DEPARTMENT_NAME, pr.PROVIDER_NAME AS ATTENDING_PROVIDER, dx.DIAGNOSIS_DESC, dx.DIAGNOSIS_CATEGORY,
       e.ENCOUNTER_TYPE, e.ADMIT_TS, e.ADMIT_DATE,
       CAST(datediff('day', e.ADMIT_DATE, DATE '{AS_OF}') AS INTEGER) AS CURRENT_LOS_DAYS,
       coalesce(ac.ADMISSION_COUNT, 1) AS ADMISSION_COUNT,
       coalesce(ac.ADMISSION_COUNT, 1) >= 3 AS IS_RECURRING,
       coalesce(al.NUM_ABNORMAL_LABS, 0) AS NUM_ABNORMAL_LABS,
       coalesce(ac.ADMISSION_COUNT, 1) >= 3 OR coalesce(al.NUM_ABNORMAL_LABS, 0) > 0 AS NEEDS_ATTENTION
FROM (SELECT * FROM encounter_silver WHERE DISCHARGE_TS IS NULL AND STATUS <> 'Cancelled') e
JOIN (SELECT ENCOUNTER_BK, WARD_NO, BED_NO FROM bed_assignment_silver WHERE IS_ACTIVE) b
  ON e.ENCOUNTER_BK = b.ENCOUNTER_BK
LEFT JOIN patient_silver p ON e.PATIENT_BK = p.PATIENT_BK
LEFT JOIN provider_silver pr ON e.PROVIDER_BK = pr.PROVIDER_BK
LEFT JOIN department_silver d ON e.DEPARTMENT_BK = d.DEPARTMENT_BK
LEFT JOIN diagnosis_silver dx ON e.DIAGNOSIS_BK = dx.DIAGNOSIS_BK
LEFT JOIN (SELECT PATIENT_BK, count(*) AS ADMISSION_COUNT FROM encounter_silver GROUP BY PATIENT_BK) ac
  ON e.PATIENT_BK = ac.PATIENT_BK
LEFT JOIN (SELECT ENCOUNTER_BK, count(*) AS NUM_ABNORMAL_LABS FROM lab_order_silver
           WHERE RESULT_FLAG = 'Abnormal' GROUP BY ENCOUNTER_BK) al ON e.ENCOUNTER_BK = al.ENCOUNTER_BK
WHERE b.WARD_NO IS NOT NULL AND b.BED_NO IS NOT NULL""",
    "hmo_summary": """
SELECT c.HMO_CODE, c.POLICY_NO, e.ENCOUNTER_BK, e.PATIENT_BK, e.ADMIT_DATE, e.STATUS, e.ENCOUNTER_TYPE,
       dx.DIAGNOSIS_DESC, dx.DIAGNOSIS_CATEGORY, e.BILLED_AMOUNT, e.AMOUNT_PAID, e.OUTSTANDING_AMOUNT
FROM encounter_silver e
JOIN patient_coverage_silver c ON e.PATIENT_BK = c.PATIENT_BK AND c.IS_HMO
LEFT JOIN diagnosis_silver dx ON e.DIAGNOSIS_BK = dx.DIAGNOSIS_BK
WHERE e.STATUS <> 'Cancelled' AND c.HMO_CODE IS NOT NULL""",
    "lab_alerts": """
SELECT l.LAB_ORDER_BK AS ALERT_BK, l.RESULTED_TS, l.LAB_ORDER_BK, l.ENCOUNTER_BK, e.PATIENT_BK,
       l.TEST_NAME, l.RESULT_FLAG, e.PROVIDER_BK, pr.PROVIDER_NAME AS ATTENDING_PROVIDER,
       d.DEPARTMENT_NAME, dx.DIAGNOSIS_DESC, e.ADMIT_DATE
FROM lab_order_silver l
JOIN encounter_silver e ON l.ENCOUNTER_BK = e.ENCOUNTER_BK
LEFT JOIN provider_silver pr ON e.PROVIDER_BK = pr.PROVIDER_BK
LEFT JOIN department_silver d ON e.DEPARTMENT_BK = d.DEPARTMENT_BK
LEFT JOIN diagnosis_silver dx ON e.DIAGNOSIS_BK = dx.DIAGNOSIS_BK
WHERE l.RESULT_FLAG = 'Abnormal' AND e.STATUS <> 'Cancelled' AND l.RESULTED_TS IS NOT NULL""",
    # Fact rows reached through the surrogate keys must carry the business
    # keys they were hashed from.
    "sk_referential": ", " + _CHECKED_FACT.strip() + """
SELECT ENCOUNTER_BK, PATIENT_BK, PROVIDER_BK, DEPARTMENT_BK, DIAGNOSIS_BK, ADMIT_DATE AS DATE_VALUE
FROM fact""",
}


def _compose(body: str) -> str:
    if body.startswith(", "):  # body adds its own CTEs after the silver ones
        head, _, select = body[2:].partition("\nSELECT")
        return _WITH.rstrip("\n") + ",\n" + head + "\nSELECT" + select
    return with_silver(body)


def oracle_queries() -> dict[str, str]:
    from .operator_oracle import OPERATOR_SQL  # noqa: PLC0415
    out = {k: _compose(v) for k, v in VIEW_SQL.items()}
    out.update(OPERATOR_SQL)
    return out
