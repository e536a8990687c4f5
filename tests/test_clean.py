"""Edge cases of the cleansers, one hand-written row each."""
import datetime as dt

from pyspark.sql import functions as F

from wardline.functions import clean, keys


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_mixed_date_default(spark):
    assert one(spark, clean.mixed_date("x"), "2001-03-04") == dt.date(2001, 3, 4)
    assert one(spark, clean.mixed_date("x"), "04/03/2001") == dt.date(2001, 3, 4)
    assert one(spark, clean.mixed_date("x"), "garbage") is None
    assert one(spark, clean.mixed_date("x"), None) is None


def test_mixed_date_dayfirst_compat(spark):
    f = clean.mixed_date("x", dayfirst_compat=True)
    assert one(spark, f, "2001-03-04") == dt.date(2001, 4, 3)
    assert one(spark, f, "2001-03-25") == dt.date(2001, 3, 25)
    assert one(spark, f, "04/03/2001") == dt.date(2001, 3, 4)


def test_phone(spark):
    assert one(spark, clean.phone("x"), "+234000123456") == "+234123456"
    assert one(spark, clean.phone("x"), "0234801") == "+234234801"
    assert one(spark, clean.phone("x"), "abc") is None
    assert one(spark, clean.phone("x"), None) is None


def test_money(spark):
    assert str(one(spark, clean.money("x"), "₦-5,012.50")) == "-5012.50"
    assert one(spark, clean.money("x"), "") is None


def test_strip_title_and_title_case(spark):
    assert one(spark, clean.strip_title("x"), "Dr. ada obi") == "Ada Obi"
    assert one(spark, clean.strip_title("x"), "DR emeka") == "Emeka"
    assert one(spark, clean.strip_title("x"), "Drake") == "Drake"
    assert one(spark, clean.title_case("x"), "SELF-PAY") == "Self-pay"


def test_code_squeeze(spark):
    assert one(spark, clean.code("x"), " w 003 ") == "W 003"
    assert one(spark, clean.code("x", squeeze=True), " w 003 ") == "W003"


def test_gender_payer_default(spark):
    assert one(spark, clean.gender("x"), " male ") == "Male"
    assert one(spark, clean.gender("x"), None) == "Unknown"
    assert one(spark, clean.payer("x"), "hmo ") == "HMO"
    assert one(spark, clean.payer("x", "SELF_PAY"), "self pay") == "SELF_PAY"
    assert one(spark, clean.or_unknown("x"), None) == "Unknown"
    assert one(spark, clean.acronym_case("x"), "icu") == "ICU"


def test_length_of_stay_calendar_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1)),
                                (dt.datetime(2024, 1, 1, 10, 0), None)], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(clean.length_of_stay("a", "b")).collect()]
    assert got == [1, None]


def test_age_years(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 2),), (dt.date(1990, 1, 1),)], "d date")
    got = [r[0] for r in df.select(clean.age_years("d", dt.date(2002, 1, 1))).collect()]
    assert got == [11, 12]


def test_keys(spark):
    assert one(spark, keys.surrogate_key("x"), None) == 42
    assert one(spark, keys.surrogate_key("x", null_if_null=True), None) is None
    assert one(spark, keys.surrogate_key("x", null_if_null=True), "PAT1") == one(spark, keys.surrogate_key("x"), "PAT1")
    assert one(spark, keys.business_key("PAT", F.col("x"), 6), 5, "x long") == "PAT000005"
    # never truncates
    assert one(spark, keys.business_key("PAT", F.col("x"), 6), 12345678, "x long") == "PAT12345678"
    assert one(spark, keys.date_key("x"), dt.date(2023, 1, 1), "x date") == 20230101


def test_stable_bucket_is_a_function_of_the_key(spark):
    df = spark.range(0, 2000).select(F.format_string("PAT%06d", F.col("id") % 500).alias("k"))
    per_key = df.groupBy("k").agg(F.countDistinct(keys.stable_bucket("k", 4)).alias("n"))
    assert per_key.where("n <> 1").count() == 0
    assert df.select(keys.stable_bucket("k", 4).alias("b")).distinct().count() == 4


def test_md5_bucket_matches_sql_engine(spark):
    import duckdb
    vals = [f"PAT{i:06d}" for i in range(50)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "k string")
           .select(keys.md5_bucket("k", 4)).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT (instr('0123456789abcdef', right(md5(?), 1)) - 1) % 4", [v]).fetchone()[0]
            for v in vals]
    assert got == want


def test_timestamp_parse_is_strict_and_zone_free(spark):
    got = one(spark, clean.ts("x"), "2001-03-04 10:11:12")
    assert got == dt.datetime(2001, 3, 4, 10, 11, 12)
    for bad in ("2001-03-04", "2001-03-04T10:11:12", "2001-13-04 10:11:12", "junk", None):
        assert one(spark, clean.ts("x"), bad) is None, bad
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # a wall-clock time inside a daylight-saving gap survives
        assert one(spark, clean.ts("x"), "2001-04-01 02:30:00") == dt.datetime(2001, 4, 1, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_free_form_dates_are_read_day_first(spark):
    for text in ("2001-3-4", "4 Mar 2001", "04-03-2001", "2001/03/04", "04.03.2001", "March 4, 2001", "4/3/01", "4 March 2001"):
        assert one(spark, clean.mixed_date("x"), text) == dt.date(2001, 3, 4), text
        year_first = text.startswith("2001")
        want = dt.date(2001, 4, 3) if year_first else dt.date(2001, 3, 4)
        assert one(spark, clean.mixed_date("x", dayfirst_compat=True), text) == want, text
    assert one(spark, clean.mixed_date("x", dayfirst_compat=True), "2001-3-25") == dt.date(2001, 3, 25)
    assert [one(spark, clean.unparsed_date("x"), t) for t in ("31/02/2001", "4 Mar 2001", "", None)] == [True, False, False, False]


def test_every_layout_once(spark):
    """One layout per shape, read once; impossible dates and mixed separators are none."""
    want = {"2001-03-04": (2001, 3, 4), "2001/3/4": (2001, 3, 4), "2001.03.04": (2001, 3, 4), "04/03/2001": (2001, 3, 4), "4-3-2001": (2001, 3, 4),
            "04.03.2001": (2001, 3, 4), "4/3/01": (2001, 3, 4), "4-3-01": (2001, 3, 4), "4.3.01": (2001, 3, 4), "4 MAR 2001": (2001, 3, 4),
            "14 may 2001": (2001, 5, 14), "September 14, 2001": (2001, 9, 14), "Sep 14 2001": (2001, 9, 14), " 29/02/2004 ": (2004, 2, 29),
            "29/02/2001": None, "2001-13-01": None, "04/03-2001": None, "4 Sept 2001": None, "4 Foo 2001": None, "2001": None, "32/01/2001": None}
    df = spark.createDataFrame([(t,) for t in want], "x string").select("x", clean.mixed_date("x").alias("d"))
    assert {r["x"]: r["d"] and tuple(r["d"].timetuple()[:3]) for r in df.collect()} == want
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("gettimestamp") + text.count("to_date") + text.count("try_to_timestamp") <= 2 and "PythonUDF" not in text


def test_leftover_dates_go_through_arrow(spark):
    want = {"3rd March 2001": (2001, 3, 3), "1st of May, 1999": (1999, 5, 1), "Sunday 4 March 2001": (2001, 3, 4), "Sun, 4 Mar 2001": (2001, 3, 4),
            "2001-03-04 10:30:00": (2001, 3, 4), "04/03/2001 10:30": (2001, 3, 4), "2001-03-04T23:59:59": (2001, 3, 4), "March 2001": (2001, 3, 1),
            "4 Sept 2001": None, "04/03/2001": (2001, 3, 4), "4 March": None, "2001": None, "10:30": None, "not known": None, "": None}
    df = spark.createDataFrame([(t,) for t in want] + [(None,)], "x string")
    got = {r["x"]: r["d"] and tuple(r["d"].timetuple()[:3]) for r in df.select("x", clean.any_date("x").alias("d")).collect()}
    assert got == {**want, None: None}
    compat = {r["x"]: r["d"] for r in df.select("x", clean.any_date("x", dayfirst_compat=True).alias("d")).collect()}
    assert compat["2001-03-04 10:30:00"] == dt.date(2001, 4, 3) and compat["04/03/2001 10:30"] == dt.date(2001, 3, 4)


def test_money_text_at_all_sizes(spark):
    from wardline.functions import gen
    for cents in (0, 5, -5, 99, 100, 99_999, 100_000, -123_450, 99_999_999, 100_000_000, 99_999_999_999, 100_000_000_000, -1_234_567_890_123):
        text = f"₦{'-' if cents < 0 else ''}{abs(cents) // 100:,}.{abs(cents) % 100:02d}"
        assert one(spark, gen.money_text("x"), cents, "x long") == text
    assert one(spark, gen.money_text("x"), None, "x long") is None


def test_md5_bucket_fills_any_number_of_buckets(spark):
    df = spark.range(16_000).select(keys.md5_bucket(F.col("id"), 64).alias("b"), keys.md5_bucket(F.col("id"), 6).alias("c"))
    assert df.select("b").distinct().count() == 64
    sizes = [r["count"] for r in df.groupBy("c").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1.1 * 16_000 / 6


def test_surrogate_keys_are_pinned(spark):
    """Values from the xxhash library: XXH64 with seed 42."""
    import xxhash
    for key in ("PAT000001", "ENC00000042", ""):
        want = xxhash.xxh64_intdigest(key, seed=42)
        assert one(spark, keys.surrogate_key("x"), key) == want - (1 << 64 if want >> 63 else 0)
    assert one(spark, keys.surrogate_key("x"), "PAT000001") == -5524248755977903872
