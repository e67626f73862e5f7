
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from casefile.functions import text as tx
from casefile.operators import staging


def one_col(spark, values, name="x", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


DATES_OK = ["2001-10-08", "2001-10-08 12:00:00", "2001-10-08T12:00:00", "2001/10/08", "2001-1-8",
            " 2001-10-08 ", "2001 10 08"]
DATES_NULL = ["2001", "2001-10", "Mon, 8 Oct 2001", "2001-02-30", "2001-10-08x", "2001/10-08",
              "20011008", "2001-10-08 abc", "2001-10-08 25:00:00", "10/08/2001", None]


def test_safe_date_accepts_and_rejects(spark):
    df = one_col(spark, DATES_OK + DATES_NULL).select("x", tx.safe_date("x").alias("d"))
    got = {r.x: r.d for r in df.collect()}
    for v in DATES_OK:
        assert isinstance(got[v], dt.date), v
    assert got["2001-1-8"] == dt.date(2001, 1, 8)
    for v in DATES_NULL:
        assert got[v] is None, v


def test_safe_date_matches_reference_engine_cast(spark):
    con = duckdb.connect()
    for v in DATES_OK + DATES_NULL:
        want = con.execute("SELECT TRY_CAST(? AS DATE)", [v]).fetchone()[0]
        got = one_col(spark, [v]).select(tx.safe_date("x").alias("d")).first().d
        assert got == want, v


def test_recipient_split(spark):
    raw = spark.createDataFrame([(1, "a@x, ,b@y,,junk, a@x"), (2, None), (3, "")],
                                "id long, recipients string")
    rows = staging.explode_recipients(raw).orderBy("email_id", "addr").collect()
    assert [(r.email_id, r.addr) for r in rows] == [(1, "a@x"), (1, "a@x"), (1, "b@y")]


def test_unicode_trim(spark):
    df = one_col(spark, [" a@x ", "\ta@x"]).select(tx.unicode_trim("x").alias("t"))
    assert [r.t for r in df.collect()] == ["a@x", "\ta@x"]


def test_word_boundary_is_ascii(spark):
    df = one_col(spark, ["éljm ljm_x ljm-2 ljmé"])
    pat = tx.whole_word_pattern(["ljm"])
    r = df.select(F.regexp_extract_all("x", F.lit(pat), 1).alias("all"),
                  tx.lexicon_hits("x", ["ljm"]).alias("distinct")).first()
    assert len(r.all) == 3 and r.distinct == ["ljm"]


def test_excerpt_keeps_vertical_tab(spark):
    df = one_col(spark, ["a\x0bb", "a \t\n b"]).select(tx.message_excerpt("x").alias("e"))
    assert [r.e for r in df.collect()] == ["a\x0bb", "a b"]


def test_domain(spark):
    df = one_col(spark, ["a@b@c", "A@X.COM"]).select(tx.address_domain("x").alias("d"))
    assert [r.d for r in df.collect()] == ["b", "x.com"]


def test_perimeter(spark):
    df = one_col(spark, ["a@corp", "A@CORP", "a@sub.corp", "a@corp.evil"], name="addr")
    got = [r.addr for r in staging.external_recipients(df, "@corp").collect()]
    assert got == ["a@sub.corp", "a@corp.evil"]


def test_week_bucket(spark):
    df = spark.createDataFrame([(dt.date(2001, 10, 8),), (dt.date(2001, 10, 14),), (dt.date(2000, 1, 1),)],
                               "d date").select(tx.week_bucket("d").alias("w"))
    assert [r.w for r in df.collect()] == [dt.date(2001, 10, 8), dt.date(2001, 10, 8), dt.date(1999, 12, 27)]


@pytest.mark.parametrize("name,want", [
    ("comm_spikes", "analytics.comm_spikes"),
    ("analytics.comm_spikes", "analytics.comm_spikes"),
    ("`weird-name`", "analytics.weird_name"),
    ("other.foo", "analytics.foo"),
    ("", None),
])
def test_name_normaliser(spark, name, want):
    assert one_col(spark, [name]).select(tx.safe_evidence_table("x").alias("t")).first().t == want


@pytest.mark.parametrize("sql,want,wrapped", [
    ("SELECT 1", "SELECT 1", False),
    ("WITH a AS (SELECT 1) SELECT * FROM a", "WITH a AS (SELECT 1) SELECT * FROM a", False),
    ("CREATE OR REPLACE TABLE analytics.x AS SELECT a FROM t", "SELECT a FROM t", True),
    ("create view v as\n select 2;", "select 2", True),
    ("SELECT 3;", "SELECT 3", False),
])
def test_wrapper_strip(spark, sql, want, wrapped):
    r = one_col(spark, [sql]).select(tx.strip_create_wrapper("x").alias("s"),
                                     tx.is_create_wrapped("x").alias("w")).first()
    assert (r.s, r.w) == (want, wrapped)
