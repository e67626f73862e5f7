"""Every registered query against its DuckDB oracle on the smallest TESTDATA
scale (the same compare the driver runs at sf0.01), plus reconciliation
properties of the investigations."""

import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from casefile.plans.oracles import ORACLES
from casefile.plans.registry import QUERIES
from check_oracles import SPARK_TO_DUCK, TABLES, canon


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_them(spark):
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_expectations_follow_the_tables_not_the_folder(spark, sf_small, tmp_path):
    """A copy under another name passes the same gate; other tables have no expectations."""
    from casefile.plans.expectations import EXPECTATIONS, expectations_for
    shutil.copytree(sf_small, tmp_path / "moved")
    assert expectations_for(spark, f"{tmp_path}/moved/") == EXPECTATIONS["sf0.001"]
    rows = QUERIES["value_gate"](spark, f"{tmp_path}/moved").collect()
    assert len(rows) == 20 and all(r["ok"] for r in rows)
    other = tmp_path / "other"
    other.mkdir()
    spark.range(7).write.parquet(f"{other}/orders.parquet")
    assert expectations_for(spark, str(other)) == {}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["week", "vol", "zscore", "days_to_event", "flagged"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, key):
    from casefile.plans.oracles import scale_oracles
    sql = scale_oracles(sf_small.rstrip("/").rsplit("/", 1)[-1]).get(key, ORACLES[key])
    df = QUERIES[key](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(sql)
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(type(f.dataType).__name__) == dtypes[f.name], f.name
    assert len(srows) == len(drows)
    assert canon(df.columns, srows) == canon(dcols, drows)


def test_exhibits_reconcile_to_weekly_volume(spark, sf_small):
    spikes = QUERIES["hunt_comm_spikes"](spark, sf_small).filter("flagged")
    ex = QUERIES["hunt_exhibits"](spark, sf_small)
    per_week = ex.groupBy(F.trunc("sent_at", "week").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    joined = spikes.join(per_week, "week", "left").collect()
    assert joined and all(r.n == r.vol for r in joined)


def test_pair_array_equals_self_join(spark, sf_small):
    a = QUERIES["co_mention_edges"](spark, sf_small)
    b = QUERIES["co_mention_self_join"](spark, sf_small)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch(spark, sf_small):
    from casefile.plans.registry import review_log
    from casefile.sources.reference import TESTDATA as P
    from casefile.streaming.alerts import review_alerts
    streamed = QUERIES["review_alerts_stream"](spark, sf_small)
    batch = review_alerts(review_log(spark, sf_small), P.review_tags).select(
        "event_id", F.col("at").cast("timestamp_ntz").alias("at"), "entityUrn", "category", "operation",
        "modifier")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_slice_recompute_equals_full(spark, sf_small):
    r = QUERIES["recompute_check"](spark, sf_small).first()
    assert r.matches_full is True
