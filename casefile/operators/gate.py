"""Value gate.

Checks are rows (check, got) with `got` rendered as text; expectations are a
checked-in table (check, want).  A full outer join makes a missing check a
failure instead of a silent drop.  List-valued checks are compared as sets
without collecting them: `got` is a fingerprint `n=<distinct count>;h=<sum of
60 md5 bits>` computed by one aggregation, and `set_compare` lists the
differences with anti-joins when the members themselves are needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.operators.comms import cross_group_edges, group_lookup, hunt_comm_spikes
from casefile.operators.lexicon import shadow_candidates


def set_fingerprint(col: str) -> Column:
    """`n=<distinct>;h=<sum of the first 60 md5 bits>` of a column's values."""
    text = F.col(col).cast("string")
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.concat(F.lit("n="), F.count_distinct(text).cast("string"), F.lit(";h="),
                    F.coalesce(F.sum_distinct(bits), F.lit(0)).cast("string"))


def _checked(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """(check, got) rows of several aggregates over one scan of `df`."""
    names = list(values)
    row = df.agg(*[values[n].cast("string").alias(f"v{i}") for i, n in enumerate(names)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"v{i}").alias("got"))
                                         for i, n in enumerate(names)])))


def gate_checks(spikes: DataFrame, exhibits: DataFrame, leakage: DataFrame, web: DataFrame,
                orphaned: DataFrame, provenance: DataFrame, *, threshold: int,
                must_include_domains: Sequence[str]) -> DataFrame:
    """Re-derive the headline values of the six evidence sets (20 checks), one
    aggregate per set; only the top domain needs a grouping of its own."""
    flagged = spikes.filter(F.col("flagged"))
    earliest = -F.datediff("week", F.lit("1970-01-01"))
    peak = F.max_by(F.struct("week", "vol", "zscore"), F.struct(F.col("zscore"), earliest))
    before = F.col("days_before_disclosure") > 0
    top_dom = (leakage.groupBy("external_domain").agg(F.countDistinct("email_id").alias("n"))
                      .orderBy(F.desc("n"), "external_domain").limit(1))
    parts = [
        _checked(flagged, {"surge.flagged_weeks": F.count(F.lit(1)),
                           "surge.peak_week": F.date_format(peak["week"], "yyyy-MM-dd"),
                           "surge.peak_volume": peak["vol"], "surge.peak_zscore": peak["zscore"]}),
        _checked(exhibits, {"exhibits.edges": F.count(F.lit(1)), "exhibits.distinct_messages": F.countDistinct("msg_id"),
                            "exhibits.senders": set_fingerprint("sender"),
                            "exhibits.recipients": set_fingerprint("recipient")}),
        _checked(leakage, {"terms.predisclosure_emails": F.count_distinct(F.when(before, F.col("email_id"))),
                           "terms.external_addresses": F.count_distinct(F.when(before, F.col("external_recipient"))),
                           **{f"terms.domain[{d}]": F.count_if(F.col("external_domain") == d) > 0
                              for d in must_include_domains}}),
        _checked(top_dom, {"terms.top_domain": F.max("external_domain")}),
        _checked(shadow_candidates(web, threshold), {"web.candidates": set_fingerprint("candidate")}),
        _checked(orphaned.filter(F.col("flagged")), {"owners.flagged_datasets": F.count(F.lit(1)),
                                                     "owners.datasets": set_fingerprint("dataset"),
                                                     "owners.owners": set_fingerprint("owner")}),
        _checked(provenance.filter(F.col("flagged")), {"lineage.flagged_datasets": F.count(F.lit(1)),
                                                       "lineage.datasets": set_fingerprint("dataset")}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def expectations_table(spark: SparkSession, want: Mapping[str, str]) -> DataFrame:
    """A gate's expectations (check, want); `value_gate` takes any such table."""
    return spark.createDataFrame(sorted(want.items()), "check string, want string")


def value_gate(checks: DataFrame, expectations: DataFrame) -> DataFrame:
    """(check, got, want, ok, detail); a check missing on either side fails."""
    j = checks.join(expectations, "check", "full_outer")
    ok = F.coalesce(F.col("got") == F.col("want"), F.lit(False))
    detail = (F.when(ok, F.lit(""))
               .when(F.col("got").isNull(), F.lit("missing evidence"))
               .when(F.col("want").isNull(), F.lit("no expectation"))
               .otherwise(F.concat(F.lit("got "), F.col("got"), F.lit(" want "), F.col("want"))))
    return j.select("check", "got", "want", ok.alias("ok"), detail.alias("detail"))


def gate_assertions(results: DataFrame) -> DataFrame:
    """Roll checks up per evidence group (name prefix); deterministic id."""
    grp = F.split_part(F.col("check"), F.lit("."), F.lit(1))
    item = F.concat(F.col("check"), F.lit("="), F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("FAIL")))
    return (results.groupBy(grp.alias("group"))
                   .agg(F.bool_and("ok").alias("passed"), F.count_if(F.col("ok")).alias("n_ok"),
                        F.count(F.lit(1)).alias("n_all"),
                        F.array_join(F.array_sort(F.collect_list(item)), "; ").alias("results"))
                   .withColumn("assertion_id", F.concat(F.lit("gate-"), F.col("group"))))


def set_compare(got: DataFrame, want: DataFrame, col: str = "value") -> DataFrame:
    """(value, in_got, in_want) over the union of both sets."""
    g = got.select(F.col(col).alias("value")).distinct().withColumn("in_got", F.lit(True))
    w = want.select(F.col(col).alias("value")).distinct().withColumn("in_want", F.lit(True))
    return (g.join(w, "value", "full_outer")
             .select("value", F.coalesce("in_got", F.lit(False)).alias("in_got"),
                     F.coalesce("in_want", F.lit(False)).alias("in_want")))


def extract_slice(edges: DataFrame, registry: DataFrame, group_a: Sequence[str],
                  group_b: Sequence[str], root: str) -> dict[str, DataFrame]:
    """The minimal reproducible slice — only the cross-group edges and the
    group members of the registry — written under `root` and read back."""
    spark = edges.sparkSession
    x = cross_group_edges(edges, registry, group_a, group_b)
    members = registry.join(group_lookup(registry, group_a, group_b).select("addr"), "addr", "left_semi")
    out = {}
    for name, df in (("comm_edges", x), ("registry", members)):
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def recompute_check(slice_tables: Mapping[str, DataFrame], events: DataFrame, full_spikes: DataFrame,
                    **params) -> DataFrame:
    """Recompute hunt 1 from the slice; report the peak and whether the
    whole recomputed series equals the full run (anti-joins both ways)."""
    rec = hunt_comm_spikes(slice_tables["comm_edges"], slice_tables["registry"], events, **params)
    cols = ["week", "vol", "zscore", "days_to_event", "flagged"]
    diff = (rec.select(*cols).exceptAll(full_spikes.select(*cols))
               .unionByName(full_spikes.select(*cols).exceptAll(rec.select(*cols))))
    flagged = rec.filter(F.col("flagged"))
    peak = (flagged.orderBy(F.desc("zscore"), "week").limit(1)
                   .select(F.col("week").alias("peak_week"), F.col("vol").alias("peak_volume"),
                           F.col("zscore").alias("peak_zscore")))
    head = flagged.agg(F.count(F.lit(1)).alias("flagged_weeks"))
    same = diff.agg((F.count(F.lit(1)) == 0).alias("matches_full"))
    return head.crossJoin(same).join(peak, how="left")
