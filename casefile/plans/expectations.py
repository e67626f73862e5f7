"""Checked-in gate expectations, one set per TESTDATA scale.

Values were derived once from the TESTDATA tables and are fixed here; the
gate (`casefile.operators.gate.value_gate`) re-derives them on every run and
fails any check that drifts.  Set-valued checks are fingerprints
`n=<distinct count>;h=<sum of the first 60 md5 bits>`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

EXPECTATIONS: dict[str, dict[str, str]] = {
    "sf0.001": {
        "exhibits.distinct_messages": "10",
        "exhibits.edges": "19",
        "exhibits.recipients": "n=4;h=2814760938723068633",
        "exhibits.senders": "n=10;h=5794274788341391832",
        "surge.flagged_weeks": "3",
        "surge.peak_volume": "7",
        "surge.peak_week": "2000-05-15",
        "surge.peak_zscore": "3.15",
        "terms.domain[nation_1.example]": "false",
        "terms.domain[nation_2.example]": "false",
        "terms.domain[nation_3.example]": "true",
        "terms.external_addresses": "8",
        "terms.predisclosure_emails": "54",
        "terms.top_domain": "nation_19.example",
        "web.candidates": "n=4;h=1882178377031270502",
        "owners.datasets": "n=147;h=91386015723368430416",
        "owners.flagged_datasets": "147",
        "owners.owners": "n=4;h=2784629863998241778",
        "lineage.datasets": "n=21;h=13500566665180086180",
        "lineage.flagged_datasets": "21",
    },
    "sf0.01": {
        "exhibits.distinct_messages": "155",
        "exhibits.edges": "280",
        "exhibits.recipients": "n=58;h=35830661982410861154",
        "exhibits.senders": "n=137;h=73335124570207677020",
        "surge.flagged_weeks": "6",
        "surge.peak_volume": "50",
        "surge.peak_week": "2000-02-21",
        "surge.peak_zscore": "2.83",
        "terms.domain[nation_1.example]": "true",
        "terms.domain[nation_2.example]": "true",
        "terms.domain[nation_3.example]": "true",
        "terms.external_addresses": "87",
        "terms.predisclosure_emails": "267",
        "terms.top_domain": "nation_9.example",
        "web.candidates": "n=8;h=3777436406623176166",
        "owners.datasets": "n=1355;h=762464610860332346858",
        "owners.flagged_datasets": "1361",
        "owners.owners": "n=31;h=17923456780397349606",
        "lineage.datasets": "n=153;h=84662061036159052377",
        "lineage.flagged_datasets": "153",
    },
    "sf0.1": {
        "exhibits.distinct_messages": "184",
        "exhibits.edges": "316",
        "exhibits.recipients": "n=247;h=148476359522721930350",
        "exhibits.senders": "n=182;h=111995889665451519842",
        "surge.flagged_weeks": "1",
        "surge.peak_volume": "316",
        "surge.peak_week": "2001-02-26",
        "surge.peak_zscore": "2.26",
        "terms.domain[nation_1.example]": "true",
        "terms.domain[nation_2.example]": "true",
        "terms.domain[nation_3.example]": "true",
        "terms.external_addresses": "793",
        "terms.predisclosure_emails": "2799",
        "terms.top_domain": "nation_23.example",
        "web.candidates": "n=11;h=5279333894200036392",
        "owners.datasets": "n=13735;h=7900132922984241452827",
        "owners.flagged_datasets": "13794",
        "owners.owners": "n=262;h=154188973197247023046",
        "lineage.datasets": "n=1610;h=927766072165981012752",
        "lineage.flagged_datasets": "1610",
    },
}

SHADOW_LISTS: dict[str, tuple[str, ...]] = {
    "sf0.001": ('and', 'that', 'this', 'with'),
    "sf0.01": ('and', 'that', 'with', 'this', 'elle', 'pour', 'para', 'con'),
    "sf0.1": ('and', 'that', 'with', 'this', 'elle', 'pour', 'con', 'para', 'der', 'und', 'die'),
}


#: Rows of `orders` at each scale: what tells the scales apart, whatever a folder is called.
ORDERS = {1_500: "sf0.001", 15_000: "sf0.01", 150_000: "sf0.1"}


def scale_of(spark: SparkSession, sf_dir: str) -> str | None:
    """The scale whose values are checked in for this folder's tables; a data
    set of another size has none, and its checks say "no expectation"."""
    return ORDERS.get(spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").count())


def expectations_for(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return EXPECTATIONS.get(scale_of(spark, sf_dir), {})


def shadow_list_for(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    return SHADOW_LISTS.get(scale_of(spark, sf_dir), ())
