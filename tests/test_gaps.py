"""Facades whose first layer lacks a release that they and their second layer have."""

import datetime

import pytest

from .test_plans import LINE, both


@pytest.fixture(scope="module")
def gap(spark, tmp_path_factory):
    """A facade of two releases over two layers, of which the first has the earlier release alone; another facade over two layers without its later release, or any."""
    at = str(tmp_path_factory.mktemp("gap"))
    have = {5: (1, 2), 6: (1,), 7: (1, 2), 10: (1, 2), 12: (1,)}
    rows = [(1, part, k, 2, 1.0, "N", "O", datetime.datetime(1997, quarter * 3 - 1, 10)) for k, quarters in have.items() for quarter in quarters for part in (1, 2, 3, 7, 8, 13)]
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(k,) for k in (5, 6, 7, 10, 11, 12)], "s_suppkey long").coalesce(1).write.parquet(f"{at}/supplier.parquet")
    return at


def renamed(rows):
    return {(r["facade_id"], r["vers"]) for r in rows if ":renamed::" in r["key"]}


def test_surface_has_what_the_line_of_an_absent_layer_selects(spark, gap):
    assert renamed(both(spark, gap, "facade_surface")) == {("prov-5", "6.1.0"), ("prov-5", "6.2.0"), ("prov-10", "6.1.0")}


def test_summary_counts_what_the_line_of_an_absent_layer_selects(spark, gap):
    got = {(r["facade_id"], r["vers"]): r["added"] > 0 and r["api_hash"] is not None for r in both(spark, gap, "facade_summary")}
    assert got == {("prov-5", "6.1.0"): True, ("prov-5", "6.2.0"): True, ("prov-10", "6.1.0"): True, ("prov-10", "6.2.0"): False}


def test_dataset_has_the_hash_with_the_line_of_an_absent_layer(spark, gap):
    assert {(r["provider_id"], r["vers"]) for r in both(spark, gap, "composed_dataset") if r["items_added"]} == {("prov-5", "6.1.0"), ("prov-5", "6.2.0"), ("prov-10", "6.1.0")}


def test_provenance_still_names_the_absent_layer(spark, gap):
    got = {(r["provider_id"], r["vers"]): (r["sources"], r["unresolved"]) for r in both(spark, gap, "composed_provenance")}
    assert got["prov-5", "6.2.0"] == ("pkg-6@6.2.0=missing,pkg-7@6.2.0=filtered", "pkg-6@6.2.0 (not measured)") and set(got) == {("prov-5", "6.1.0"), ("prov-5", "6.2.0"), ("prov-10", "6.1.0")}
