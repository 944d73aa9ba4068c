"""P7, P8, J1, P18-P22, J5, A13, A14."""

import pytest

from warnindex.operators import regions
from warnindex.params import COASTAL_KEYWORDS

AREAS = "fwdCode string, county string, riverOrSea string, isTidal boolean"


def test_join_cases(spark):
    areas = spark.createDataFrame([("F1", "Bristol", "River", False), ("C1", "Bristol", "Sea", True)], AREAS)
    msgs = spark.createDataFrame([("F1", 1, True), ("C1", 2, None), ("ZZ", 3, True)], "fwdCode string, id int, isTidal boolean")
    got = {r.id: r.isTidal for r in regions.restrict_to_region(msgs, areas).collect()}
    assert got == {1: False, 2: True}   # unknown code dropped, old class replaced (P8)
    left = {r.id: r.isTidal for r in regions.join_class(msgs, areas).collect()}
    assert left == {1: False, 2: True, 3: None}
    assert sorted(r.id for r in regions.region_filter(msgs, areas).collect()) == [1, 2]


def test_empty_region_is_an_error(spark):
    with pytest.raises(regions.EmptyRegionError):
        regions.check_region(spark.createDataFrame([], AREAS))


def test_class_from_text_and_items(spark):
    items = spark.createDataFrame(
        [("N1", "Severn Estuary", "North Somerset"), ("N2", "Seaton Brook", "Bristol"), ("N3", None, "Bath"),
         ("N4", "River Frome", "City of Bristol, South Gloucestershire")],
        "notation string, riverOrSea string, county string")
    a = {r.fwdCode: r for r in regions.areas_from_items(items).collect()}
    assert a["N1"].isTidal and a["N2"].isTidal      # N21: "sea" inside "Seaton"
    assert a["N3"].isTidal is False and a["N3"].riverOrSea == ""
    assert a["N4"].isTidal is False
    assert "sea" in COASTAL_KEYWORDS


def test_county_filter_and_tallies(spark):
    counties = ["Bristol", "Bath and North East Somerset", "South Gloucestershire", "North Somerset"]
    areas = spark.createDataFrame(
        [("A", "City of Bristol", "x", False), ("B", "City of Bristol, South Gloucestershire", "x", True),
         ("C", "Somerset", "x", True), ("D", None, "x", False)], AREAS)
    kept = sorted(r.fwdCode for r in regions.county_filter(areas, counties).collect())
    assert kept == ["A", "B"]
    tallies = {r.county: r.area_count for r in regions.county_tallies(areas, counties).collect()}
    assert tallies == {"Bristol": 2, "Bath and North East Somerset": 0, "South Gloucestershire": 1, "North Somerset": 0}
    c = regions.area_class_counts(areas).collect()[0]
    assert (c.total_areas, c.fluvial_areas, c.coastal_areas) == (4, 2, 2)
    assert regions.flood_areas(areas, None).count() == 4
    assert regions.flood_areas(areas, "South Gloucestershire").count() == 1


def test_restrict_requires_areas(spark):
    msgs = spark.createDataFrame([("F1", 1)], "fwdCode string, id int")
    empty = spark.createDataFrame([], AREAS)
    with pytest.raises(regions.EmptyRegionError):
        regions.restrict_to_region(msgs, empty, require_areas=True)
    assert regions.restrict_to_region(msgs, empty).count() == 0
