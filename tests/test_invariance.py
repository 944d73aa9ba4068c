"""Results do not depend on input partitioning or row order."""

from pyspark.sql import functions as F

from warnindex.operators import quality
from warnindex.operators.index import calculate_indicators
from warnindex.operators.durations import calculate_durations
from warnindex.params import DurationParams, IndexParams
from warnindex.plans.flows import orders_region_messages
from warnindex.sources.adapters import quality_messages

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, 0 if x is None else x) for x in r])


def test_index_invariant(spark):
    base = orders_region_messages(spark, SF)
    p, ip = DurationParams(gap_scope="year"), IndexParams(baseline_year=1995)
    ref = rows(calculate_indicators(calculate_durations(base, p), ip))
    for shuffled in (base.repartition(1), base.repartition(11).orderBy(F.rand(7))):
        assert rows(calculate_indicators(calculate_durations(shuffled, p), ip)) == ref


def test_quality_invariant(spark):
    base = quality_messages(spark, SF)
    ref = rows(quality.validate(base, by_year=True))
    assert rows(quality.validate(base.repartition(9).orderBy(F.rand(3)), by_year=True)) == ref
    assert rows(quality.report(base.repartition(1))) == rows(quality.report(base))
