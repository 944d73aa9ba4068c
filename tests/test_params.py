import math

import pytest

from warnindex.params import (
    PUBLISHED_BASELINE,
    DurationParams,
    IndexParams,
)


def test_default_rule_values():
    p = DurationParams()
    assert p.default_seconds == {1: 12 * 3600, 2: 24 * 3600, 3: 48 * 3600, 4: 0}
    assert p.fallback_seconds == 24 * 3600
    assert p.max_gap_seconds == 72 * 3600
    assert p.int_weights == {1: 3, 2: 2, 3: 1, 4: 0}


def test_weights_must_sum_to_one():
    IndexParams(0.6, 0.4)
    with pytest.raises(ValueError):
        IndexParams(0.6, 0.5)


def test_weights_are_exact_and_scope_checked():
    from decimal import Decimal

    p = DurationParams(weights={1: 1.5, 2: 1})
    assert p.weight_type == "DECIMAL(9,4)" and p.exact_weights == {1: Decimal("1.5"), 2: Decimal(1), None: Decimal(0)}
    assert DurationParams(weights={1: 2.0}).exact_weights == {1: 2, None: 0}
    for bad in (0.12345, 1e6, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            DurationParams(weights={1: bad})
    with pytest.raises(ValueError):
        DurationParams(gap_scope="month")
    with pytest.raises(ValueError):
        DurationParams(default_hours={1: 1.0000001})


def test_suggested_partitioning():
    from warnindex.session import MiB, suggested_conf

    c = suggested_conf(10 * (1 << 40), 8000)          # 10 TiB widest shuffle, 8000 cores
    assert c["spark.sql.shuffle.partitions"] == str(10 * (1 << 40) // (128 * MiB))
    assert suggested_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_published_baseline_consistent():
    b = PUBLISHED_BASELINE
    assert b.year == 2020
    assert math.isclose(b.total_score, b.fluvial_score + b.coastal_score)
    assert (b.fluvial_events, b.coastal_events) == (23, 72)


def test_published_composites_follow_weights():
    # Published components (fluvial, coastal) and composite, 2020-2025.
    rows = [(100.0, 100.0, 100.0), (44.6, 33.5, 39.6), (31.9, 26.1, 29.3),
            (150.6, 40.8, 101.2), (253.2, 61.7, 167.0), (105.0, 26.4, 69.6)]
    for f, c, comp in rows:
        assert abs(0.55 * f + 0.45 * c - comp) <= 0.06
