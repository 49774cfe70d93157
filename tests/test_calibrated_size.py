"""The calibrated query generates as many streams as the events table has."""

import os

import pytest

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_one_stream_for_each_of_the_table(spark):
    from eventweir.plans.registry import QUERIES
    from eventweir.sources import tables as S

    want = S.events(spark, SF).select("stream_id").distinct().count()
    assert want != 50 and QUERIES["simulate_calibrated"](spark, SF).select("stream_id").distinct().count() == want
