import pytest

from corpusmill.operators import reports

TIE = [12.19, 94.91, 23.26, 35.44]  # their mean is 41.45; summed as doubles in this order it is 41.449999999999996


def test_means_do_not_depend_on_the_order(spark):
    rows = [(n, t, v) for n, values in enumerate((TIE, TIE[::-1], sorted(TIE))) for t, v in enumerate(values)]
    samples = spark.createDataFrame(rows, "run_id long, ts long, value double")
    assert {r["mean"] for parts in (1, 4) for r in reports.sample_report(samples.repartition(parts, "ts").sortWithinPartitions("run_id", "ts")).collect()} == {41.5}


@pytest.mark.parametrize("values,want", [
    ([None, 5.0, 7.0, None], (7.0, 6.0, 2.0)),
    ([None], (None, None, None)),
    ([1e300, 1e300], (1e300, 1e300, 0.0)),
    ([float("inf"), 1.0], (float("inf"), float("inf"), float("-inf"))),
    ([-0.25, -0.25], (-0.25, -0.3, 0.0)),
])
def test_samples_that_are_odd(spark, values, want):
    samples = spark.createDataFrame([(1, t, v) for t, v in enumerate(values)], "run_id long, ts long, value double")
    assert tuple(reports.sample_report(samples).first())[1:] == want
