import pytest
from pyspark.sql import functions as F

from strata import files, session


def test_staging_removes_what_it_staged(spark):
    df = spark.range(10)
    with session.staging(spark):
        inside = session.stage(df, "inside")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 10 and files.exists(spark, path)
    assert not files.exists(spark, path)
    outside = session.stage(df, "outside")
    assert outside.count() == 10


def test_staging_cleans_up_after_an_error(spark):
    with pytest.raises(RuntimeError), session.staging(spark):
        path = session.stage(spark.range(3), "x").inputFiles()[0].rsplit("/", 1)[0]
        raise RuntimeError
    assert not files.exists(spark, path)


def test_scratch_is_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "a").startswith(named)
