import os
from urllib.parse import urlparse

from subjectloom.session import noting, release, remove, written


def test_written_tables_can_be_removed(spark):
    with noting() as paths:
        one, two = written(spark.range(3), "one"), written(spark.range(4), "two")
        assert (one.count(), two.count()) == (3, 4)
    there = lambda: [os.path.isdir(urlparse(p).path) for p in paths]
    assert there() == [True, True]
    release(one)
    assert there() == [False, True]
    remove(spark, paths)
    assert there() == [False, False]
