import pytest

from nephos import session


class FakeConf:
    def get(self, key, default=None):
        return default


class FakeSpark:
    conf = FakeConf()

    class sparkContext:
        master = "spark://cluster:7077"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSpark())


def test_shared_tables_come_and_go(spark):
    df = session.write_shared(spark.range(5), "numbers")
    assert df.count() == 5
    session.drop_shared(df)
    with pytest.raises(Exception):
        df.count()
    empty = session.write_shared(spark.range(0), "none")
    assert empty.count() == 0
    session.clear_shared(spark)


def test_small_batches_unless_the_session_sets_its_own(spark):
    session.ship_package(spark)
    assert spark.conf.get(session.BATCH_LIMIT) is not None
