"""The governance checks: tables have rows, columns have values."""

import pytest

from conftest import SF_SMALL, rows
from govlake.operators import quality as Q
from govlake.plans import REGISTRY


def test_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "x int, y string, z string")
    prof = {r["column"]: r for r in Q.column_profile(df, exact=True).collect()}
    assert (prof["x"]["rows"], prof["x"]["non_null"], prof["x"]["distinct"]) == (2, 2, 2)
    assert prof["y"]["non_null"] == 0 and prof["z"]["distinct"] == 1
    assert rows(Q.empty_columns(df)) == [("y",)]
    assert Q.not_empty(df) and not Q.not_empty(df.limit(0))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_registered_query_not_empty(spark, name):
    assert Q.not_empty(REGISTRY[name].fn(spark, SF_SMALL))


def test_checkpoint_dir_prefers_the_configured_folder(spark):
    from govlake.session import ensure_checkpoint_dir
    # the session's folder (set once, as a cluster would) wins over any fallback
    assert ensure_checkpoint_dir(spark, "/elsewhere") == spark.sparkContext.getCheckpointDir()


def test_checkpoint_fallback_refused_on_a_cluster():
    import pytest
    from govlake.session import ensure_checkpoint_dir

    class Conf:
        def __init__(self, d): self.d = d
        def get(self, k, default=None): return self.d.get(k, default)

    class SC:
        def __init__(self, master, conf): self.master, self._conf, self.dir = master, Conf(conf), None
        def getCheckpointDir(self): return self.dir
        def getConf(self): return self._conf
        def setCheckpointDir(self, d): self.dir = d

    class Session:
        def __init__(self, master, conf=None): self.sparkContext, self.conf = SC(master, conf or {}), Conf({})

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session("yarn"), "/tmp/local-folder")
    shared = Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(shared, "/tmp/local-folder") == "hdfs:///shared/ckpt"
    assert ensure_checkpoint_dir(Session("local[4]"), "/tmp/local-folder") == "/tmp/local-folder"
