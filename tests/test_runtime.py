import os

import pytest

from lodestone import runtime


def test_intermediate_tables_go_with_their_context(spark):
    with runtime.intermediates():
        kept = runtime.materialize(spark.range(5), "test")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


class Session:
    """A session on a cluster without a shared folder."""

    def __init__(self, master):
        self.sparkContext, self.conf, self.master = self, self, master

    def get(self, key, default=None):
        return None

    def getConf(self):
        return self


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1000]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError):
        runtime.shared_dir(Session(master))
