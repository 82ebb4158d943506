"""The checkpoint folder must be shared wherever executors have disks of their own."""

from types import SimpleNamespace

import pytest

from encore.session import ensure_checkpoint_dir


def test_no_private_checkpoint_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))
