from pathlib import Path

import pytest

from broadsheet.llm import common


def test_a_machine_s_own_folder_only_under_a_local_master():
    for master in ("local", "local[*]", "local[4]", "local[4,2]"):
        folder = Path(common.own_folder(master))
        assert folder.is_dir()
        folder.rmdir()
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.own_folder(master)


def test_steps_are_stored_in_the_folder_the_session_names(spark):
    root = spark.conf.get(common.CHECKPOINT_DIR)
    assert root.split(":")[-1] in common.shared_folder(spark)
    assert common.cut(spark.range(3)).count() == 3
