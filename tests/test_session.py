from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationflow.session import CHECKPOINT_DIR, clear_scratch, materialise, scratch_path, scratch_root


def fake_session(master, configured=None):
    """A session as far as ``scratch_root`` looks at it."""
    folder = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getConf=lambda: SimpleNamespace(get=lambda _: configured),
        getCheckpointDir=lambda: folder["dir"],
        setCheckpointDir=lambda path: folder.update(dir=path),
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get(CHECKPOINT_DIR)
    assert scratch_root(fake_session("yarn", "hdfs://name/shared/")) == "hdfs://name/shared"


def test_no_session_makes_a_folder_of_its_own():
    for master in ("local[2]", "local-cluster[1,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
            scratch_root(fake_session(master))


def test_materialise_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.when(F.col("id") > 5, "x").alias("x"))
    stored = materialise(df, "t")
    assert rows(stored) == rows(df) and stored.dtypes == df.dtypes


def test_stored_tables_can_be_removed():
    """Of one application only; run in a session's own folder."""
    calls = []
    path = SimpleNamespace(getFileSystem=lambda _: SimpleNamespace(delete=lambda p, deep: calls.append((p, deep)) or True))
    hadoop = SimpleNamespace(Path=lambda name: calls.append(name) or path)
    session = fake_session("yarn", "hdfs://name/shared")
    session.sparkContext.applicationId = "app-1"
    session.sparkContext._jvm = SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=SimpleNamespace(fs=hadoop))))
    session.sparkContext._jsc = SimpleNamespace(hadoopConfiguration=lambda: None)
    assert clear_scratch(session)
    assert calls == ["hdfs://name/shared/stationflow-app-1", (path, True)]
    assert scratch_path(session, "t").startswith("hdfs://name/shared/stationflow-app-1/t-")
