from cyclemart.session import ensure_checkpoint_dir, materialize, scratch_path


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and ensure_checkpoint_dir(spark) == configured  # never replaced
    assert scratch_path(spark, "x").startswith(configured.rstrip("/") + "/cyclemart/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")  # a fresh folder per call


def test_materialize_is_a_reliable_checkpoint(spark):
    df = materialize(spark.range(10))
    plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert df.count() == 10
    assert "Scan ExistingRDD" in plan and "Range" not in plan  # lineage cut at the checkpoint


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)
