"""Shared-storage materialisation."""

from scholarspark.session import ensure_checkpoint_dir, reliable_checkpoint


def test_materialised_tables_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    df = reliable_checkpoint(spark.range(10).toDF("x"), "t")
    assert df.count() == 10
    files = df.inputFiles()
    def norm(u):
        return u.replace("file:", "").lstrip("/")
    assert files and all(norm(f).startswith(norm(base)) for f in files)


def test_a_cluster_needs_a_shared_folder():
    from scholarspark.session import local_fallback_allowed
    assert local_fallback_allowed("local[4]") and not local_fallback_allowed("spark://host:7077")
    assert not local_fallback_allowed("local-cluster[2,1,1024]") and not local_fallback_allowed("yarn")
