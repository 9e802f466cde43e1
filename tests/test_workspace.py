"""Scratch folders end with the work that owns them."""

import os


from millrace.sources.workspace import materialize, new_path, scratch, shared_dir


def test_scratch_is_deleted_also_after_a_failure(spark):
    for fails in (False, True):
        try:
            with scratch(spark) as folder:
                df = materialize(spark.range(3), "part")
                assert df.count() == 3 and folder in new_path(spark, "x")
                assert os.listdir(folder.removeprefix("file:"))
                if fails:
                    raise KeyError("stop")
        except KeyError:
            assert fails
        assert not os.path.exists(folder.removeprefix("file:"))
    assert "/run-" not in new_path(spark, "x").removeprefix(shared_dir(spark))


def test_a_migration_leaves_no_scratch(spark, tmp_path):
    from test_migration import HEADER, ROWS

    from millrace.plans.migration import Migration

    (tmp_path / "f.csv").write_text("\n".join([HEADER, *ROWS]))
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    job = Migration(spark, str(tmp_path / "f.csv"), str(tmp_path / "out"))
    job.run()
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
    assert all(t.count() >= 0 for t in job.validate().values())
