"""The shared scratch folder: scopes, and its removal."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from velolake.session import _read_folders, scratch_scope, stored


def folder(df):
    return next(iter(_read_folders(df)))


def there(spark, df):
    name = folder(df)
    return any(name in paths for _, paths, _ in os.walk(spark.conf.get("spark.checkpoint.dir")))


def test_scope_deletes_what_is_not_kept(spark):
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as keep:
            first, second = stored(spark.range(10), "first"), stored(spark.range(5), "second")
            result = keep(first.join(second, "id").filter("id > 1"))
            third = stored(spark.range(3), "third")
        assert there(spark, first) and there(spark, second) and not there(spark, third)
        assert result.count() == 3
        outer(second)
    assert not there(spark, first) and there(spark, second)
    assert second.count() == 5


def test_scope_deletes_nothing_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        table = stored(spark.range(4), "table")
        raise ZeroDivisionError
    assert table.count() == 4


def test_tables_outside_of_scopes_stay(spark):
    table = stored(spark.range(4), "table")
    with scratch_scope(spark):
        pass
    assert table.count() == 4


def test_shuffles_of_a_stored_table_are_not_needed_again(spark):
    table = stored(spark.range(100).repartition(5).groupBy("id").count(), "counted")
    assert table.count() == table.distinct().count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_folder_goes_after_the_session_was_stopped(tmp_path):
    code = (f"from velolake.session import build_session, stored\ns = build_session('x', 'local[1]', spark__checkpoint__dir='{tmp_path}')\n"
            f"stored(s.range(3), 'x')\nimport glob; print('there', len(glob.glob('{tmp_path}/velolake-*/x-*')))\ns.stop()")
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "there 1" in done.stdout
    assert not list(tmp_path.glob("velolake-*"))
