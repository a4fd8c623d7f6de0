from pathlib import Path
from types import SimpleNamespace

import pytest

from docloom.storage import clear, materialize, shared_dir


def test_results_are_kept_until_cleared(spark):
    clear(spark)
    df = spark.range(5).selectExpr("id", "cast(null as string) as note")
    kept, other = materialize(df, "numbers"), materialize(df, "others")
    assert kept.columns == df.columns and kept.count() == 5
    folder = Path(shared_dir(spark).removeprefix("file:")) / "docloom"
    (folder / "numbers-of-another-process").mkdir()
    assert clear(spark, "numbers") == 1 and other.count() == 5
    assert clear(spark) == 1 and clear(spark) == 0
    assert [x.name for x in folder.iterdir()] == ["numbers-of-another-process"]
    (folder / "numbers-of-another-process").rmdir()


def test_no_folder_of_one_machine_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))
