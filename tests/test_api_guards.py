"""Small API contracts: guards, missing inputs, checkpoint folder."""

import pytest

from rekko.operators import encoding
from rekko.operators import model as gbt
from rekko.operators.recommend import recommend
from rekko.session import checkpoint_dir, cut_lineage
from rekko.sources import artifacts


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in checkpoint_dir(spark)
    df = cut_lineage(spark.range(5))
    assert df.count() == 5


def test_missing_model_and_artifacts(spark, tmp_path):
    assert gbt.load(str(tmp_path / "no-model")) is None
    assert artifacts.load(spark, str(tmp_path), "item_topk") is None
    with pytest.raises(ValueError):
        artifacts.load(spark, str(tmp_path), "not_an_artifact")
    with pytest.raises(ValueError):
        artifacts.save(spark, str(tmp_path), {"bogus": spark.range(1)})


def test_guards(spark):
    with pytest.raises(ValueError):
        encoding.apply(spark.range(1), encoding.Levels(()), mode="other")
    with pytest.raises(ValueError):
        recommend(spark.range(1), spark.range(1), spark.range(1), None,
                  spark.range(1), spark.range(1), k=0)
