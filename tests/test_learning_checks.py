"""What the registered learning queries train on."""

import pytest

from checks import learning as checks
from dayscout.operators import learning as ml

FOLDER = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["cross_validate_r2", "feature_importances", "compare_models", "order_model_comparison"])
def test_fits_see_all_history(spark, monkeypatch, name):
    calls = []

    def record(rows, *types, **options):
        calls.append((rows, types, options))
        raise Seen

    monkeypatch.setattr(ml, "train_regression", record)
    monkeypatch.setattr(ml, "compare_models", record)
    with pytest.raises(Seen):
        getattr(checks, name)(spark, FOLDER)
    ((rows, types, options),) = calls
    assert rows.count() == checks._usable(spark, FOLDER).count() > checks._window(spark, FOLDER).count()
    # the default models, and every fold where a figure of the folds is in the result
    assert not types and options.get("partitions") is None
    assert "folds" not in options or name == "feature_importances"
