from datetime import datetime

import pytest

from dockflow.operators import registry
from tests.data import rows


def models(spark, *names):
    data = [(n, {"a": "1"}, {"mae": 0.5}) for n in names]
    return spark.createDataFrame(data, "model_name string, params map<string,string>, metrics map<string,double>")


def test_life_of_a_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.create_registry(spark, path)
    registry.create_registry(spark, path)

    def log():
        return registry.open_registry(spark, path)

    assert registry.latest_versions(log()).count() == 0
    registry.register_versions(path, models(spark, "m", "n"), datetime(2022, 1, 1))
    registry.register_versions(path, models(spark, "m"), datetime(2022, 1, 2))
    registry.register_versions(path, models(spark, "m"), datetime(2022, 1, 3))
    assert rows(log().groupBy("model_name").max("version")) == [("m", 3), ("n", 1)]
    assert rows(registry.next_versions(log(), models(spark, "m", "new")), "model_name", "version") == [("m", 4), ("new", 1)]

    def move(version, stage, day):
        chosen = log().where(f"model_name = 'm' and version = {version} and event = 'register'")
        registry.transition_stage(path, chosen, stage, datetime(2022, 1, day))

    # Two versions staged, none in production; then one moves twice.
    move(1, "Staging", 4)
    move(2, "Staging", 5)
    assert rows(registry.latest_versions(log()), "stage", "version") == [("Staging", 2)]
    move(2, "Production", 6)
    assert rows(registry.latest_versions(log()), "stage", "version") == [("Production", 2), ("Staging", 1)]
    move(2, "Archived", 7)
    assert rows(registry.latest_versions(log()), "stage", "version") == [("Staging", 1)]
    with pytest.raises(ValueError):
        move(1, "Live", 8)
    assert log().where("event = 'register'").first().metrics == {"mae": 0.5}
