"""Models as tables: shared ones written once, versions swapped last."""

from __future__ import annotations

import pytest

from raceline.plans import graph, marts, views
from raceline.sources import manifest
from raceline.sources.fixtures import raw_tables

SMOKE = "/root/testdata/sf0.001"


class Counting(dict):
    """Raw tables that count how often each is asked for."""

    def __init__(self, raw):
        super().__init__(raw)
        self.asked: dict[str, int] = {}

    def __getitem__(self, name):
        self.asked[name] = self.asked.get(name, 0) + 1
        return super().__getitem__(name)


def test_shared_models_are_written_once_and_read(spark, tmp_path):
    raw, root = raw_tables(spark, SMOKE), str(tmp_path / "models")
    names = ["final_race_leaderboard", "final_race_summary", "final_historical_analysis"]
    written = views.build_tables(spark, raw, root, names)
    assert len(written) == len(set(written)) and written[-3:] == names
    assert {"stg_laps", "int_best_laps"} & set(written) and written.index("stg_laps") < written.index(names[0])
    for name in names:
        got, want = graph.read_model(spark, root, name), marts.MODELS[name](raw)
        assert got.columns == want.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0

    seen = Counting({k: raw[k] for k in raw})
    run = graph.ModelRun(seen)
    for shared in graph.shared_models(views.MODELS, names, seen):
        run.built[shared] = graph.read_model(spark, root, shared)
    seen.asked.clear()
    for name in names:
        views.MODELS[name](run)
    assert "laps" not in seen.asked  # the marts read the written laps


def test_killed_run_leaves_the_old_version(spark, tmp_path):
    raw, root = raw_tables(spark, SMOKE), str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        graph.read_model(spark, root, "final_session_mapping")
    views.build_tables(spark, raw, root, ["final_session_mapping"])
    before = sorted(map(tuple, graph.read_model(spark, root, "final_session_mapping").collect()), key=str)

    def dies(run):
        if run.built:  # after the first table of the run is written
            raise RuntimeError("killed")
        return run["sessions"]

    models = {"final_session_mapping": lambda run: views.MODELS["final_session_mapping"](run).limit(0), "last": dies}
    with pytest.raises(RuntimeError):
        graph.build_models(spark, models, ["final_session_mapping", "last"], raw, root)
    assert sorted(map(tuple, graph.read_model(spark, root, "final_session_mapping").collect()), key=str) == before
    views.build_tables(spark, raw, root, ["final_session_mapping"])
    assert len(manifest.published_loads(spark, root)) == 1 and len(manifest.vacuum(spark, root)) == 2


def test_materialize_swaps_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert views.materialize(spark.range(5).toDF("n"), path) == 5
    assert views.materialize(manifest.read_published(spark, path, spark.range(1).toDF("n").schema).where("n > 1"), path) == 3
    assert manifest.read_published(spark, path, spark.range(1).toDF("n").schema).count() == 3
