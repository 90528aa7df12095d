"""The registered model queries run the documented parameters."""

from tidegrid.models import training, tuning
from tidegrid.operators.features import FeatureConfig
from tidegrid.plans import queries_models as queries


def test_model_queries_run_the_whole_job(monkeypatch):
    assert queries.CONFIG == FeatureConfig() and queries.PARAMS == training.TREE_PARAMS
    seen = {}

    class Stop(Exception):
        pass

    def fit_by_step(whole, steps, config, keys, params):
        seen.update(steps=list(steps), config=config, params=params)
        raise Stop

    monkeypatch.setattr(queries.fc, "fit_by_step", fit_by_step)
    monkeypatch.setattr(queries, "cut_lineage", lambda df: df)
    monkeypatch.setattr(queries, "series", lambda spark, d: None)
    try:
        queries.forecast_horizon(None, "")
    except Stop:
        pass
    assert seen == {"steps": list(range(1, 25)), "config": FeatureConfig(), "params": training.TREE_PARAMS}
    trials = []
    monkeypatch.setattr(queries, "_rows", lambda spark, d: (None, []))
    monkeypatch.setattr(tuning, "search", lambda view, names, made, *rest, **options: trials.append(made) or (_ for _ in ()).throw(Stop()))
    for search in (queries.grid_search, queries.random_search):
        try:
            search(None, "")
        except Stop:
            pass
    assert [len(t) for t in trials] == [4, 10] and not any("maxIter" in p for t in trials for p in t)
