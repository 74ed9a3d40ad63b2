"""Scenario comparison: the same models under different preparation steps, in one tidy result table.

A scenario is data: an ordered list of steps, and whether the models are tuned. By default every step is fitted on the
training rows of a split or fold only. ``leak_safe=False`` fits the steps on all rows before the folds are dealt, which
is what the compared studies did; synthetic rows then also land in the held-out folds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import (
    evaluate, explain, features, hypothesis, impute, models, projection, resample, results, scale, search, split,
)
from tallymark.session import written


@dataclass(frozen=True)
class Frame:
    """Rows with ``key``, ``label`` and feature columns."""

    df: DataFrame
    features: list[str]

    def vectors(self) -> DataFrame:
        values = F.array(*[F.col(c).cast("double") for c in self.features])
        return self.df.select("key", F.col("label").cast("int").alias("label"), values.alias("vec"))

    @staticmethod
    def of(vectors: DataFrame, names: list[str]) -> Frame:
        columns = [F.col("vec")[i].alias(c) for i, c in enumerate(names)]
        return Frame(vectors.select("key", "label", *columns), names)


@dataclass(frozen=True)
class Scenario:
    steps: tuple = ()
    tuned: bool = False


Apply = Callable[[Frame], Frame]


def _fill(fit: Callable) -> Callable:
    def step(train: Frame) -> Apply:
        values = fit(train.df, train.features)
        return lambda frame: replace(frame, df=impute.fill_with(frame.df, values))

    return step


def _scaled(fit: Callable) -> Callable:
    def step(train: Frame) -> Apply:
        fitted = fit(train.df, train.features)
        return lambda frame: replace(frame, df=scale.transform(frame.df, fitted, train.features))

    return step


def _pca(train: Frame, variance: float = 0.95) -> Apply:
    fitted = projection.fit_pca(train.vectors(), "vec", variance=variance)
    names = [f"pc{i}" for i in range(len(fitted.axes))]
    return lambda frame: Frame.of(projection.project(frame.vectors(), fitted, "vec", "vec"), names)


def _interactions(train: Frame, products: list = (), ratios: list = ()) -> Apply:
    made = {f"{a}_x_{b}": features.product(a, b) for a, b in products}
    made |= {f"{a}_per_{b}": features.ratio(a, b) for a, b in ratios}
    return lambda frame: Frame(frame.df.withColumns(made), [*frame.features, *made])


def _important(train: Frame) -> Apply:
    chosen = explain.forest_importance(train.vectors(), train.features).filter("selected").collect()
    names = [r["feature"] for r in chosen]
    return lambda frame: Frame(frame.df.select("key", "label", *names), names)


def _k_best(train: Frame, k: int = 10) -> Apply:
    names = [r["column"] for r in hypothesis.select_k_best(train.df, train.features, "label", k).collect()]
    return lambda frame: Frame(frame.df.select("key", "label", *names), names)


# A step is fitted on the training frame and returns how to change any frame.
STEPS = {
    "impute_mean": _fill(impute.fit_mean), "impute_median": _fill(impute.fit_median), "scale_standard": _scaled(scale.fit_standard),
    "scale_robust": _scaled(scale.fit_robust), "pca": _pca, "interactions": _interactions, "select_important": _important,
    "select_k_best": _k_best,
}
RESAMPLE = "smote"


def oversample(frame: Frame) -> Frame:
    made = resample.smote(frame.vectors(), "key", "label", "vec")
    return Frame.of(made.select("key", "label", "vec"), frame.features)


def prepare(train: Frame, others: list[Frame], steps: tuple) -> tuple[Frame, list[Frame]]:
    """Run the steps in order; oversampling changes the training rows only.

    The training frame is written after each step that is costly to repeat, so later fits read it back.
    """
    for step in steps:
        name, options = (step, {}) if isinstance(step, str) else step
        if name == RESAMPLE:
            train = oversample(train)
        else:
            apply = STEPS[name](train, **options)
            train, others = apply(train), [apply(frame) for frame in others]
    return replace(train, df=written(train.df)), others


def _tuned(train: Frame, name: str, candidate: tuple[str, dict], spaces: dict, trials: int, k: int) -> tuple[str, dict]:
    """The candidate with the best drawn parameters of its space, found by its own name or by its engine; what is fixed stays."""
    engine, fixed = candidate
    space = spaces.get(name, spaces.get(engine))
    if space is None:
        raise ValueError(f"no parameter space for {name!r} ({engine}) among {sorted(spaces)}")
    space = {p: draw for p, draw in space.items() if p not in fixed}
    searched = search.random_search(train.vectors(), engine, space, trials, k, fixed)
    return engine, {**search.best_parameters(searched), **fixed}


def _predict(train: Frame, test: Frame, candidates: dict, tags: dict) -> list[DataFrame]:
    fixed = [F.lit(v).alias(c) for c, v in tags.items()]
    data, held_out = train.vectors(), test.vectors()

    def run(name: str) -> DataFrame:
        model, params = candidates[name]
        scored = models.fit(model, data, params)(held_out)
        return scored.select(*fixed, F.lit(name).alias("model"), "key", "label", "score", "prediction")

    return models.in_parallel([lambda n=n: run(n) for n in candidates])


def compare(
    frame: Frame, scenarios: dict[str, Scenario], candidates: dict[str, tuple[str, dict]], folds: int | None = None,
    share: float = 0.3, leak_safe: bool = True, trials: int = 30, tuning_folds: int = 10, spaces: dict | None = None,
) -> DataFrame:
    """``scenario, model, fold`` and metrics: k folds, or one stratified split (fold 0) with ``folds=None``.

    Tuned scenarios draw from ``spaces`` (those of the ablation study by default).
    """
    spaces = search.ABLATION_SPACES if spaces is None else spaces
    base = replace(frame, df=written(frame.df))
    if folds is None:
        marked = written(split.stratified_split(base.df, "key", "label", share))
        sides = [(marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test"))]
    else:
        dealt = written(split.stratified_folds(base.df, "key", "label", folds))
        sides = [(dealt.filter(F.col("fold") != i).drop("fold"), dealt.filter(F.col("fold") == i).drop("fold")) for i in range(folds)]

    def choose(scenario: Scenario, train: Frame) -> dict:
        if not scenario.tuned:
            return candidates
        tuned = models.in_parallel([lambda n=n, c=c: _tuned(train, n, c, spaces, trials, tuning_folds) for n, c in candidates.items()])
        return dict(zip(candidates, tuned))

    def run(name: str, scenario: Scenario) -> list[DataFrame]:
        if not leak_safe and folds is not None:
            whole, _ = prepare(base, [], scenario.steps)
            found = search.held_out_predictions(whole.vectors(), choose(scenario, whole), folds)
            return [found.select(F.lit(name).alias("scenario"), "fold", "model", "key", "label", "score", "prediction")]
        scored = []
        for fold, (train_df, test_df) in enumerate(sides):
            train, (test,) = prepare(replace(base, df=train_df), [replace(base, df=test_df)], scenario.steps)
            scored += _predict(train, test, choose(scenario, train), {"scenario": name, "fold": fold})
        return scored

    # Scenarios do not depend on each other; their jobs share the cluster.
    scored = sum(models.in_parallel([lambda n=n, s=s: run(n, s) for n, s in scenarios.items()]), [])
    predictions = written(reduce(DataFrame.unionByName, scored))
    return evaluate.scored_metrics(predictions, "score", "label", "prediction", ["scenario", "model", "fold"])


def four_scenarios(frame: Frame, candidates: dict, **options) -> DataFrame:
    """Baseline, oversampling, selection, and all with tuning, on one split."""
    scenarios = {
        "1. Baseline": Scenario(("scale_standard",)),
        "2. SMOTE": Scenario(("scale_standard", RESAMPLE)),
        "3. Selection": Scenario(("scale_standard", "select_important")),
        "4. All": Scenario(("scale_standard", "select_important", RESAMPLE), tuned=True),
    }
    return compare(frame, scenarios, candidates, **options)


def six_scenarios(frame: Frame, candidates: dict, products: list, ratios: list, folds: int = 10, **options) -> DataFrame:
    """S0 to S5. The models of S5 are the best and the worst of S0, by mean F1 over the folds."""
    made = ("interactions", {"products": products, "ratios": ratios})
    single = {
        "S0": Scenario(("scale_robust",)),
        "S1": Scenario(("scale_standard", "pca")),
        "S2": Scenario((made, "scale_robust")),
        "S3": Scenario(("scale_robust", RESAMPLE)),
    }
    plain = compare(frame, single, candidates, folds, **options)
    tuned = compare(frame, {"S4": Scenario(("scale_robust",), tuned=True)}, candidates, folds, **options)
    first = results.fold_summary(plain.filter("scenario = 'S0'"), ["scenario", "model"], "f1")
    picked = results.best_and_worst(first, ["scenario"], "f1_mean", "model").first()
    few = {m: candidates[m] for m in {picked["best"], picked["worst"]}}
    everything = Scenario((made, "scale_standard", "pca", RESAMPLE), tuned=True)
    last = compare(frame, {"S5": everything}, few, folds, **options)
    return results.append([plain, tuned, last])
