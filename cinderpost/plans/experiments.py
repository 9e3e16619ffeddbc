"""Experiments: features, training, prediction and the report as one call."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.functions import patterns as P
from cinderpost.functions.porter import stem_tokens
from cinderpost.operators import descent, evaluate, naive_bayes, network, sequence
from cinderpost.operators.features import LAYOUT, FeatureBuilder, FeatureModel, carried, document_frequency, with_layout
from cinderpost.operators.tokens import check_option, prepare
from cinderpost.session import discard, stage
from cinderpost.sources.stages import StageStore, fingerprint


@dataclass(frozen=True)
class Experiment:
    stemming: str = "NoStem"
    weighting: str = "Frequency"
    classifier: str = "NaiveBayes"
    legacy_stops: bool = False
    select_on: str = "validation"
    network: network.Settings = field(default_factory=network.Settings)
    search: descent.Search | None = None  # quasi-Newton steps in place of plain ones

    def __post_init__(self):
        check_option(self.stemming, P.STEMMING, "stemming")
        check_option(self.weighting, P.WEIGHTINGS, "weighting")
        check_option(self.classifier, P.CLASSIFIERS, "classifier")
        check_option(self.select_on, ("validation", "test"), "select_on")

    @property
    def run_id(self) -> str:
        return f"{self.stemming}-{self.weighting}-{self.classifier}"

    @property
    def model_id(self) -> str:
        """The run and everything else that its model depends on, the input aside."""
        how = self.search or self.settings()
        trained = () if self.classifier == "NaiveBayes" else (repr(how), self.select_on)
        facts = {"legacy_stops": self.legacy_stops, "patterns": P.version(), "trained": trained}
        return f"{self.run_id}-{fingerprint(**facts)}"

    def settings(self) -> network.Settings:
        """Network settings of the classifier; a rate that is not given depends on it."""
        return replace(self.network, hidden=20 if self.classifier == "FFNN" else 0)


def prepare_once(
    posts: DataFrame,
    stemming: str,
    legacy_stops: bool = False,
    store: StageStore | None = None,
    input_id: str | None = None,
    **facts,
) -> DataFrame:
    """Written token table of labelled posts, shared by all experiments on one variant.

    Terms are counted and features laid out once, as every pass over them needs them.

    With a ``store`` the table outlives the session and is found again under the same options,
    patterns, ``facts`` and ``input_id``, a name that must change whenever the posts do.
    """
    labelled = posts.filter(F.col("target").isNotNull())
    if store is None:
        return stage(with_layout(prepare(labelled, stemming, legacy_stops)), f"tokens-{stemming}")
    if not input_id:
        raise ValueError("a stored token table needs the input_id of its posts")
    options = {
        "stemming": stemming,
        "legacy_stops": legacy_stops,
        "patterns": P.version(),
        "input_id": input_id,
        **facts,
    }
    return store.reuse("tokens", lambda: prepare(labelled, stemming, legacy_stops), **options)


def stems_once(prepared: DataFrame) -> DataFrame:
    """The written token table of stems, made of the unstemmed one: texts are tokenized once."""
    stems = prepared.drop(LAYOUT).withColumn("tokens", stem_tokens(F.col("tokens")))
    return stage(with_layout(stems), "tokens-Stem")


def part(prepared: DataFrame, split: str) -> DataFrame:
    check_option(split, P.SPLITS, "split")
    return prepared.filter(F.col("split") == split)


@dataclass
class Trained:
    """A trained experiment as its tables: class sums, or feature dictionary and weights."""

    experiment: Experiment
    tables: dict[str, DataFrame]
    history: DataFrame | None = None

    @staticmethod
    def table_names(experiment: Experiment) -> tuple[str, ...]:
        return ("sums",) if experiment.classifier == "NaiveBayes" else ("dictionary", "weights")

    def predict(self, prepared: DataFrame) -> DataFrame:
        """``run_id, id, pred``, and ``target`` if the posts have one."""
        how = self.experiment
        if how.classifier == "NaiveBayes":
            model = naive_bayes.NaiveBayesModel(self.tables["sums"])
            scored = naive_bayes.predict(naive_bayes.score(prepared, model, (how.weighting,)))
        else:
            features = FeatureModel(self.tables["dictionary"], how.weighting)
            rows = stage(features.transform(prepared, keep=("target",)), "features")
            model = network.NetworkModel(self.tables["weights"], how.settings().hidden)
            scored = model.score(rows)
        run_id = F.lit(how.run_id).alias("run_id")
        return scored.select(run_id, "id", "pred", *carried(scored, "target"))

    def save(self, store: StageStore, **facts) -> None:
        for name, table in self.tables.items():
            store.save(table, f"model-{name}", model=self.experiment.model_id, **facts)

    @staticmethod
    def load(store: StageStore, experiment: Experiment, **facts) -> Trained:
        return Trained(
            experiment,
            {
                name: store.load(f"model-{name}", model=experiment.model_id, **facts)
                for name in Trained.table_names(experiment)
            },
        )


def _held_out() -> Column:
    """One eighth of the posts, by a hash of the id."""
    return F.pmod(F.xxhash64("id"), F.lit(8)) == 0


def _placed(transform, prepared: DataFrame, select_on: str, fitted=None) -> DataFrame:
    """Rows of the posts that train, and of those that the round to keep is chosen on.

    With ``last`` there are none of the latter, and the last round is kept. ``fitted`` is the
    transform of the posts that the features come from, if there is one of its own.
    """
    check_option(select_on, ("validation", "test", "last"), "select_on")
    posts = (fitted or transform)(part(prepared, "train"), keep=("target",))
    if select_on == "last":
        return posts.withColumn("trains", F.lit(True))
    if select_on == "test":
        test = transform(part(prepared, "test"), keep=("target",))
        return posts.withColumn("trains", F.lit(True)).unionByName(test.withColumn("trains", F.lit(False)))
    return posts.withColumn("trains", ~_held_out())


def train(prepared: DataFrame, experiment: Experiment) -> Trained:
    """Train on the train posts of ``prepared``.

    The round to keep of a Logistic or FFNN run is chosen on one eighth of the training posts,
    held out by a hash of the id, or on the test posts when ``select_on="test"``.
    """
    posts = part(prepared, "train")
    if experiment.classifier == "NaiveBayes":
        return Trained(experiment, {"sums": naive_bayes.fit(posts).sums})
    features = FeatureBuilder(experiment.weighting).fit(posts)
    if experiment.search:
        learner = descent.Learner(experiment.run_id, hidden=experiment.settings().hidden)
        placed = _placed(features.transform, prepared, experiment.select_on, features.transform_fitted)
        rows = stage(placed, "train-features")
        placed = rows.withColumn("v", F.array("value"))
        found = descent.fit_many(placed, [learner], experiment.search).model(experiment.run_id)
        discard(rows)
        return Trained(experiment, {"dictionary": features.dictionary, "weights": found.weights}, found.history)
    rows = stage(features.transform(posts, keep=("target",)), "train-features")
    written = [rows]
    if experiment.select_on == "test":
        test = features.transform(part(prepared, "test"), keep=("target",))
        chosen = stage(test, "test-features")
        written.append(chosen)
    else:
        rows, chosen = rows.filter(~_held_out()), rows.filter(_held_out())
    model = network.fit(rows, chosen, experiment.settings(), experiment.run_id)
    discard(*written)
    tables = {"dictionary": features.dictionary, "weights": model.weights}
    return Trained(experiment, tables, model.history)


def predict_experiment(prepared: DataFrame, experiment: Experiment) -> DataFrame:
    """``run_id, id, pred, target`` for the test posts."""
    return train(prepared, experiment).predict(part(prepared, "test"))


def run_experiment(
    posts: DataFrame, experiment: Experiment, store: StageStore | None = None, **facts
) -> DataFrame:
    """One report row: ``run_id, accuracy, tn, fn, fp, tp``. A store needs an ``input_id``."""
    prepared = prepare_once(
        posts, experiment.stemming, experiment.legacy_stops, store, **facts
    )
    return evaluate.eval_report(predict_experiment(prepared, experiment))


def naive_bayes_grid(prepared: DataFrame, stemming: str, model: naive_bayes.NaiveBayesModel | None = None) -> DataFrame:
    """Predictions of all weightings: one training aggregation, one scoring join."""
    model = model or naive_bayes.fit(part(prepared, "train"))
    scores = naive_bayes.score(part(prepared, "test"), model, P.WEIGHTINGS)
    run_id = F.concat(F.lit(f"{stemming}-"), "weighting", F.lit("-NaiveBayes"))
    return naive_bayes.predict(scores).select(run_id.alias("run_id"), "id", "pred", "target")


def network_grid(
    prepared: DataFrame,
    stemming: str,
    classifiers: tuple[str, ...],
    search: descent.Search,
    select_on: str = "validation",
    start: Callable[[descent.Units], tuple[Column, list]] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Predictions of all weightings and network classifiers: trained together, scored together.

    The rows hold the values of every weighting, so one scan a round serves six runs. ``start``
    gives the starting weights, else they are random. ``counts`` are those of the training posts'
    features, if they were counted before.
    """
    features = FeatureBuilder().fit(part(prepared, "train"), counts)
    learners = [
        descent.Learner(e.run_id, P.WEIGHTINGS.index(e.weighting), e.settings().hidden)
        for e in (Experiment(stemming, w, c) for w, c in product(P.WEIGHTINGS, classifiers))
    ]
    rows = stage(_placed(features.transform_all, prepared, select_on), "grid-features")
    models = descent.fit_many(rows, learners, search, start and start(descent.Units(learners)))
    discard(rows)
    test = stage(features.transform_all(part(prepared, "test"), keep=("target",)), "grid-test")
    return models.score(test).select("run_id", "id", "pred", "target")


def run_grid(
    posts: DataFrame,
    classifiers: tuple[str, ...] = P.CLASSIFIERS,
    search: descent.Search | None = None,
    select_on: str = "validation",
    start: Callable[[descent.Units], tuple[Column, list]] | None = None,
) -> DataFrame:
    """Report rows of every combination; each token variant is made once, its runs share scans."""
    predictions = []
    plain = prepare_once(posts, "NoStem")
    for stemming in P.STEMMING:
        prepared = stems_once(plain) if stemming == "Stem" else plain
        counts = None
        if "NaiveBayes" in classifiers:
            model = naive_bayes.fit(part(prepared, "train"))
            predictions.append(naive_bayes_grid(prepared, stemming, model))
            counts = model.sums
        others = tuple(c for c in classifiers if c != "NaiveBayes")
        if others:
            found = network_grid(prepared, stemming, others, search or descent.Search(), select_on, start, counts)
            predictions.append(found)
    rows = predictions[0]
    for more in predictions[1:]:
        rows = rows.unionByName(more)
    return evaluate.eval_report(rows)


def run_sequence_experiment(
    posts: DataFrame, stemming: str = "Stem", size: int = 128, seed: int = 7
) -> DataFrame:
    """Word vectors of the joint vocabulary, pooled per post, and a linear classifier.

    The vocabulary is that of all posts; those without a label neither train nor are reported.
    """
    every = stage(prepare(posts, stemming), f"tokens-{stemming}")
    embedding = stage(sequence.random_embedding(document_frequency(every), size, seed), "embedding")
    prepared = every.filter(F.col("target").isNotNull())
    model = sequence.SequenceModel.fit(part(prepared, "train"), embedding)
    predicted = model.predict(part(prepared, "test"))
    run_id = F.lit(f"{stemming}-WordEmbedding-Pooled").alias("run_id")
    return evaluate.eval_report(predicted.select(run_id, "pred", "target"))


def rescore(
    store: StageStore, posts: DataFrame, experiment: Experiment, **facts
) -> DataFrame:
    """Score test posts with a saved model, keep the predictions, report from what was kept."""
    prepared = prepare_once(posts, experiment.stemming, experiment.legacy_stops)
    trained = Trained.load(store, experiment, **facts)
    store.save_predictions(trained.predict(part(prepared, "test")), experiment.model_id)
    return evaluate.eval_report(store.load_predictions(experiment.model_id))
