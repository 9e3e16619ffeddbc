"""One query per operator over the given tables, through the adapter views."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderpost.functions import scoring, text as X
from cinderpost.operators import (
    batches,
    descent,
    evaluate,
    features as E,
    history as H,
    labeling,
    linear,
    metadata as M,
    naive_bayes as NB,
    network,
    sequence,
    tokens as K,
    vocab,
)
from cinderpost.plans import experiments as runs
from cinderpost.plans import views as V
from cinderpost.operators.unroll import unroll_structs
from cinderpost.session import shared_folder, stage
from cinderpost.sources import posts as src
from cinderpost.sources.stages import StageStore

Q = {}


def query(fn):
    Q[fn.__name__] = fn
    return fn


def _round(name: str, places: int = 6) -> Column:
    return F.round(name, places).alias(name)


def _lines(name: str) -> Column:
    return F.array_join(name, "\n").alias(name)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.with_tokens(V.posts(spark, sf_dir))


def _train(df: DataFrame) -> DataFrame:
    return runs.part(df, "train")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.prepare_once(V.posts(spark, sf_dir), "NoStem")


# ---- sources, metadata -------------------------------------------------------------------


@query
def split_counts(spark, sf_dir):
    return src.split_counts(V.posts(spark, sf_dir))


@query
def posts_csv(spark, sf_dir):
    """Posts written as quoted CSV, line ends in texts included, and read back by splits."""
    path = f"{shared_folder(spark)}/cinderpost/posts-{uuid.uuid4().hex}"
    names = [f.name for f in src.LABELLED_POST.fields]
    src.write_posts(V.posts(spark, sf_dir).select(names), path)
    digest = F.sha2("text", 256).alias("text_sha256")
    return src.read_posts(spark, path).select("id", "keyword", "location", digest, "target")


@query
def submission(spark, sf_dir):
    return src.submission(V.predictions(spark, sf_dir))


@query
def keyword_index(spark, sf_dir):
    return M.keyword_index(_train(V.posts(spark, sf_dir)))


@query
def keyword_encode(spark, sf_dir):
    posts = V.posts(spark, sf_dir).select("id", "keyword", "split")
    return M.keyword_encode(posts, M.keyword_index(_train(posts))).select("id", "keywd")


@query
def location_flag(spark, sf_dir):
    return M.location_flag(V.posts(spark, sf_dir)).select("id", "loc")


@query
def url_count(spark, sf_dir):
    return M.url_count(V.posts(spark, sf_dir)).select("id", "url")


# ---- text --------------------------------------------------------------------------------


def _text_query(name, step):
    def run(spark, sf_dir):
        return V.posts(spark, sf_dir).select("id", step(F.col("text")).alias("text"))

    run.__name__ = name
    return query(run)


for _name in (
    "strip_urls",
    "strip_entities",
    "strip_numbers",
    "lower_capitalized",
    "strip_tags",
    "clean_text",
    "match_key",
):
    _text_query(_name, getattr(X, _name))


@query
def stopwords_strict(spark, sf_dir):
    kept = K.with_pieces(V.posts(spark, sf_dir))
    return kept.select("id", F.array_join("pieces", " ").alias("text"))


@query
def stopwords_legacy(spark, sf_dir):
    kept = K.with_pieces(V.posts(spark, sf_dir), legacy_stops=True).select("id", "pieces")
    counted = X.term_counts(kept, "pieces", "counts")
    return unroll_structs(counted, ["id"], "counts", "term").withColumnsRenamed(
        {"term": "piece", "tf": "n"}
    )


@query
def tokenize(spark, sf_dir):
    kept = K.with_pieces(V.posts(spark, sf_dir))
    tokens = X.tokenize(F.array_join("pieces", " "))
    return kept.select("id", tokens.alias("tokens")).select("id", _lines("tokens"))


@query
def split_contractions(spark, sf_dir):
    return _tokens(spark, sf_dir).select("id", _lines("tokens"))


@query
def stem_tokens(spark, sf_dir):
    return K.stem_table(_tokens(spark, sf_dir))


@query
def token_corpus(spark, sf_dir):
    plain = K.token_corpus(V.posts(spark, sf_dir), variants=("NoStem",))
    return plain.select("id", "split", F.size("tokens").alias("n_tokens"), _lines("tokens"))


@query
def token_corpus_stems(spark, sf_dir):
    stems = K.token_corpus(V.posts(spark, sf_dir), variants=("Stem",))
    return stems.select("id", "split", F.size("tokens").alias("n_tokens"), _lines("tokens"))


# ---- vocabulary --------------------------------------------------------------------------


@query
def vocabulary(spark, sf_dir):
    return vocab.vocabulary(_train(_tokens(spark, sf_dir)))


@query
def vocab_size(spark, sf_dir):
    return vocab.vocabulary(_train(_tokens(spark, sf_dir))).agg(
        F.count("*").alias("vocab_size")
    )


@query
def joint_vocab(spark, sf_dir):
    return vocab.joint_vocabulary(_tokens(spark, sf_dir))


@query
def max_len(spark, sf_dir):
    return K.max_length(_tokens(spark, sf_dir))


@query
def sequence_encode(spark, sf_dir):
    tokenized = stage(_tokens(spark, sf_dir).select("id", "tokens"), "tokens")
    words = stage(vocab.joint_vocabulary(tokenized), "joint-vocab")
    longest = K.max_length(tokenized).scalar()
    pad_id = words.agg(F.max("term_id")).scalar()
    # Ids become text before the lists are filled up, not once for every place that is filled.
    coded = vocab.encode_sequences(tokenized, words).withColumn("ids", F.col("ids").cast("array<string>"))
    full = vocab.pad_sequences(coded, longest, pad_id.cast("string"))
    return full.select("id", F.array_join("padded", ",").alias("ids"), "max_len", F.col("pad_id").cast("long").alias("pad_id"))


@query
def oov_filter(spark, sf_dir):
    tokenized = stage(_tokens(spark, sf_dir).select("id", "split", "tokens"), "tokens")
    return vocab.split_by_vocabulary(tokenized, vocab.vocabulary(_train(tokenized)))


# ---- features ----------------------------------------------------------------------------


@query
def term_frequency(spark, sf_dir):
    return E.term_frequency(_tokens(spark, sf_dir))


@query
def term_binary(spark, sf_dir):
    return E.term_binary(_tokens(spark, sf_dir))


@query
def log_tf(spark, sf_dir):
    return E.log_tf(_tokens(spark, sf_dir)).select("id", "term", _round("log_tf"))


@query
def doc_frequency(spark, sf_dir):
    return E.document_frequency(_train(_tokens(spark, sf_dir)))


@query
def idf(spark, sf_dir):
    return E.idf(_train(_tokens(spark, sf_dir))).select("term", "df", _round("idf"))


def _tfidf(split):
    def run(spark, sf_dir):
        tokenized = stage(_tokens(spark, sf_dir).select("id", "split", "tokens"), "tokens")
        model = E.IdfModel.fit(_train(tokenized))
        found = model.transform(runs.part(tokenized, split))
        return found.select("id", "term", _round("tfidf"))

    return run


Q["tfidf"] = _tfidf("train")
Q["tfidf_test"] = _tfidf("test")


@query
def keyword_onehot(spark, sf_dir):
    return E.keyword_onehot(V.posts(spark, sf_dir))


@query
def assemble_features(spark, sf_dir):
    prepared = stage(K.prepare(V.posts(spark, sf_dir)), "prepared")
    rows = E.FeatureBuilder("TFIDF").fit(_train(prepared)).transform(prepared)
    return rows.filter(F.col("feature") != E.BIAS).select("id", "feature", _round("value"))


@query
def feature_dims(spark, sf_dir):
    return E.FeatureBuilder().fit(_train(K.prepare(V.posts(spark, sf_dir)))).dims()


# ---- naive Bayes -------------------------------------------------------------------------


def _naive_bayes(spark, sf_dir):
    tokenized = _labelled(spark, sf_dir)
    return tokenized, NB.fit(_train(tokenized))


def _scores(spark, sf_dir):
    tokenized, model = _naive_bayes(spark, sf_dir)
    return NB.score(runs.part(tokenized, "test"), model, ("Frequency",))


@query
def nb_prior(spark, sf_dir):
    _, model = _naive_bayes(spark, sf_dir)
    return model.prior().select("label", _round("log_prior"))


@query
def nb_likelihood(spark, sf_dir):
    _, model = _naive_bayes(spark, sf_dir)
    return model.likelihood("Frequency").select("feature", _round("ll0"), _round("ll1"))


@query
def nb_score(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    return scores.select("id", _round("score0", 4), _round("score1", 4))


@query
def nb_predict(spark, sf_dir):
    return NB.predict(_scores(spark, sf_dir)).select("id", "target", "pred")


@query
def nb_predict_all(spark, sf_dir):
    """Classes of all posts, most of which have no label, by the model of the labelled ones."""
    _, model = _naive_bayes(spark, sf_dir)
    every = stage(K.prepare(V.posts(spark, sf_dir).drop("target")), "tokens")
    return NB.predict(NB.score(every, model, ("Frequency",))).select("id", "pred")


@query
def rescore(spark, sf_dir):
    """The flagship experiment from a stored model and stored predictions."""
    store = StageStore(spark, f"{shared_folder(spark)}/cinderpost/store-{uuid.uuid4().hex}")
    experiment = runs.Experiment()
    runs.train(_labelled(spark, sf_dir), experiment).save(store, input_id=sf_dir)
    report = runs.rescore(store, V.posts(spark, sf_dir), experiment, input_id=sf_dir)
    return report.select("run_id", _round("accuracy"), "tn", "fn", "fp", "tp")


@query
def stored_stages(spark, sf_dir):
    """Every kind of stored stage, written, replaced by a newer version and loaded again."""
    store = StageStore(spark, f"{shared_folder(spark)}/cinderpost/store-{uuid.uuid4().hex}")
    posts = V.posts(spark, sf_dir)
    labelled = _labelled(spark, sf_dir)
    # Posts with a label have their tokens by now; only the others are tokenized here.
    others = K.with_tokens(posts.filter(F.col("target").isNull()))
    every = labelled.select("id", "split", "tokens").unionByName(others.select("id", "split", "tokens"))
    tokens = store.save(every, "tokens", input_id=sf_dir)
    made = {
        "keywords": M.keyword_index(_train(posts)),
        "vocabulary": vocab.vocabulary(_train(tokens)),
        "idf": E.idf(_train(tokens)),
    }
    for name, df in made.items():
        store.save(df.limit(0), name, input_id=sf_dir)
        store.save(df, name, input_id=sf_dir)
    experiment = runs.Experiment()
    runs.train(labelled, experiment).save(store, input_id=sf_dir)
    model = runs.Trained.load(store, experiment, input_id=sf_dir)
    store.save_predictions(model.predict(runs.part(labelled, "test")), experiment.model_id)
    likelihood = NB.NaiveBayesModel(model.tables["sums"]).likelihood("Frequency")
    facts = {
        "tokens": (store.load("tokens", input_id=sf_dir), F.sum(F.size("tokens"))),
        "keywords": (store.load("keywords", input_id=sf_dir), F.sum("keywd")),
        "vocabulary": (store.load("vocabulary", input_id=sf_dir), F.sum(F.length("term"))),
        "idf": (store.load("idf", input_id=sf_dir), F.sum("idf")),
        "model": (likelihood, F.sum("ll0")),
        "predictions": (store.load_predictions(), F.sum("pred")),
    }
    found = None
    for name, (df, total) in facts.items():
        row = df.agg(F.lit(name).alias("kind"), F.count("*").alias("n"), F.round(total.cast("double"), 3).alias("total"))
        found = row if found is None else found.unionByName(row)
    return found


@query
def nb_grid(spark, sf_dir):
    predictions = runs.naive_bayes_grid(_labelled(spark, sf_dir), "NoStem")
    report = evaluate.eval_report(predictions)
    return report.select("run_id", _round("accuracy"), "tn", "fn", "fp", "tp")


@query
def nb_experiment(spark, sf_dir):
    report = runs.run_experiment(V.posts(spark, sf_dir), runs.Experiment())
    return report.select("run_id", _round("accuracy"), "tn", "fn", "fp", "tp")


@query
def nb_grid_stems(spark, sf_dir):
    tokenized = runs.prepare_once(V.posts(spark, sf_dir), "Stem")
    report = evaluate.eval_report(runs.naive_bayes_grid(tokenized, "Stem"))
    return report.select("run_id", _round("accuracy"), "tn", "fn", "fp", "tp")


# ---- linear and network models -----------------------------------------------------------


def _fixed_case(tokenized):
    """Binary word features of posts and the weight (length - 5) / 8192 per word."""
    words = E.with_features(tokenized, keep=("target",)).withColumn(
        "value", E.weigh(F.col("feature"), F.col("value"), "Binary")
    )
    rows = stage(words.filter(E.is_word(F.col("feature")) | (F.col("feature") == E.BIAS)), "words")
    weight = (F.length("feature") - len(E.WORD) - 5) / 8192.0
    terms = stage(rows.groupBy("feature").agg(F.count("*").alias("df")), "features")
    weights = terms.filter(E.is_word(F.col("feature"))).withColumn("w", weight)
    return rows, terms, stage(weights, "fixed-weights")


@query
def logistic_score(spark, sf_dir):
    """Scores of all posts, with or without a label."""
    rows, _, weights = _fixed_case(stage(K.prepare(V.posts(spark, sf_dir)), "tokens"))
    return linear.logistic_score(rows, weights).select("id", "target", _round("p"), "pred")


@query
def mse_gradient_step(spark, sf_dir):
    rows, _, weights = _fixed_case(_labelled(spark, sf_dir))
    return linear.mse_gradient_step(rows, weights, 0.1).select("feature", _round("w", 8))


@query
def logistic_descent(spark, sf_dir):
    rows, _, weights = _fixed_case(_labelled(spark, sf_dir))
    return linear.descend(rows, weights, 1.0, 3).select("feature", _round("w", 8))


@query
def mlp_descent(spark, sf_dir):
    """Two steps of a network of two hidden units from fixed weights."""
    rows, terms, _ = _fixed_case(_labelled(spark, sf_dir))
    found = network.descend(rows, _fixed_network(terms).drop("df"), 2, 1.0, 2)
    return found.select("feature", F.posexplode("w").alias("unit", "w")).select("feature", "unit", _round("w", 8))


def _fixed_network(terms):
    """A network of two hidden units with fixed weights."""
    unit = F.when(F.col("feature") == E.BIAS, 0.0).otherwise((F.length("feature") - 7) / 8192.0)
    first = terms.select("feature", "df", F.array(unit, -0.5 * unit).alias("w"))
    output = terms.sparkSession.createDataFrame(
        [(network.OUTPUT, 0, [0.5, -0.25, 0.125])], "feature string, df long, w array<double>"
    )
    return stage(first.unionByName(output), "fixed-network")


@query
def network_score(spark, sf_dir):
    """Scores of all posts, with or without a label, by a network with fixed weights."""
    rows, terms, _ = _fixed_case(stage(K.prepare(V.posts(spark, sf_dir)), "tokens"))
    scored = network.NetworkModel(_fixed_network(terms), 2).score(rows)
    return scored.select("id", "target", _round("p"), "pred")


@query
def minibatch(spark, sf_dir):
    return batches.minibatches(V.posts(spark, sf_dir).select("id"))


@query
def shuffled_order(spark, sf_dir):
    """Place of every post in a random, repeatable order."""
    return batches.permutation(V.posts(spark, sf_dir).select("id"), seed=7)


@query
def batch_descent(spark, sf_dir):
    """Two epochs of four shuffled batches from fixed weights, a step for each batch."""
    tokenized = _labelled(spark, sf_dir)
    rows, names, weights = _fixed_case(tokenized)
    start = stage(
        names.join(weights.select("feature", "w"), "feature", "left").select("feature", F.array(F.coalesce("w", F.lit(0.0))).alias("w")),
        "start",
    )
    size = max(1, -(-tokenized.count() // 4))
    placed = stage(batches.shuffled_minibatches(tokenized.select("id"), 7, size), "batch-places")
    found = batches.batch_descent(rows, placed, start, 0, 1.0, 2)
    return found.select("feature", F.get("w", F.lit(0)).alias("w")).select("feature", _round("w", 8))


@query
def epoch_metrics(spark, sf_dir):
    tokenized = _labelled(spark, sf_dir)
    rows, _, weights = _fixed_case(tokenized)
    scored = linear.logistic_score(rows, weights)
    ids = tokenized.select("id", "split")
    batched = batches.minibatches(_train(ids)).unionByName(
        batches.minibatches(runs.part(ids, "test"))
    )
    metrics = H.epoch_metrics(scored.join(batched, "id").withColumn("epoch", F.lit(1)))
    return metrics.select("epoch", _round("loss"), _round("train_acc"), _round("test_acc"))


@query
def best_checkpoint(spark, sf_dir):
    return H.best_checkpoint(V.history(spark, sf_dir))


@query
def early_stop(spark, sf_dir):
    return H.early_stop(V.history(spark, sf_dir), 5)


# Quasi-Newton steps over all posts until the validation posts get worse or nothing is gained.
# Settings were chosen on the held-out eighth of the training posts at sf0.01, never on the test
# posts: the README has the figures.
_SEARCH = descent.Search()


def _trained(classifier):
    def run(spark, sf_dir):
        experiment = runs.Experiment("NoStem", "Binary", classifier, search=_SEARCH)
        return evaluate.eval_report(
            runs.predict_experiment(_labelled(spark, sf_dir), experiment)
        )

    return run


Q["logistic_train"] = _trained("Logistic")
Q["mlp_train"] = _trained("FFNN")


def _fixed_start(units):
    """Starting weights of a grid, by the length of a feature and the place of a unit."""
    places = [j for x in units.learners for j in range(x.width)]
    first = F.array(*[((F.length("feature") + 3 * j) % 7 - 3) / 64.0 for j in places])
    return first, [[(2 * j % 5 - 2) / 4.0 for j in range(x.hidden)] + [0.0] for x in units.learners]


@query
def grid(spark, sf_dir):
    """All 18 runs; the networks take two steps over all training posts from fixed weights."""
    search = descent.Search(rounds=2, rate=0.5)
    report = runs.run_grid(V.posts(spark, sf_dir), search=search, select_on="last", start=_fixed_start)
    return report.select("run_id", _round("accuracy"), "tn", "fn", "fp", "tp")


@query
def random_vectors(spark, sf_dir):
    """Four numbers of the random vector of every term."""
    vectors = sequence.random_embedding(vocab.vocabulary(_tokens(spark, sf_dir)), 4)
    return vectors.select("term", F.posexplode_outer("vec").alias("pos", "x")).select(
        "term", "pos", F.round(F.col("x").cast("double"), 4).alias("x")
    )


@query
def sequence_classify(spark, sf_dir):
    return runs.run_sequence_experiment(V.posts(spark, sf_dir), "Stem")


def _fixed_vectors(spark, sf_dir):
    """Tokens of all posts, and three fixed numbers per term as its vector."""
    tokenized = stage(_tokens(spark, sf_dir).select("id", "tokens"), "tokens")
    n = F.length("term")
    fixed = F.array(*[(n * k % 7).cast("float") for k in (1, 2, 3)])
    terms = E.document_frequency(tokenized)
    return tokenized, stage(terms.select("term", "df", fixed.alias("vec")), "vectors")


@query
def sequence_score(spark, sf_dir):
    """Scores of all posts by fixed vectors and fixed weights."""
    tokenized, vectors = _fixed_vectors(spark, sf_dir)
    weights = [(sequence.BIAS, -0.25), (0, 0.5), (1, -0.375), (2, 0.125)]
    model = sequence.SequenceModel(vectors, spark.createDataFrame(weights, "pos int, w double"))
    return model.score(tokenized).select("id", _round("p"), "pred")


@query
def post_vectors(spark, sf_dir):
    """Mean vector of every post's tokens, from three fixed numbers per term."""
    tokenized, vectors = _fixed_vectors(spark, sf_dir)
    pooled = sequence.pool_posts(tokenized, vectors)
    return pooled.select("id", F.posexplode_outer(vector_to_array("features")).alias("pos", "mean_value")).select(
        "id", "pos", _round("mean_value")
    )


@query
def embedding_pool(spark, sf_dir):
    vectors = V.table(spark, sf_dir, "embeddings")
    return sequence.pool_vectors(vectors, "label", "embedding").select(
        "label", "pos", _round("mean_value")
    )


@query
def argmax_scores(spark, sf_dir):
    vectors = V.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", scoring.first_argmax(F.col("embedding")).alias("best"))


# ---- evaluation, label recovery ----------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(V.predictions(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    return evaluate.accuracy(V.predictions(spark, sf_dir)).select(_round("accuracy"))


@query
def eval_report(spark, sf_dir):
    rule = V.predictions(spark, sf_dir).withColumn("run_id", F.lit("fixed-rule"))
    return evaluate.eval_report(rule).select(
        "run_id", _round("accuracy"), "tn", "fn", "fp", "tp"
    )


@query
def label_match(spark, sf_dir):
    return labeling.label_match(V.unlabelled(spark, sf_dir), V.gold(spark, sf_dir))


@query
def add_labels(spark, sf_dir):
    posts = V.unlabelled(spark, sf_dir)
    labelled = labeling.add_labels(posts, labeling.label_match(posts, V.gold(spark, sf_dir)))
    return labelled.select("id", F.length("text").alias("n_chars"), "target")


@query
def label_conflicts(spark, sf_dir):
    return labeling.label_conflicts(V.gold(spark, sf_dir))


@query
def unmatched(spark, sf_dir):
    return labeling.unmatched(V.unlabelled(spark, sf_dir), V.gold(spark, sf_dir))
