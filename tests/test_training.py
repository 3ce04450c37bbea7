"""Pipelines: settings, save and load, streams that score like batches, cross-validation."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import functions as F

from sentilode.checks import tables
from sentilode.functions.text import model_tokens
from sentilode.operators import bayes, features, metrics, sampling
from sentilode.operators.lemma import IRREGULAR
from sentilode.operators.stages import LearnedLemmas, LemmaLearner, Lemmatizer, TextCleaner
from sentilode.plans import training
from sentilode.session import scratch_path
from sentilode.sources import corpus, messages as msg, results as res
from sentilode.streaming import score as st

SF_DIR = "/root/testdata/sf0.001"
LEXICON = ["day", "year", "thing", "man"]


@pytest.fixture(scope="module")
def rows(spark):
    return tables.labelled(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def model(rows):
    return training.train(training.pipeline("linear_svc", LEXICON), rows)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The message log in five files."""
    path = str(tmp_path_factory.mktemp("log") / "messages")
    sent = msg.messages(tables.load(spark, SF_DIR, "conversations"), ["conv_id", "turn"])
    msg.publish(sent.repartition(5, "key"), path=path)
    return path


def keyed(df):
    return sorted((r["key"], r["value"], r["sentiment"]) for r in df.collect())


def test_fixed_settings(spark):
    def get(name, *params):
        c = training.classifier(name)
        return tuple(c.getOrDefault(p) for p in params)

    assert get("naive_bayes", "smoothing", "modelType") == (1.0, "multinomial")
    assert get("linear_svc", "maxIter", "regParam") == (10, 0.1)
    assert get("logistic_regression", "maxIter", "regParam") == (10, 0.0)
    assert get("logistic_elasticnet", "maxIter", "regParam", "elasticNetParam") == (100, 0.3, 0.8)
    assert get("random_forest", "numTrees", "featuresCol") == (10, "indexedFeatures")
    stages = training.pipeline("random_forest", LEXICON).getStages()
    assert [s.getOutputCol() for s in stages[:7]] == [
        "tweet", "words", "filtered", "lemmatized", "tf", "features", "indexedFeatures"
    ]
    assert [s.getOutputCol() for s in training.feature_stages("hash")] == ["ngrams", "tf", "features"]
    assert training.feature_stages("hash")[1].getNumFeatures() == 1 << 18
    assert training.feature_stages()[0].getVocabSize() == 1 << 18


def test_train_is_the_plain_pipeline_fit(rows, model):
    plain = training.pipeline("linear_svc", LEXICON).fit(rows)
    columns = ["doc_id", "prediction"]
    assert sorted(model.transform(rows).select(columns).collect()) == sorted(
        plain.transform(rows).select(columns).collect()
    )


@pytest.mark.parametrize("name", ["logistic_elasticnet", "linear_svc"])
def test_solver_finds_the_optimum(spark, name):
    """The objective at the solution is no worse than where an independent descent ends."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 4))
    y = (x @ [2.0, -1.0, 0.5, 0.0] + draw.normal(size=300) > 0).astype(int)
    rows = spark.createDataFrame([(int(k), Vectors.dense(v)) for k, v in zip(y, x)], ["label", "features"])
    found = training.classifier(name).setMaxIter(500).setTol(1e-12).fit(rows)
    scale = x.std(axis=0, ddof=1)
    sign = 2 * y - 1

    def objective(w, b):
        margin = sign * (x @ w + b)
        if name == "linear_svc":
            return np.maximum(0, 1 - margin).mean() + 0.05 * ((w * scale) ** 2).sum()
        return np.logaddexp(0, -margin).mean() + 0.3 * (0.8 * np.abs(w * scale).sum() + 0.1 * ((w * scale) ** 2).sum())

    best = objective(np.zeros(4), 0.0)
    w, b = np.zeros(4), 0.0
    for step in range(6_000):
        size = 0.5 / (1 + step / 100)
        for at in range(5):
            for move in (size, -size):
                w2, b2 = w.copy(), b
                if at < 4:
                    w2[at] += move
                else:
                    b2 += move
                value = objective(w2, b2)
                if value < best:
                    best, w, b = value, w2, b2
        if size < 0.01 and step > 5_000:
            break
    assert objective(found.coefficients.toArray(), found.intercept) <= best + 1e-4


def test_features_learned_from_a_wider_corpus(rows):
    train = rows.filter("doc_id % 2 = 0")
    estimator = training.pipeline("naive_bayes", LEXICON)
    wide, narrow = training.train(estimator, train, corpus=rows), training.train(estimator, train)
    assert wide.stages[-1].theta.numRows == narrow.stages[-1].theta.numRows == 2
    assert set(narrow.stages[-3].vocabulary) < set(wide.stages[-3].vocabulary)
    assert wide.stages[-2].numDocs == rows.count() and narrow.stages[-2].numDocs == train.count()


def test_contractions_are_part_of_the_saved_model(spark, tmp_path):
    stage = TextCleaner(inputCol="text", outputCol="tweet", expandContractions=True)
    res.save_model(stage, str(tmp_path / "s"))
    frame = spark.createDataFrame([("I don't",), (None,)], "text string")
    assert [r["tweet"] for r in TextCleaner.load(str(tmp_path / "s")).transform(frame).collect()] == ["I do not"]


def test_save_and_load(spark, rows, model, tmp_path):
    for _ in range(2):  # overwrites
        res.save_model(model, str(tmp_path / "pipeline"))
    loaded = res.load_pipeline(str(tmp_path / "pipeline"))
    assert isinstance(loaded, PipelineModel)
    assert next(s for s in loaded.stages if isinstance(s, Lemmatizer)).getOrDefault("lexicon") == LEXICON
    columns = ["doc_id", "prediction"]
    assert sorted(loaded.transform(rows).select(columns).collect()) == sorted(
        model.transform(rows).select(columns).collect()
    )


def test_cross_validation(spark, rows, tmp_path):
    folds = sampling.assign_folds(rows.select("doc_id", "label"), 3, "doc_id").select("doc_id", "fold")
    folded = rows.join(folds, "doc_id")
    grid = (0.5, 1.0)
    found, fixed = training.cross_validate(
        folded, [], "fold", folds=3, smoothings=grid, features="count", expand_contractions=False
    )
    # The relational grid gives the same accuracies and the same choice.
    counted = features.with_counts(folded, model_tokens(F.col("text")), "doc_id", "label", "fold")
    relational = bayes.fit(counted, smoothings=grid, fold="fold", folds=3)
    table = bayes.grid_accuracy(relational.score(counted, "doc_id", "label", "fold", view="fold")).collect()
    assert [r["accuracy"] for r in sorted(table)] == pytest.approx(list(found.avgMetrics))
    chosen = found.bestModel.stages[-1].getOrDefault("smoothing")
    assert [r["smoothing"] for r in table if r["best"]] == [chosen]
    res.save_model(found, str(tmp_path / "cv"))
    again = CrossValidatorModel.load(str(tmp_path / "cv"))
    tokens = folded
    for stage in fixed:
        tokens = stage.transform(tokens)
    assert again.transform(tokens).count() == rows.count()
    res.save_model(found.bestModel.stages[-1], str(tmp_path / "nb"))
    assert NaiveBayesModel.load(str(tmp_path / "nb")).getOrDefault("smoothing") == chosen


def test_folds_learn_their_weights_once(spark, monkeypatch):
    """The grid shares them; a row without a valid fold, or a fold without rows, is an error."""
    learned = []
    own = training.IDF.fit
    monkeypatch.setattr(training.IDF, "fit", lambda *a, **k: learned.append(1) or own(*a, **k))
    lines = [(i % 2, f"{'good' if i % 2 else 'bad'} day {chr(97 + i % 7)}", i % 3) for i in range(30)]
    rows = spark.createDataFrame(lines, "label int, text string, fold int")
    found, _ = training.cross_validate(rows, [], "fold", folds=3, smoothings=(0.5, 1.0, 2.0))
    assert list(found.avgMetrics) == [1.0, 1.0, 1.0] and len(learned) == 3 + 1
    for wrong in (F.lit(3), F.lit(None).cast("int"), F.lit(0)):
        with pytest.raises(Exception, match="(?i)fold"):
            training.cross_validate(rows.withColumn("fold", wrong), [], "fold", folds=3)


def test_stream_scores_like_the_batch(spark, model, log, tmp_path):
    batch = keyed(st.score(model, spark.read.parquet(log)))
    where = str(tmp_path)
    stream = msg.subscribe(spark, path=log, files_per_trigger=2)
    query = st.write_results(st.score(model, stream), f"{where}/results", f"{where}/progress", available_now=True)
    query.awaitTermination()
    results = res.read_results(spark, f"{where}/results")
    assert keyed(results) == batch
    assert results.select("batch_id").distinct().count() == 3
    raw = {r["key"]: r["value"] for r in msg.decode(spark.read.parquet(log)).collect()}
    assert {r["key"]: r["value"] for r in results.collect()} == raw  # the original text


def test_restart_goes_on_and_a_repeated_batch_leaves_no_duplicates(spark, model, log, tmp_path):
    where = str(tmp_path)
    copy = f"{where}/log"
    all_messages = spark.read.parquet(log)
    first, second = all_messages.filter("cast(key as string) < '3'"), all_messages.filter("cast(key as string) >= '3'")

    def run():
        scored = st.score(model, msg.subscribe(spark, path=copy))
        st.write_results(scored, f"{where}/results", f"{where}/progress", available_now=True).awaitTermination()

    msg.publish(first, path=copy)
    run()
    assert spark.read.parquet(f"{where}/results").count() == first.count()
    msg.publish(second, path=copy)
    run()
    run()
    assert keyed(res.read_results(spark, f"{where}/results")) == keyed(st.score(model, all_messages))
    # Without the record of the last commit the batch runs again, into the same folder.
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert keyed(res.read_results(spark, f"{where}/results")) == keyed(st.score(model, all_messages))


def test_stream_with_a_lexicon_table(spark, rows, log, tmp_path):
    """Scored batch by batch, with the table that was saved with the model."""
    spark.createDataFrame([(w,) for w in LEXICON], "lemma string").write.parquet(str(tmp_path / "lexicon"))
    trained = training.train(training.pipeline("naive_bayes", str(tmp_path / "lexicon")), rows)
    res.save_model(trained, str(tmp_path / "model"))
    loaded = res.load_pipeline(str(tmp_path / "model"))
    where = str(tmp_path)
    st.write_scored(loaded, msg.subscribe(spark, path=log), f"{where}/results", f"{where}/progress", available_now=True).awaitTermination()
    assert keyed(res.read_results(spark, f"{where}/results")) == keyed(st.score(trained, spark.read.parquet(log)))
    stage = next(s for s in loaded.stages if isinstance(s, LearnedLemmas))
    plain = f"{where}/plain"
    scored = st.score(loaded, msg.subscribe(spark, path=log))  # small tables: a stream is one plan
    st.write_results(scored, plain, f"{where}/plain-progress", available_now=True).awaitTermination()
    assert keyed(res.read_results(spark, plain)) == keyed(res.read_results(spark, f"{where}/results"))
    stage.set(stage.inRow, 0)  # larger tables are joined, batch by batch
    with pytest.raises(ValueError, match="write_scored"):
        st.score(loaded, msg.subscribe(spark, path=log))
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(root.iterdir())
    st.write_scored(loaded, msg.subscribe(spark, path=log, files_per_trigger=2), f"{where}/joined", f"{where}/joined-progress", available_now=True).awaitTermination()
    assert keyed(res.read_results(spark, f"{where}/joined")) == keyed(res.read_results(spark, f"{where}/results"))
    assert set(root.iterdir()) == before  # a batch's tables are gone


def test_a_batch_is_one_job(spark, rows, log, tmp_path):
    """No job for lemmas per batch: the write alone, which reads the batch once."""
    where = str(tmp_path)
    spark.createDataFrame([(w,) for w in LEXICON], "lemma string").write.parquet(f"{where}/lexicon")
    model = training.train(training.pipeline("naive_bayes", f"{where}/lexicon"), rows)
    warm = st.score(model, spark.read.parquet(log))
    warm.write.parquet(f"{where}/warm")
    query = st.write_scored(model, msg.subscribe(spark, path=log, files_per_trigger=2), f"{where}/r", f"{where}/p", available_now=True)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in progress) == spark.read.parquet(log).count()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    assert len(jobs) == len(progress) == 3


@pytest.mark.parametrize("pos", ["n", "r"])
def test_learned_lemmas_both_ways(spark, tmp_path, pos):
    """Words met in training or not, inside the row or joined: as changed_lemmas on all distinct words has it."""
    words = ["dogs", "dogsss", "day", "days", "men", "ran", "running", "ies", "", "this", "churches", "better", "wolves"]
    lexicon = ["dog", "day", "man", "run", "church", "wolf", "well", "thi"]
    table = str(tmp_path / "lexicon")
    spark.createDataFrame([(w,) for w in [*lexicon, "dog", None, ""]], "lemma string").write.parquet(table)
    frame = spark.createDataFrame([(1, words), (2, []), (3, None), (4, [None, "days", "days"]), (1, words)], "id int, a array<string>")
    irregular = [f"{f} {l}" for p, f, l in IRREGULAR if p == pos]
    for seen in (frame.filter("id = 4"), frame.filter("id = 9")):
        model = LemmaLearner(inputCol="a", outputCol="b", lexiconPath=table, irregular=irregular, pos=pos).fit(seen)
        res.save_model(model, str(tmp_path / "stage"))
        for stage in [LearnedLemmas.load(str(tmp_path / "stage"))]:
            want = Lemmatizer(inputCol="a", outputCol="b", lexicon=lexicon, irregular=irregular, pos=pos).transform(frame)
            key = lambda df: sorted(map(repr, df.select("id", "a", "b").collect()))
            assert key(stage.transform(frame)) == key(want)
            stage.set(stage.inRow, 0)
            assert key(stage.transform(frame)) == key(want)


def test_forest_predicts_weights_it_has_not_seen(spark, rows):
    train, test = rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1")
    forest = training.train(training.pipeline("random_forest", LEXICON), train)
    assert len(forest.transform(test).select("doc_id", "prediction").collect()) == test.count()


def test_file_sink_and_console(spark, log, tmp_path):
    where = str(tmp_path)
    query = st.append_files(
        msg.decode(msg.subscribe(spark, path=log)), f"{where}/out", f"{where}/progress", available_now=True
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{where}/out").count() == spark.read.parquet(log).count()
    query = st.to_console(msg.subscribe(spark, path=log), available_now=True)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == spark.read.parquet(log).count()


def test_messages_without_text_have_no_sentiment(spark, model):
    rows = spark.createDataFrame([(bytearray(b"0"), None), (None, bytearray(b"good day"))], msg.MESSAGE_SCHEMA)
    got = {(r["key"], r["value"]): r["sentiment"] for r in st.score(model, rows).collect()}
    assert got.keys() == {("0", None), (None, "good day")}
    assert got["0", None] is None and got[None, "good day"] in ("positive", "negative")


def test_from_csv_to_scored_messages(spark, log, tmp_path):
    """The example of the README, with files in place of a topic."""
    lines = "\n".join(f'{4 * (i % 2)},{i},d,f,u,"{"good" if i % 2 else "bad"} day {i}"' for i in range(200))
    (tmp_path / "corpus.csv").write_text(lines, encoding="latin-1")
    rows = corpus.project_labelled(corpus.read_corpus_latin1(spark, str(tmp_path / "corpus.csv")))
    train, test = sampling.split(rows, 0.8, seed=7)
    model = training.train(training.pipeline("linear_svc", LEXICON, text="tweet"), train)
    counts = metrics.outcome_counts(model.transform(test))
    assert metrics.accuracy(counts).first()["accuracy"] == 1.0
    res.write_report(str(tmp_path / "report"), matrix=metrics.confusion_matrix(counts))
    res.save_model(model, str(tmp_path / "model"))
    scored = st.score(res.load_pipeline(str(tmp_path / "model")), msg.subscribe(spark, path=log), "tweet")
    st.write_results(scored, str(tmp_path / "results"), str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert res.read_results(spark, str(tmp_path / "results")).count() == spark.read.parquet(log).count()
