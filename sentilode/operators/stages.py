"""Pipeline stages that are saved and loaded with the model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import CountVectorizerModel, VectorIndexer, VectorIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import DataFrame, functions as F

from sentilode.functions import text as tx
from sentilode.functions.arrays import let, word_map, word_set
from sentilode.operators.features import VOCABULARY_SIZE, term_stats, vocabulary, with_counts
from sentilode.operators.lemma import IN_ROW_LEMMAS, IRREGULAR, candidates, changed_lemmas, rule_ending, with_lemmas
from sentilode.session import materialize, scratch_path

LEXICON_SCHEMA = "lemma string"
LEARNED_SCHEMA = "term string, lemma string"


class TextCleaner(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """The clean chain; drops rows without text, which the tokeniser cannot take."""

    expandContractions = Param(
        Params._dummy(), "expandContractions", "expand contractions after cleaning",
        TypeConverters.toBoolean,
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, expandContractions=False):
        super().__init__()
        self._setDefault(expandContractions=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cleaned = tx.clean(F.col(self.getInputCol()))
        if self.getOrDefault(self.expandContractions):
            cleaned = tx.expand_contractions_words(cleaned)
        return dataset.filter(F.col(self.getInputCol()).isNotNull()).withColumn(
            self.getOutputCol(), cleaned
        )


class _LemmatizerWriter(DefaultParamsWriter):
    """Saves the lexicon table in the stage's own folder."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        table = self.instance.getOrDefault(self.instance.lexiconPath)
        if table:
            self.sparkSession.read.schema(LEXICON_SCHEMA).parquet(table).write.parquet(f"{path}/lexicon")


class _LemmatizerReader(DefaultParamsReader):
    """Loads a stage; its lexicon is the table in its folder."""

    def load(self, path: str) -> Lemmatizer:
        stage = super().load(path)
        if stage.getOrDefault(stage.lexiconPath):
            stage._set(lexiconPath=f"{path}/lexicon")
        return stage


class Lemmatizer(Transformer, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """Lemma of each token, without the empty ones.

    The lexicon is a table of any size (`lexiconPath`, with a column `lemma`) or a short list of words. A batch has the
    lemmas of its distinct words found by joins, as in operators.lemma, and looked up for each token. A stream
    cannot be joined with its own words: score it batch by batch (streaming.score.write_scored), or with a list, which is
    looked up inside the row.
    """

    lexicon = Param(Params._dummy(), "lexicon", "known lemmas", TypeConverters.toListString)
    lexiconPath = Param(Params._dummy(), "lexiconPath", "Parquet table of known lemmas", TypeConverters.toString)
    irregular = Param(
        Params._dummy(), "irregular", "`form lemma` of each irregular form", TypeConverters.toListString
    )
    pos = Param(Params._dummy(), "pos", "part of speech: n, v, a or r", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, lexicon=None, lexiconPath=None, irregular=None, pos="n"):
        super().__init__()
        self._setDefault(
            lexicon=[], lexiconPath="", pos="n", irregular=[f"{f} {l}" for p, f, l in IRREGULAR if p == "n"]
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> _LemmatizerWriter:
        return _LemmatizerWriter(self)

    @classmethod
    def read(cls) -> _LemmatizerReader:
        return _LemmatizerReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        output = self.getOutputCol()
        filled = dataset.withColumn(output, F.filter(F.col(self.getInputCol()), lambda w: F.length(w) > 0))
        if dataset.isStreaming:
            return self._in_row(filled)
        spark = dataset.sparkSession
        pos, path = self.getOrDefault(self.pos), self.getOrDefault(self.lexiconPath)
        if path:
            known = spark.read.schema(LEXICON_SCHEMA).parquet(path)
        else:
            known = spark.createDataFrame([(w,) for w in self.getOrDefault(self.lexicon)], LEXICON_SCHEMA)
        pairs = [tuple(line.split(" ")) for line in self.getOrDefault(self.irregular)]
        irregular = spark.createDataFrame(pairs, "form string, lemma string").withColumn("pos", F.lit(pos))
        terms = filled.select(F.explode(F.array_distinct(output)).alias("term")).distinct()
        changed = changed_lemmas(terms, known.withColumn("pos", F.lit(pos)), irregular, pos)
        changed = materialize(changed, "stage-lemmas")
        return with_lemmas(filled.withColumnRenamed(output, "_tokens"), "_tokens", changed, output).drop("_tokens")

    def _in_row(self, dataset: DataFrame) -> DataFrame:
        if self.getOrDefault(self.lexiconPath):
            raise ValueError("a lexicon table needs batches: score the stream with streaming.score.write_scored")
        known, pos = self.getOrDefault(self.lexicon), self.getOrDefault(self.pos)
        irregular: dict[str, list[str]] = {}
        for line in self.getOrDefault(self.irregular):
            form, lemma = line.split(" ")
            irregular.setdefault(form, []).append(lemma)
        forms = sorted(irregular)
        lemmas = F.map_from_arrays(
            F.array(*map(F.lit, forms)).cast("array<string>"),
            F.array(*[F.array(*map(F.lit, sorted(irregular[f]))) for f in forms]).cast(
                "array<array<string>>"
            ),
        )
        in_lexicon = word_set(known)
        longest = max(map(len, known), default=0)

        def lemma(word):
            special = F.when(word.isin(forms), F.element_at(lemmas, word))
            tried = F.filter(candidates(word, special, pos, longest), lambda c: in_lexicon(c["form"]))
            return F.coalesce(F.array_min(tried)["form"], word)

        output = self.getOutputCol()
        return dataset.withColumn(output, F.transform(output, lambda w: let(w, lemma)))


class _LemmaParams(HasInputCol, HasOutputCol):
    """What learning and applying lemmas share."""

    irregular = Param(
        Params._dummy(), "irregular", "`form lemma` of each irregular form", TypeConverters.toListString
    )
    pos = Param(Params._dummy(), "pos", "part of speech: n, v, a or r", TypeConverters.toString)
    inRow = Param(Params._dummy(), "inRow", "most words that are looked up inside the row", TypeConverters.toInt)

    def _irregular_pairs(self) -> list[tuple[str, str]]:
        return [tuple(line.split(" ")) for line in self.getOrDefault(self.irregular)]

    def _irregular_table(self, spark) -> DataFrame:
        pairs = spark.createDataFrame(self._irregular_pairs(), "form string, lemma string")
        return pairs.withColumn("pos", F.lit(self.getOrDefault(self.pos)))

    def _needs_work(self, word):
        """Whether a word can have another lemma: it ends as a rule asks, or is irregular."""
        return word.rlike(rule_ending(self.getOrDefault(self.pos))) | word.isin([f for f, _ in self._irregular_pairs()])


class LemmaLearner(Estimator, _LemmaParams, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the lemmas of the distinct words of its input once, by joins with a lexicon table of any size.

    Only words that a rule or an irregular form could change are kept. Null arrays and null or empty words teach nothing; an empty
    input gives a model that knows rules and lexicon alone.
    """

    lexiconPath = Param(Params._dummy(), "lexiconPath", "Parquet table of known lemmas", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, lexiconPath=None, irregular=None, pos="n", inRow=IN_ROW_LEMMAS):
        super().__init__()
        self._setDefault(pos="n", inRow=IN_ROW_LEMMAS, irregular=[f"{f} {l}" for p, f, l in IRREGULAR if p == "n"])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LearnedLemmas:
        spark, pos = dataset.sparkSession, self.getOrDefault(self.pos)
        known = spark.read.schema(LEXICON_SCHEMA).parquet(self.getOrDefault(self.lexiconPath))
        terms = dataset.select(F.explode(F.array_distinct(self.getInputCol())).alias("term")).filter(F.length("term") > 0)
        terms = materialize(terms.filter(self._needs_work(F.col("term"))).distinct(), "learner-terms")
        changed = changed_lemmas(terms, known.withColumn("pos", F.lit(pos)), self._irregular_table(spark), pos)
        found = terms.join(changed, "term", "left").select("term", F.coalesce("lemma", "term").alias("lemma"))
        paths = [scratch_path(spark, name) for name in ("learned-lemmas", "learned-lexicon")]
        found.write.parquet(paths[0])
        known.filter(F.length("lemma") > 0).distinct().write.parquet(paths[1])
        learned = spark.read.schema(LEARNED_SCHEMA).parquet(paths[0])
        lexicon = spark.read.schema(LEXICON_SCHEMA).parquet(paths[1])
        size = lexicon.agg(F.count("*").alias("n"), F.coalesce(F.max(F.length("lemma")), F.lit(0)).alias("longest")).first()
        # The literals of the lookup inside a row have words without a space.
        every = lexicon.select("lemma").union(learned.select(F.concat("term", "lemma")))
        spaced = not every.filter(F.col("lemma").contains(" ")).isEmpty()
        model = LearnedLemmas(
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
            learnedPath=paths[0],
            lexiconPath=paths[1],
            irregular=self.getOrDefault(self.irregular),
            pos=pos,
            inRow=self.getOrDefault(self.inRow),
            words=-1 if spaced else max(size["n"], learned.count()),
            longest=size["longest"],
        )
        return model._resetUid(self.uid)


class _LearnedWriter(DefaultParamsWriter):
    """Saves both tables in the stage's own folder."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for table, df in self.instance.tables(self.sparkSession).items():
            df.write.parquet(f"{path}/{table}")


class _LearnedReader(DefaultParamsReader):
    """Loads a stage; its tables are those in its folder."""

    def load(self, path: str) -> LearnedLemmas:
        stage = super().load(path)
        return stage._set(learnedPath=f"{path}/learned", lexiconPath=f"{path}/lexicon")


class LearnedLemmas(Model, _LemmaParams, MLWritable, MLReadable):
    """Lemma of each token, without the empty ones, from what training has learned; other words go through the rules.

    What decides the way was measured at training, so no batch starts a job for it. While both tables hold at most `inRow`
    words, they are read once per model and looked up inside the row: a batch or a stream is one plan. Larger ones are joined with
    a batch that is first written, so its source is read once; a stream then needs streaming.score.write_scored. Both ways
    give the same rows. A null array stays null.
    """

    learnedPath = Param(Params._dummy(), "learnedPath", "Parquet table (term, lemma)", TypeConverters.toString)
    lexiconPath = Param(Params._dummy(), "lexiconPath", "Parquet table of known lemmas", TypeConverters.toString)
    words = Param(
        Params._dummy(), "words", "words in the larger table; -1 if one holds a space", TypeConverters.toInt
    )
    longest = Param(Params._dummy(), "longest", "length of the longest known lemma", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, learnedPath=None, lexiconPath=None, irregular=None, pos="n",
        inRow=IN_ROW_LEMMAS, words=-1, longest=0,
    ):
        super().__init__()
        self._lookups = None
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> _LearnedWriter:
        return _LearnedWriter(self)

    @classmethod
    def read(cls) -> _LearnedReader:
        return _LearnedReader(cls)

    def tables(self, spark) -> dict[str, DataFrame]:
        return {
            "learned": spark.read.schema(LEARNED_SCHEMA).parquet(self.getOrDefault(self.learnedPath)),
            "lexicon": spark.read.schema(LEXICON_SCHEMA).parquet(self.getOrDefault(self.lexiconPath)),
        }

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = dataset.withColumn(
            self.getOutputCol(), F.filter(F.col(self.getInputCol()), lambda w: F.length(w) > 0)
        )
        if 0 <= self.getOrDefault(self.words) <= self.getOrDefault(self.inRow):
            return self._in_row(filled)
        if dataset.isStreaming:
            raise ValueError("tables of this size need batches: score the stream with streaming.score.write_scored")
        return self._joined(filled)

    def _in_row(self, filled: DataFrame) -> DataFrame:
        if self._lookups is None:
            read = {name: df.collect() for name, df in self.tables(filled.sparkSession).items()}
            self._lookups = word_map({r["term"]: r["lemma"] for r in read["learned"]}), word_set(r["lemma"] for r in read["lexicon"])
        learned, in_lexicon = self._lookups
        irregular: dict[str, list[str]] = {}
        for form, lemma in self._irregular_pairs():
            irregular.setdefault(form, []).append(lemma)
        special_of = word_map({form: ",".join(sorted(set(lemmas))) for form, lemmas in irregular.items()})
        pos, longest = self.getOrDefault(self.pos), self.getOrDefault(self.longest)

        def by_rules(word):
            tried = F.filter(
                candidates(word, F.split(special_of(word), ","), pos, longest), lambda c: in_lexicon(c["form"])
            )
            return F.array_min(tried)["form"]

        output = self.getOutputCol()
        lemma = lambda w: F.coalesce(learned(w), F.when(self._needs_work(w), by_rules(w)), w)
        return filled.withColumn(output, F.transform(output, lambda w: let(w, lemma)))

    def _joined(self, filled: DataFrame) -> DataFrame:
        spark, output, pos = filled.sparkSession, self.getOutputCol(), self.getOrDefault(self.pos)
        tables = self.tables(spark)
        rows = materialize(filled, "batch-tokens")
        terms = rows.select(F.explode(F.array_distinct(output)).alias("term"))
        terms = terms.filter(self._needs_work(F.col("term"))).distinct().join(tables["learned"], "term", "left_anti")
        new = changed_lemmas(
            terms, tables["lexicon"].withColumn("pos", F.lit(pos)), self._irregular_table(spark), pos,
            longest=self.getOrDefault(self.longest),
        )
        changed = tables["learned"].filter(F.col("term") != F.col("lemma")).unionByName(new.select("term", "lemma"))
        changed = materialize(changed, "batch-lemmas")
        renamed = rows.withColumnRenamed(output, "_tokens")
        return with_lemmas(renamed, "_tokens", changed, output, self.getOrDefault(self.inRow)).drop("_tokens").select(*filled.columns)


def count_model(spark, terms: list[str], input_column: str, output_column: str) -> CountVectorizerModel:
    """`CountVectorizerModel.from_vocabulary`, but the terms go to the JVM as one text and not in a call for each."""
    end = next((c for c in "\n\0" if not any(c in term for term in terms)), None)
    if end is None:
        return CountVectorizerModel.from_vocabulary(terms, input_column, output_column)
    array = spark._jvm.java.util.regex.Pattern.compile(end).split(end.join(terms), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    model.setInputCol(input_column).setOutputCol(output_column)
    return model._set(vocabSize=len(terms))


class VocabularyLearner(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the most frequent terms and gives the count vectoriser's model with them.

    Terms are counted by group-bys into a table, and counts per power of two bound the first `vocabSize`, so neither a task nor the
    driver holds more than about these. Ties go to the first term, so runs agree. Null arrays and null tokens teach
    nothing; without any term there is no model.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "most terms to learn", TypeConverters.toInt)
    minDocs = Param(Params._dummy(), "minDocs", "fewest documents with a term", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, vocabSize=VOCABULARY_SIZE, minDocs=1):
        super().__init__()
        self._setDefault(vocabSize=VOCABULARY_SIZE, minDocs=1)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getVocabSize(self) -> int:
        return self.getOrDefault(self.vocabSize)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        counted = with_counts(dataset, F.col(self.getInputCol()))
        stats = materialize(term_stats(counted), "vocabulary-stats")
        first = vocabulary(stats, self.getVocabSize(), self.getOrDefault(self.minDocs))
        terms = [r["term"] for r in first.select("term").collect()]  # `vocabSize` rows, in order
        if not terms:
            raise ValueError("no terms to learn")
        return count_model(dataset.sparkSession, terms, self.getInputCol(), self.getOutputCol())


class ValueIndexer(VectorIndexer):
    """The vector indexer, learned from the entries that vectors store. Its model is Spark's, the same as Spark's own fit gives.

    That fit looks at every feature of every vector and holds a set of values for each feature in each task. What it learns are the
    distinct values of features that have at most `maxCategories`. So these are found by group-bys, and Spark's fit sees a few dense
    vectors that have the same values: as many as the most values of a feature, `maxCategories` + 1 at most. NaN and minus zero,
    which Spark's sets do not count as group-bys do, are left to Spark's fit of all rows.
    """

    def _fit(self, dataset: DataFrame) -> VectorIndexerModel:
        most, name = self.getMaxCategories(), self.getInputCol()
        v = F.unwrap_udt(name)
        stored = F.arrays_zip(
            F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)).alias("index"), v["values"].alias("value")
        )
        # Each vector adds an entry at -1, its size, so vectors are counted in the same pass.
        size = F.struct(F.lit(-1).alias("index"), F.coalesce(v["size"], F.size(v["values"])).cast("double").alias("value"))
        entries = dataset.select(F.inline(F.concat(F.array(size), stored)))
        minus_zero = (F.col("value") == 0) & (F.col("value").cast("string") == "-0.0")
        found = entries.groupBy("index", "value", (F.isnan("value") | minus_zero).alias("odd")).agg(F.count("*").alias("n"))
        found = materialize(found, "indexer-values")
        sizes = found.filter("index = -1 OR odd").limit(2).collect()
        if len(sizes) != 1 or sizes[0]["index"] != -1 or sizes[0]["value"] < 1:
            return super()._fit(dataset)  # odd values; or no vectors or unequal ones, which are Spark's own errors
        features, rows = int(sizes[0]["value"]), sizes[0]["n"]
        counted = found.filter("index >= 0").groupBy("index").agg(
            F.sum("n").alias("n"), F.count("*").alias("distinct")
        )
        few = counted.filter(F.col("distinct") <= most)
        listed = found.join(few.select("index"), "index").groupBy("index").agg(F.collect_list("value").alias("values"))
        values = F.coalesce("values", F.array().cast("array<double>"))
        values = F.when(F.coalesce("n", F.lit(0)) < rows, F.array_union(values, F.array(F.lit(0.0)))).otherwise(values)
        # Any values serve for a feature with too many of them.
        many = F.transform(F.sequence(F.lit(0), F.lit(most)), lambda k: k.cast("double"))
        every = (
            dataset.sparkSession.range(features).select(F.col("id").cast("int").alias("index"))
            .join(counted, "index", "left").join(listed, "index", "left")
            .select("index", F.when(F.col("distinct") > most, many).otherwise(values).alias("values"))
        )
        wide = every.agg(F.sort_array(F.collect_list(F.struct("index", "values"))).alias("all"), F.max(F.size("values")).alias("most"))
        line = F.transform("all", lambda f: F.element_at(f["values"], F.least(F.col("k"), F.size(f["values"]))))
        covering = materialize(
            wide.select("all", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("k")).select(line.alias("line")), "indexer-cover"
        )
        return super()._fit(covering.select(array_to_vector("line").alias(name)))
