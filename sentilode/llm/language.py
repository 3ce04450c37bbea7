"""Language of a text by interpolated Kneser-Ney models of characters, one per language, in sorted hash arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilode.llm.common import slices, spread_texts
from sentilode.session import materialize

# Characters of an n-gram: the predicted one and those before it in its word.
ORDER = 5
# Not letters: what stands before a word as often as an n-gram needs, and what ends it.
PAD, END = "\x00", "\x01"
# Fixed value: the number of code points, over which a model without counts spreads evenly.
CODE_POINTS = 0x110000
# Logarithms are kept as integers of this part, so that sums do not depend on their order.
UNIT = 1 << 16
# A model is sent out in slices of at most so many bytes, each to all executors in turn.
SLICE_BYTES = 64 << 20
ENTRY_BYTES = 12
# One in so many of the documents to learn from teaches how sure an answer is; the others are counted.
CALIBRATION_PART = 8
# A text is rejected if its letters are less expected than those of all but this part of texts of its language.
QUANTILE = 0.999
UNKNOWN = "und"
# N-grams that a task keeps before it sends or forgets them.
TASK_GRAMS = 1_000_000
BATCH_BYTES = 4 << 20
NOT_LETTERS = r"[^\p{L}\p{M}]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)

Batches = Iterator[pa.RecordBatch]


def held_out(doc_id: Column) -> Column:
    """Rows that the models must not learn from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MIX
    return h ^ (h >> _SHIFT)


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def hashes(symbols: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """At k - 1 the hash of the k symbols that end at each place; the first k - 1 places mean nothing."""
    one = symbols.astype(np.uint64) + np.uint64(1)
    rolling, out, scale = one.copy(), [], np.uint64(1)
    out.append(_mixed(rolling))
    with np.errstate(over="ignore"):
        for k in range(1, order):
            scale = scale * _BASE
            rolling = rolling.copy()
            rolling[k:] += one[:-k] * scale
            out.append(_mixed(rolling))
    return out


def words_of(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(word number of each word in order, the distinct words, number of words up to each text).

    A word is a run of letters and marks, in lower case.
    """
    lower = pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string()))
    split = pc.split_pattern(pc.replace_substring_regex(lower, NOT_LETTERS, " "), " ")
    bounds = split.offsets.to_numpy()
    found = pc.list_flatten(split)
    filled = pc.not_equal(found, "")
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    coded = found.filter(filled).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, coded.dictionary.to_pylist(), before[bounds - bounds[0]]


def laid_out(words: list[str], order: int = ORDER) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(all words with pads before and an end after each, their symbols, places of the predicted ones, word of each)."""
    text = "".join([f"{PAD * (order - 1)}{w}{END}" for w in words])
    symbols = _symbols(text)
    at = np.flatnonzero(symbols)
    return text, symbols, at, np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])


def _grams(lang_col: str, order: int) -> Callable[[Batches], Batches]:
    """(lang, gram, n): how often each n-gram of `order` symbols occurs, added up in each task."""

    def rows(counts: Counter) -> pa.RecordBatch:
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["lang", "gram", "n"])

    def run(batches: Batches) -> Batches:
        counts: Counter = Counter()
        for batch in slices(batches, BATCH_BYTES):
            codes, words, bounds = words_of(batch.column("text"))
            if not words:
                continue
            text, symbols, at, owner = laid_out(words, order)
            key = hashes(symbols, order)[-1][at]
            _, first, gram = np.unique(key, return_index=True, return_inverse=True)
            names = [text[p - order + 1:p + 1] for p in at[first].tolist()]
            langs = batch.column(lang_col).dictionary_encode()
            whose = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(bounds))
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                often = np.bincount(codes[whose == k], minlength=len(words))
                n = np.bincount(gram, weights=often[owner], minlength=len(first))
                for g in np.flatnonzero(n).tolist():
                    counts[lang, names[g]] += int(n[g])
            if len(counts) > TASK_GRAMS:
                yield rows(counts)
                counts.clear()
        if counts:
            yield rows(counts)

    return run


def gram_counts(docs: DataFrame, lang_col: str = "lang", order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang); a task sends each n-gram of a language once."""
    counted = docs.select("text", lang_col).mapInArrow(_grams(lang_col, order), "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _log(p: Column) -> Column:
    return F.round(F.log(p) * UNIT).cast("int")


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, kind, gram, value): the interpolated models of all languages from (lang, gram, n).

    The highest order is counted as it occurs, a lower one by how many symbols come before it. Each order's counts are
    lowered by one discount of the language, n1 / (n1 + 2 n2), and what that frees goes to the order below; below the first all code
    points are alike. Kind k has the logarithm of an n-gram's last symbol given the others; kind -k
    that of the freed part after a context of k - 1 symbols; kind 0 that of a symbol never seen.
    """
    levels = {order: materialize(counts.withColumnRenamed("n", "c"), "language-grams")}
    for k in range(order - 1, 0, -1):
        shorter = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        levels[k] = materialize(shorter, "language-grams")
    out, below = [], None
    for k in range(1, order + 1):
        seen = [F.count_if(F.col("c") == n) for n in (1, 2)]
        usual = F.when((seen[0] > 0) & (seen[1] > 0), seen[0] / (seen[0] + 2 * seen[1])).otherwise(0.5)
        discounts = levels[k].groupBy("lang").agg(usual.alias("d"))
        context = F.substring("gram", 1, k - 1)
        # A context has at most as many rows as there are symbols.
        same = Window.partitionBy("lang", "context")
        rows = (
            levels[k].withColumn("context", context)
            .withColumn("total", F.sum("c").over(same))
            .withColumn("types", F.count("*").over(same))
            .join(discounts, "lang")
            .withColumn("freed", F.col("d") * F.col("types") / F.col("total"))
        )
        own = (F.col("c") - F.col("d")) / F.col("total")
        if k == 1:
            rows = rows.withColumn("p", own + F.col("freed") / CODE_POINTS)
        else:
            rows = rows.withColumn("shorter", F.substring("gram", 2, k - 1)).join(below, ["lang", "shorter"])
            rows = rows.withColumn("p", own + F.col("freed") * F.col("p_shorter"))
        level = materialize(rows.select("lang", "gram", "context", "p", "freed"), "language-level")
        below = level.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("p_shorter"))
        out.append(level.select("lang", F.lit(k).alias("kind"), "gram", _log(F.col("p")).alias("value")))
        freed = level.select("lang", F.col("context").alias("gram"), "freed").distinct()
        part = F.col("freed") / CODE_POINTS if k == 1 else F.col("freed")
        out.append(freed.select("lang", F.lit(-k if k > 1 else 0).alias("kind"), "gram", _log(part).alias("value")))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _keys(n_slices: int) -> Callable[[Batches], Batches]:
    """The hash of each n-gram, and its slice: that of the last symbol before the predicted one, -1 if it is in all."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            grams, kind = batch.column("gram").to_pylist(), batch.column("kind").to_numpy(zero_copy_only=False)
            size = np.where(kind < 0, -kind - 1, kind).astype(np.int64)
            symbols = _symbols("".join(grams))
            end = np.cumsum(size)
            key, part = np.zeros(len(grams), np.uint64), np.full(len(grams), -1, np.int64)
            found = hashes(symbols, max(1, int(size.max()))) if len(symbols) else []
            for k in np.unique(size[size > 0]).tolist():
                rows = size == k
                key[rows] = found[k - 1][end[rows] - 1]
            for rows, back in ((kind > 1, 2), (kind < 0, 1)):
                if rows.any():
                    part[rows] = (found[0][end[rows] - back] % np.uint64(n_slices)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("kind"), pa.array(key.view(np.int64)), batch.column("value"), pa.array(part)],
                ["lang", "kind", "key", "value", "slice"],
            )

    return run


@dataclass
class Models:
    """Per language and kind the keys in order and their values: those of one slice out of `n_slices`."""

    langs: list[str]
    arrays: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]
    part: int = 0
    n_slices: int = 1
    order: int = ORDER

    def look_up(self, lang: int, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys there are, value of each, 0 without)."""
        known, values = self.arrays.get((lang, kind), (None, None))
        if known is None or not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        return there, np.where(there, values[at], 0)

    def logarithms(self, found: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """The logarithm of the symbol at each place in each language, 0 in the places of other slices."""
        out = np.zeros((len(at), len(self.langs)), np.int64)
        mine = np.flatnonzero(found[0][at - 1] % np.uint64(self.n_slices) == np.uint64(self.part))
        for lang in range(len(self.langs)):
            left = mine
            for k in range(self.order, 0, -1):
                there, value = self.look_up(lang, k, found[k - 1][at[left]])
                out[left[there], lang] += value[there]
                left = left[~there]
                if not len(left):
                    break
                if k > 1:
                    out[left, lang] += self.look_up(lang, -k, found[k - 2][at[left] - 1])[1]
                else:
                    out[left, lang] += self.arrays[lang, 0][1][0]
        return out


class Scorer:
    """Sums of logarithms per text; remembers the n-grams that a task has met."""

    def __init__(self, models: Models) -> None:
        self.models = models
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.values = np.zeros((0, len(self.models.langs)), np.int64)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(predicted symbols, sum per language) of each text."""
        codes, words, bounds = words_of(column)
        n_langs = len(self.models.langs)
        n_words = np.diff(bounds)
        if not words:
            return np.zeros(len(n_words), np.int64), np.zeros((len(n_words), n_langs), np.int64)
        _, symbols, at, owner = laid_out(words, self.models.order)
        found = hashes(symbols, self.models.order)
        keys, first, gram = np.unique(found[-1][at], return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != keys[inside]
        if new.any():
            fresh = self.models.logarithms(found, at[first[new]])
            merged = np.concatenate([self.known, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.known, self.values = merged[order], np.concatenate([self.values, fresh])[order]
        values = self.values[np.searchsorted(self.known, keys)]
        if len(self.known) > TASK_GRAMS:
            self.forget()
        text_of = np.repeat(np.arange(len(n_words)), n_words)
        sizes = np.bincount(owner, minlength=len(words))
        # Whole numbers below 2**53: sums of doubles are exact.
        total = lambda part, into, n: np.bincount(into, weights=part, minlength=n)
        sums = np.empty((len(n_words), n_langs), np.int64)
        for lang in range(n_langs):
            per_word = total(values[gram, lang], owner, len(words))
            sums[:, lang] = total(per_word[codes], text_of, len(n_words))
        return total(sizes[codes], text_of, len(n_words)).astype(np.int64), sums


@dataclass
class Detector:
    """What is learned: models in slices, and how sure an answer is."""

    langs: list[str]
    slices: list[Models] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0
    # Per language the usual cross-entropy of a symbol, and the largest usual excess over it times the root of the length.
    usual: dict[str, tuple[float, float]] = field(default_factory=dict)


def pack(table: DataFrame, slice_bytes: int = SLICE_BYTES, order: int = ORDER) -> list[Models]:
    """The models of (lang, kind, gram, value) as sorted hash arrays, in as many slices as the measured size needs.

    What the driver holds at a time is one slice while it is fetched; slices wait in broadcast files when they are used.
    """
    table = materialize(table, "language-models")
    size = table.count() * ENTRY_BYTES
    n_slices = max(1, -(-size // slice_bytes))
    langs = [r[0] for r in table.select("lang").distinct().orderBy("lang").collect()]
    keyed = table.mapInArrow(_keys(n_slices), "lang string, kind int, key bigint, value int, slice bigint")
    if n_slices > 1:
        keyed = materialize(keyed, "language-keys")
    out = []
    for part in range(n_slices):
        own = keyed if n_slices == 1 else keyed.filter(F.col("slice").isin(-1, part))
        found = own.select("lang", "kind", "key", "value").toArrow()
        lang = pc.index_in(found.column("lang"), pa.array(langs, pa.string())).to_numpy()
        kind, key, value = (found.column(c).to_numpy() for c in ("kind", "key", "value"))
        key = key.view(np.uint64)
        rows = np.lexsort((key, kind, lang))
        lang, kind, key, value = lang[rows], kind[rows], key[rows], value[rows].astype(np.int32)
        begins = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (kind[1:] != kind[:-1])][:len(lang)])
        arrays = {
            (int(lang[a]), int(kind[a])): (key[a:b], value[a:b]) for a, b in zip(begins, np.append(begins[1:], len(lang)))
        }
        out.append(Models(langs, arrays, part, n_slices, order))
    return out


def _totals(shared: Broadcast, keep: list[str]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        scorer = Scorer(shared.value)
        for batch in slices(batches, BATCH_BYTES):
            text = batch.column("text")
            n, sums = scorer(text)
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False)
            offsets = np.arange(len(n) + 1, dtype=np.int32) * sums.shape[1]
            per_text = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], letters, pa.array(n, pa.int64()), per_text], [*keep, "letters", "n", "sums"]
            )

    return run


def totals(docs: DataFrame, detector: Detector, keep: list[str]) -> DataFrame:
    """(keep, letters, n, sums) of every row: has it a letter, its symbols, and the sum of their logarithms per language.

    One slice is one pass without a shuffle. With more, texts get a number, each pass sends a row of sums per text, and these are added up.
    """
    context = docs.sparkSession.sparkContext
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)
    tail = "letters boolean, n bigint, sums array<bigint>"
    if len(detector.slices) == 1:
        shared = context.broadcast(detector.slices[0])
        return docs.select(*keep, "text").mapInArrow(_totals(shared, keep), ", ".join([schema, tail]))
    texts = materialize(docs.select(*keep, "text").withColumn("_place", F.monotonically_increasing_id()), "language-texts")
    parts = None
    for models in detector.slices:
        shared = context.broadcast(models)
        own = texts.select("_place", "text").mapInArrow(_totals(shared, ["_place"]), f"_place bigint, {tail}")
        own = materialize(own, "language-sums")
        shared.destroy()
        parts = own if parts is None else parts.unionByName(own)
    each = [F.sum(F.get("sums", F.lit(k))).alias(f"_{k}") for k in range(len(detector.langs))]
    added = parts.groupBy("_place").agg(F.first("letters").alias("letters"), F.first("n").alias("n"), *each)
    sums = F.array(*[F.col(f"_{k}") for k in range(len(detector.langs))]).alias("sums")
    return texts.drop("text").join(added.select("_place", "letters", "n", sums), "_place").drop("_place")


def _answers(rows: DataFrame, detector: Detector) -> DataFrame:
    """Adds the likeliest language (of equal ones the first by name), its cross-entropy and how much it is ahead."""
    best = F.array_max("sums")
    named = F.array(*map(F.lit, detector.langs))
    second = F.get(F.sort_array("sums", False), F.lit(1))
    return (
        rows.withColumn("_lang", F.get(named, F.array_position("sums", best).cast("int") - 1))
        .withColumn("_entropy", -best / F.greatest(F.col("n"), F.lit(1)) / UNIT)
        .withColumn("_ahead", F.log1p(F.coalesce(best - second, F.lit(0)) / UNIT))
    )


def fit_sureness(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(slope, shift) of the chance to be right by how much an answer is ahead, from (ahead, right, wrong), by Newton steps."""
    # An answer that is not ahead at all is a toss: one right and one wrong there keep the chance below 1.
    x, right, wrong = (np.array(c, np.float64) for c in zip((0.0, 1, 1), *bins))
    design = np.stack([x, np.ones(len(x))])
    theta = np.array([0.0, np.log(right.sum() / wrong.sum())])
    loss = lambda at: float((right * np.logaddexp(0, -(at @ design)) + wrong * np.logaddexp(0, at @ design)).sum() + 1e-2 * at[0] ** 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ design, -500, 500)))
        slope = design @ ((right + wrong) * p - right) + np.array([2e-2 * theta[0], 0])
        curve = (design * ((right + wrong) * p * (1 - p))) @ design.T + np.diag([2e-2, 1e-9])
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
    return float(max(theta[0], 0.0)), float(theta[1])


def calibrate(docs: DataFrame, detector: Detector) -> None:
    """Learns from (text, lang) rows whose n-grams were not counted: sureness by bins, and per language what is usual."""
    rows = _answers(totals(docs, detector, ["lang"]).filter("letters"), detector)
    rows = materialize(rows.select("lang", "n", "_lang", "_entropy", "_ahead"), "language-calibration")
    at = F.round(F.col("_ahead") * 16) / 16
    right = F.col("lang") == F.col("_lang")
    bins = rows.groupBy(at.alias("ahead")).agg(F.count_if(right).alias("right"), F.count_if(~right).alias("wrong"))
    # The logarithm of a double is below 710, so there are few bins.
    detector.slope, detector.shift = fit_sureness(sorted(tuple(r) for r in bins.collect()))
    good = rows.filter(right)
    mean = good.groupBy("lang").agg((F.sum(F.col("_entropy") * F.col("n")) / F.sum("n")).alias("mean"))
    excess = (F.col("_entropy") - F.col("mean")) * F.sqrt("n")
    usual = good.join(mean, "lang").groupBy("lang", "mean").agg(F.percentile_approx(excess, QUANTILE, 10_000).alias("most"))
    detector.usual = {r["lang"]: (r["mean"], r["most"]) for r in usual.collect()}


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    slice_bytes: int = SLICE_BYTES, order: int = ORDER,
) -> Detector:
    """The detector learned from rows with a text and a language that are not held out.

    Seven of eight of them are counted, all of their words; the eighth, by a hash of the id and text, calibrates. A repeated row teaches
    as often as it is there. A null id is not held out. Without any row nothing is learned and every answer is `und`.
    """
    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = known.select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        (F.pmod(F.xxhash64(id_col, text_col, F.lit("calibration")), F.lit(CALIBRATION_PART)) == 0).alias("apart"),
    )
    counts = gram_counts(rows.filter(~F.col("apart")), "lang", order)
    models = pack(kneser_ney(counts, order), slice_bytes, order)
    detector = Detector(models[0].langs, models)
    if detector.langs:
        calibrate(rows.filter("apart"), detector)
    return detector


def detect(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cross_entropy, rejected) per input row, from the whole text alone.

    The language with the lowest cross-entropy per symbol; of equal ones the first by name. `score` is the chance that
    it is right, by how far it is ahead. `cross_entropy` is in nats. `rejected`, if the text is likelier wrong than right, or if its
    symbols are less expected than nearly all texts of that language have them, for its length: it is in no learned language.
    `lang_pred` names the nearest one all the same.

    A null text, or one without a letter, is `und` with score 0, without cross-entropy and rejected. Repeated
    rows get the same answer; a null id is kept and not held out; very long texts are scored whole; other
    columns are ignored; an empty table gives an empty one.
    """
    texts = spread_texts(docs, id_col, text_col)
    if not detector.langs:
        letters = F.lit(False)
        rows = texts.select("doc_id", letters.alias("letters"), F.lit("").alias("_lang"), F.lit(0.0).alias("_entropy"), F.lit(0.0).alias("_ahead"), F.lit(0).alias("n"))
    else:
        rows = _answers(totals(texts, detector, ["doc_id"]), detector)
    score = 1 / (1 + F.exp(-(F.col("_ahead") * detector.slope + detector.shift)))
    limit = F.lit(None).cast("double")
    for lang, (mean, most) in detector.usual.items():
        limit = F.when(F.col("_lang") == lang, F.lit(mean) + F.lit(most) / F.sqrt(F.greatest(F.col("n"), F.lit(1)))).otherwise(limit)
    unusual = F.coalesce(F.col("_entropy") > limit, F.lit(False))
    answered = F.col("letters")
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(answered, F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(answered, score).otherwise(0.0).alias("score"),
        F.when(answered, F.col("_entropy")).alias("cross_entropy"),
        (~answered | (score < 0.5) | unusual).alias("rejected"),
    )
