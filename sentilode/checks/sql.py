"""SQL fragments shared by the oracle texts."""

from __future__ import annotations

from sentilode.functions import patterns as P
from sentilode.operators.lemma import IRREGULAR, SUFFIX_RULES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    def cell(v) -> str:
        return quoted(v) if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)


def replace_all(expr: str, pattern: str) -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, '', 'g')"


def clean(expr: str) -> str:
    return replace_all(replace_all(replace_all(expr, P.SYMBOLS), P.LINK), P.MENTION)


def stop_list() -> str:
    return "(" + ", ".join(quoted(w) for w in P.ENGLISH_STOPWORDS) + ")"


def model_tokens(expr: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({clean(expr)}), {quoted(P.TOKEN_SPACE)}), "
        f"lambda t: length(t) > 0 AND t NOT IN {stop_list()})"
    )


def expanded_tokens(expr: str) -> str:
    """The model's tokens with contractions expanded after cleaning."""
    return (
        f"list_filter(regexp_split_to_array(lower({expand_words(clean(expr))}), {quoted(P.TOKEN_SPACE)}), "
        f"lambda t: length(t) > 0 AND t NOT IN {stop_list()})"
    )


def tokenize(expr: str) -> str:
    trimmed = f"rtrim(lower({expr}), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' ')"
    return f"regexp_split_to_array({trimmed}, {quoted(P.TOKEN_SPACE)})"


def treebank_tokens(expr: str) -> str:
    text = f"' ' || regexp_replace({expr}, {quoted('[' + P.SPACE + ']+')}, ' ', 'g') || ' '"
    for pattern, new in P.TREEBANK_RULES:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(new)}, 'g')"
    return f"list_filter(regexp_split_to_array({text}, '[ ' || chr(10) || ']+'), lambda w: length(w) > 0)"


def expanded(word: str) -> str:
    """One word by the contraction table, with the case of its first letter."""
    table = P.contraction_table()
    entries = ", ".join(f"{quoted(f)}: {quoted(t)}" for f, t in table.items())
    full = f"map_extract_value(MAP {{{entries}}}, lower({word}))"
    return (
        f"coalesce(CASE WHEN substr({word}, 1, 1) <> lower(substr({word}, 1, 1)) "
        f"THEN upper(substr({full}, 1, 1)) || substr({full}, 2) ELSE {full} END, {word})"
    )


def expand_words(expr: str) -> str:
    words = f"list_filter(regexp_split_to_array({expr}, {quoted(f'[{P.SPACE}]+')}), lambda w: length(w) > 0)"
    return f"array_to_string(list_transform({words}, lambda w: {expanded('w')}), ' ')"


def expand_text(expr: str) -> str:
    runs = f"regexp_extract_all({expr}, {quoted(P.CONTRACTION_RUN)}, 1)"
    return f"array_to_string(list_transform({runs}, lambda w: {expanded('w')}), '')"


def word_tokenize(expr: str) -> str:
    return f"regexp_extract_all({expr}, {quoted(P.WORD_OR_MARK)}, 1)"


def denoise_tokens(expr: str) -> str:
    lowered = f"list_transform({word_tokenize(expand_text(expr))}, lambda w: lower(w))"
    alpha = f"list_filter({lowered}, lambda w: regexp_matches(w, {quoted(P.ALPHABETIC)}))"
    return f"list_filter({alpha}, lambda w: w NOT IN {stop_list()})"


# The decorated text gives every cleaning step something to do in every row.
DECORATED = (
    "concat('@user', doc_id, ' ', text, ' http://ex.org/', doc_id, "
    "' www.a.b don''t Can''t', '❤\U0001f600')"
)

# Documents with a label.
LABELLED = "labelled AS (SELECT doc_id, quality AS label, text FROM documents JOIN labels USING (doc_id))"


def in_fraction(key: str, fraction: float) -> str:
    return f"substr(md5(CAST({key} AS VARCHAR)), 1, 8) < '{int(fraction * 2**32):08x}'"


def pairs(tokens: str, source: str, keep: str = "doc_id") -> str:
    """pairs(doc_id, term, tf)"""
    return (
        f"toks AS (SELECT {keep}, {tokens} AS toks FROM {source}), "
        f"pairs AS (SELECT {keep}, term, count(*) AS tf FROM "
        f"(SELECT {keep}, unnest(toks) AS term FROM toks) GROUP BY {keep}, term)"
    )


def lemma_ctes(tagged: str, lexicon: str) -> str:
    """lemma_of(term, pos, lemma) for `tagged` (term, pos) over `lexicon` (pos, lemma).

    Must be used under WITH RECURSIVE.
    """
    rules = [(p, i, old, new) for p, rs in SUFFIX_RULES.items() for i, (old, new) in enumerate(rs, 1)]
    return f"""
      rules(pos, i, old, new) AS ({values(rules)}),
      irregular(pos, form, lemma) AS ({values(IRREGULAR)}),
      tried(term, pos, form, pass, path) AS (
        SELECT term, pos, term, 0, CAST([] AS INTEGER[]) FROM {tagged}
        UNION ALL
        SELECT t.term, t.pos, left(t.form, length(t.form) - length(r.old)) || r.new,
               t.pass + 1, list_append(t.path, r.i)
        FROM tried t JOIN rules r ON r.pos = t.pos AND ends_with(t.form, r.old)
        WHERE length(t.form) - length(r.old) + length(r.new) > 0
          AND NOT EXISTS (SELECT 1 FROM irregular x WHERE x.pos = t.pos AND x.form = t.term)
      ),
      listed AS (
        SELECT t.term, t.pos, x.lemma AS form, 1 AS pass,
               [CAST(row_number() OVER (PARTITION BY t.term, t.pos ORDER BY x.lemma) AS INTEGER)] AS path
        FROM {tagged} t JOIN irregular x ON x.pos = t.pos AND x.form = t.term
      ),
      fitting AS (
        SELECT c.term, c.pos, c.form, row_number() OVER (
                 PARTITION BY c.term, c.pos ORDER BY greatest(c.pass, 1), length(c.form), c.path) AS rn
        FROM (SELECT * FROM tried UNION ALL SELECT * FROM listed) c
        WHERE (c.pos, c.form) IN (SELECT pos, lemma FROM {lexicon})
      ),
      lemma_of AS (
        SELECT t.term, t.pos, coalesce(f.form, t.term) AS lemma
        FROM {tagged} t LEFT JOIN fitting f ON f.term = t.term AND f.pos = t.pos AND f.rn = 1
      )"""


def murmur3(terms: str, buckets: int) -> str:
    """hashed(term, bucket) for the distinct terms of a relation: MurmurHash3 x86 32, seed 42."""
    word = 4294967296  # all arithmetic is modulo 2^32

    def rotated(x: str, n: int) -> str:
        return f"((({x}) << {n}) | (({x}) >> {32 - n})) % {word}"

    def mixed(k: str) -> str:
        return f"(({rotated(f'(({k}) * 3432918353) % {word}', 15)}) * 461845907) % {word}"

    def byte(i: str) -> str:
        digit = "instr('0123456789ABCDEF', substr(h, {at}, 1)) - 1"
        return f"(16 * ({digit.format(at=f'2 * ({i}) + 1')}) + {digit.format(at=f'2 * ({i}) + 2')})"

    def little_endian(start: str, count: str) -> str:
        return (
            f"coalesce(list_sum(list_transform(range(0, {count}), "
            f"lambda j: CAST({byte(f'{start} + j')} AS UBIGINT) << (8 * j))), 0)"
        )

    block = f"CAST({little_endian('4 * i', '4')} AS UBIGINT)"
    step = rotated(f"xor(x, {mixed('k')})", 13)
    return f"""
      hexed AS (SELECT DISTINCT term, hex(encode(term)) AS h, strlen(term) AS n FROM {terms}),
      blocked AS (
        SELECT term, n, list_transform(range(0, n // 4), lambda i: {block}) AS blocks,
               CAST({little_endian('n - n % 4', 'n % 4')} AS UBIGINT) AS tail
        FROM hexed),
      reduced AS (
        SELECT term, n, tail, list_reduce(list_concat([CAST(42 AS UBIGINT)], blocks),
               lambda x, k: ((({step}) * 5 + 3864292196) % {word})) AS x
        FROM blocked),
      ended AS (SELECT term, xor(xor(x, {mixed('tail')}), CAST(n AS UBIGINT)) AS x FROM reduced),
      final1 AS (SELECT term, (xor(x, x >> 16) * 2246822507) % {word} AS x FROM ended),
      final2 AS (SELECT term, (xor(x, x >> 13) * 3266489909) % {word} AS x FROM final1),
      hashed AS (SELECT term, CAST(xor(x, x >> 16) % {buckets} AS INTEGER) AS bucket FROM final2)"""


def naive_bayes(smoothings=(1.0,), buckets: int | str | None = None, weighted: bool = False) -> str:
    """pred(run, doc_id, label, s, raw0, raw1, prediction) and theta(run, label, s, term, idf, theta)

    from train(run, doc_id, label), test(run, doc_id, label), pairs(doc_id, term, tf).
    With `buckets` that many features exist, seen in training or not. If `weighted`, tf is a
    ready weight and takes no idf.
    """
    if buckets is None:
        seen, features = "seen JOIN sizes USING (run)", "count(*)"
    else:
        seen = (
            "(SELECT run, m, term, label, tf FROM sizes CROSS JOIN (SELECT DISTINCT term FROM pairs) "
            "LEFT JOIN seen USING (run, term))"
        )
        features = str(buckets)
    idf = "1.0" if weighted else "ln((m + 1.0) / (count(tf) + 1))"

    def log(x: str) -> str:
        return f"CASE WHEN {x} > 0 THEN ln({x}) ELSE CAST('-infinity' AS DOUBLE) END"

    smooth = values([(float(s),) for s in smoothings])
    return f"""
      smooth(s0) AS ({smooth}),
      grid AS (SELECT CAST(s0 AS DOUBLE) AS s, label FROM smooth, (VALUES (0), (1)) c(label)),
      sizes AS (SELECT run, count(*) AS m FROM train GROUP BY run),
      prior AS (
        SELECT z.run, g.s, g.label, {log("(n + g.s)")} - {log("(m + 2 * g.s)")} AS prior
        FROM (SELECT z.run, z.m, c.label, (SELECT count(*) FROM train t WHERE t.run = z.run AND t.label = c.label) AS n
              FROM sizes z, (VALUES (0), (1)) c(label)) z JOIN grid g ON g.label = z.label),
      seen AS (SELECT t.run, t.label, p.term, p.tf FROM train t JOIN pairs p USING (doc_id)),
      weights AS (
        SELECT run, term, {idf} AS idf,
               CAST(coalesce(sum(tf) FILTER (label = 0), 0) AS DOUBLE) AS n0,
               CAST(coalesce(sum(tf) FILTER (label = 1), 0) AS DOUBLE) AS n1
        FROM {seen} GROUP BY run, term, m),
      totals AS (SELECT run, {features} AS v, sum(idf * n0) AS w0, sum(idf * n1) AS w1 FROM weights GROUP BY run),
      theta AS (
        SELECT run, g.label, g.s, term, idf,
               {log("(idf * CASE WHEN g.label = 1 THEN n1 ELSE n0 END + g.s)")}
               - {log("(CASE WHEN g.label = 1 THEN w1 ELSE w0 END + v * g.s)")} AS theta
        FROM weights JOIN totals USING (run) CROSS JOIN grid g),
      scored AS (
        SELECT t.run, t.doc_id, t.label, q.s, q.label AS class, any_value(q.prior) + coalesce(sum(
                 CASE WHEN h.idf <> 0 THEN p.tf * h.idf * h.theta END), 0) AS raw
        FROM test t JOIN prior q ON q.run = t.run
        LEFT JOIN pairs p ON p.doc_id = t.doc_id
        LEFT JOIN theta h ON h.run = t.run AND h.term = p.term AND h.s = q.s AND h.label = q.label
        GROUP BY t.run, t.doc_id, t.label, q.s, q.label),
      pred AS (
        SELECT a.run, a.doc_id, a.label, a.s, a.raw AS raw0, b.raw AS raw1,
               CASE WHEN b.raw > a.raw THEN 1 ELSE 0 END AS prediction
        FROM scored a JOIN scored b ON b.run = a.run AND b.doc_id = a.doc_id AND b.s = a.s
        WHERE a.class = 0 AND b.class = 1)"""


FOLDS = (
    "folded AS (SELECT doc_id, label, text, CAST((row_number() OVER "
    "(PARTITION BY label ORDER BY doc_id) - 1) % 5 AS INTEGER) AS fold FROM labelled), "
    "runs(run) AS (VALUES (0), (1), (2), (3), (4)), "
    "train AS (SELECT run, doc_id, label FROM runs JOIN folded ON fold <> run), "
    "test AS (SELECT fold AS run, doc_id, label FROM folded)"
)
