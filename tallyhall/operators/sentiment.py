"""Lexicon sentiment as a join: tokens against a (token, valence) table."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.functions.numbers import cut_right
from tallyhall.functions.text import ASCII_BLANK, BLANK, plain, tokens

# Score bands, right-closed, and the constant that keeps scores within -1..1.
LABELS = ((-0.05, "负面"), (0.05, "中性"), (1.01, "正面"))
LABEL_FLOOR = -1.01
NORMALISER = 15
# Valences are summed in millionths; a lexicon holds no finer ones.
UNITS = 1_000_000


def valence_sums(df: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame) -> DataFrame:
    """One row per key: `valence`, the summed valence of one copy of its text.

    Rows that share a key must share the text. An empty token closes every row;
    counting those gives the number of copies, so duplicates need not be removed
    first and only (key, sum) pairs are shuffled, never text. Missing text sums to 0. Spark broadcasts
    the lexicon when its size allows and joins by shuffle when not.
    """
    closing = lexicon.sparkSession.sql("SELECT '' AS token, 0 AS valence")
    words = lexicon.where(F.col("token") != "").select("token", "valence").unionByName(closing)
    hits = (
        df.select(*keys, F.explode(F.array_append(tokens(F.coalesce(F.col(text), F.lit(""))), F.lit(""))).alias("token"))
        .join(words, "token")
        .groupBy(*keys)
        .agg(
            F.sum((F.col("valence") * UNITS).cast("bigint")).alias("_units"),
            F.count_if(F.col("token") == "").alias("_copies"),
        )
    )
    one_copy = F.expr("_units div _copies")
    return hits.select(*keys, (one_copy.cast("double") / F.lit(float(UNITS))).alias("valence"))


def score(valence: Column) -> Column:
    """Map a valence sum onto -1..1."""
    return valence / F.sqrt(valence * valence + F.lit(NORMALISER))


def label(sentiment: Column) -> Column:
    return cut_right(sentiment, LABEL_FLOOR, LABELS)


CONTRAST = "but"

# Fixed values from the published heuristics: the step of an intensifier and of
# capitals, the factor of a negation, the weight by distance, contrast weights,
# and the steps of exclamation and question marks.
STEP, CAPITALS, NEGATED = 0.293, 0.733, -0.74
DISTANCE = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAIM, EXCLAIM_MOST, ASK, ASK_MOST = 0.292, 4, 0.18, 0.96

# Symbols (emoji and the like) are words of their own, whatever they touch; marks that only change their looks go.
_SYMBOL = r"(\p{So})[\x{200D}\x{FE0E}\x{FE0F}\x{1F3FB}-\x{1F3FF}]*"
# Words in a phrase.
PHRASE_WORDS = (2, 3, 4)


def _bare(word: str) -> str:
    """SQL: a word without outer punctuation."""
    marks = string.punctuation.replace("\\", "\\\\").replace("'", "\\'")
    return f"btrim({word}, '{marks}')"


def _token(word: str, bare: str) -> str:
    """SQL: a word as it is looked up, in lower case and bare; short ones, like :), stay whole."""
    return f"lower(if(length({bare}) <= 2, {word}, {bare}))"


def _emphasis(text: str) -> str:
    """SQL: what the text's exclamation and question marks add to the size of its sum."""
    often = lambda mark: f"if(contains({text}, '{mark}'), octet_length({text}) - octet_length(replace({text}, '{mark}', '')), 0)"
    asks = often("?")
    return (
        f"least({often('!')}, {EXCLAIM_MOST}) * {EXCLAIM}D + "
        f"CASE WHEN {asks} < 2 THEN 0D WHEN {asks} <= 3 THEN {asks} * {ASK}D ELSE {ASK_MOST}D END"
    )


def _entries(lexicon: DataFrame, modifiers: DataFrame | None, phrases: DataFrame | None) -> DataFrame:
    """token, v, kind, phrases: what is known of a word, one row each; phrases are those that it begins, longest first.

    A modifier that has a valence of its own does not modify. Of a token or phrase given twice the larger valence counts.
    """
    none = "CAST(NULL AS array<struct<n: int, rest: string, v: double>>) AS phrases"
    known = lexicon.where("token <> ''").groupBy("token").agg(F.max("valence").cast("double").alias("v"))
    out = known.selectExpr("token", "v", "CAST(NULL AS int) AS kind", none)
    if modifiers is not None:
        own = modifiers.join(lexicon, "token", "left_anti").groupBy("token").agg(F.max("kind").cast("int").alias("kind"))
        out = out.unionByName(own.selectExpr("token", "CAST(NULL AS double) AS v", "kind", none))
    if phrases is not None:
        split = phrases.groupBy(F.lower("token").alias("_p")).agg(F.max("valence").cast("double").alias("v"))
        split = split.withColumn("_words", F.split("_p", " "))
        one = F.struct(F.size("_words").alias("n"), F.expr("array_join(slice(_words, 2, size(_words)), ' ')").alias("rest"), "v")
        firsts = split.groupBy(F.get("_words", F.lit(0)).alias("token")).agg(F.sort_array(F.collect_list(one), asc=False).alias("phrases"))
        out = out.unionByName(firsts.selectExpr("token", "CAST(NULL AS double) AS v", "CAST(NULL AS int) AS kind", "phrases"))
    # A token may come from all three.
    return out.groupBy("token").agg(F.max("v").alias("v"), F.max("kind").alias("kind"), F.max("phrases").alias("phrases"))


def _hits(df: DataFrame, keys: list[str], text: str, entries: DataFrame, contrast: str, with_phrases: bool, row: list[str]) -> DataFrame:
    """keys, hit (null for empty words), emphasis, mixed, row (null for others): a row per word that matters to the score.

    An empty word stands at the end of every text, and may stand at its beginning. A row holds a word and, if
    there are phrases, the words after it: it is of fixed width whichever way Spark joins it with the entries, which
    are the only words that are looked at any further.
    """
    body = f"coalesce(`{text}`, '')"
    spaced = f"if(octet_length({body}) = length({body}), {body}, regexp_replace({body}, r'{_SYMBOL}', ' $1 '))"
    # Capitals count amid words that are not all capitals; only a text without small letters a-z must be looked through.
    mixed = "_text RLIKE '[a-z]' OR exists(split(_text, '\\\\s+'), w -> NOT (w = upper(w) AND w <> lower(w)))"
    split = F.when(plain(F.col("_text")), F.split("_text", f"{ASCII_BLANK}+")).otherwise(F.split("_text", f"{BLANK}+"))
    ahead = PHRASE_WORDS[-1] - 1 if with_phrases else 0
    words = (
        df.select(*keys, *row, F.expr(spaced).alias("_text"))
        .select(
            *keys, *row, F.expr(_emphasis("_text")).alias("emphasis"), F.expr(mixed).alias("mixed"),
            F.concat(split, F.array(F.lit(""))).alias("_words"),
        )
        # The outer form, as the plain one would split every text twice, once to see whether it has any words.
        .select("*", F.posexplode_outer("_words").alias("_pos", "_w"))
        .select("*", F.expr(_bare("_w")).alias("_bare"))
        .select(
            *keys, *row, "emphasis", "mixed", "_pos", "_w", F.expr(_token("_w", "_bare")).alias("token"),
            *[F.get(F.col("_words"), F.col("_pos") + n).alias(f"_next{n}") for n in range(1, ahead + 1)],
        )
    )
    known = words.join(entries, "token", "left")
    if with_phrases:
        rest = lambda n: "concat_ws(' ', " + ", ".join(_token(f"_next{k}", _bare(f"_next{k}")) for k in range(1, n)) + ")"
        same = "CASE p.n " + " ".join(f"WHEN {n} THEN p.rest = {rest(n)}" for n in PHRASE_WORDS) + " ELSE false END"
        known = known.withColumn("_phrase", F.expr(f"CASE WHEN phrases IS NOT NULL THEN get(filter(phrases, p -> {same}), 0) END"))
    else:
        known = known.withColumn("_phrase", F.expr("CAST(NULL AS struct<n: int, rest: string, v: double>)"))
    negates = "if(v IS NULL AND contains(token, 'n\\'t'), 0, NULL)"
    hit = F.expr(
        f"""CASE WHEN _w <> '' THEN named_struct(
              'pos', _pos, 'n', coalesce(_phrase.n, 1), 'kind', if(_phrase IS NULL, coalesce(kind, {negates}), NULL),
              'caps', _w = upper(_w) AND _w <> lower(_w), 'turn', token = '{contrast}', 'v', coalesce(_phrase.v, v)) END"""
    )
    matters = F.expr(f"_w = '' OR v IS NOT NULL OR kind IS NOT NULL OR _phrase IS NOT NULL OR token = '{contrast}' OR contains(token, 'n\\'t')")
    last = lambda name: F.when(F.col("_w") == "", F.col(name)).alias(name)
    return known.where(matters).select(*keys, *map(last, row), last("emphasis"), last("mixed"), hit.alias("hit"))


def context_sums(
    df: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame, modifiers: DataFrame | None = None,
    contrast: str = CONTRAST, phrases: DataFrame | None = None, row: Sequence[str] = (),
) -> DataFrame:
    """valence_sums with the published heuristics for the words around each hit.

    Up to three words before a hit may strengthen (kind 1 in `modifiers`: token, kind), weaken
    (-1) or negate it (0, and words with n't); capitals amid lower case strengthen it; the
    contrast word shifts weight to what follows; punctuation enlarges the sum. Emoticons and emoji are words.
    `phrases` (token, valence) holds runs of two to four words: from left to right the longest phrase that
    begins at a word is taken, and its words then count for nothing else. Missing text sums to 0.

    Words are rows only until they have met the lexicon; hits gather per key, each once however many copies
    of a text there are, and only hits are shuffled. Of the columns `row`, which need not depend on the key, the
    smallest row is kept as the struct `row`.
    """
    keys, row = list(keys), list(row)
    entries = _entries(lexicon, modifiers, phrases)
    rows = _hits(df, keys, text, entries, contrast, phrases is not None, row)
    smallest = [F.min(F.when(F.col("mixed").isNotNull(), F.struct(*row))).alias("row")] if row else []
    gathered = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_set("hit")).alias("_all"), F.max("emphasis").alias("_emphasis"), F.max("mixed").alias("_mixed"), *smallest
    )
    left_to_right = """aggregate(_all, named_struct('free', 0, 'kept', filter(_all, h -> false)),
        (s, h) -> if(h.pos < s.free, s, named_struct('free', h.pos + h.n, 'kept', array_append(s.kept, h))), s -> s.kept)"""
    kept = F.expr(f"if(exists(_all, h -> h.n > 1), {left_to_right}, _all)") if phrases is not None else F.col("_all")
    turn = "if(exists(_all, h -> h.turn), array_min(transform(filter(_all, h -> h.turn), h -> h.pos)), NULL)"
    # The words before a hit, nearest first.
    back = "h.pos - m.pos"
    weight = "CASE " + " ".join(f"WHEN {back} = {n} THEN {w}D" for n, w in enumerate(DISTANCE, 1)) + " END"
    step = f"({STEP}D * m.kind + if(_mixed AND m.caps, {CAPITALS}D, 0D)) * {weight}"
    one = f"""CASE WHEN m.kind IS NULL OR {back} > {len(DISTANCE)} THEN x
                   WHEN m.kind = 0 THEN x * {NEGATED}D ELSE x + if(x > 0, 1D, -1D) * {step} END"""
    before = f"reverse(slice(_kept, greatest(i - {len(DISTANCE) - 1}, 1), least(i, {len(DISTANCE)})))"
    own = f"h.v + if(_mixed AND h.caps, if(h.v > 0, {CAPITALS}D, -{CAPITALS}D), 0D)"
    value = f"if(i = 0, {own}, aggregate({before}, {own}, (x, m) -> {one}))"
    side = f"CASE WHEN _turn IS NULL OR h.pos = _turn THEN 1D WHEN h.pos < _turn THEN {BEFORE_CONTRAST}D ELSE {AFTER_CONTRAST}D END"
    units = f"transform(_kept, (h, i) -> if(h.v IS NULL, 0L, bigint(round({value} * {side} * 100000000D))))"
    total = (
        gathered.withColumn("_kept", kept).withColumn("_turn", F.expr(turn))
        .withColumn("_sum", F.expr(f"aggregate({units}, 0L, (x, u) -> x + u) / 100000000D"))
    )
    valence = F.expr("_sum + signum(_sum) * _emphasis").alias("valence")
    return total.select(*keys, valence, *(["row"] if row else []))


def compound(valence: Column) -> Column:
    """The score of a text, kept to six places."""
    return F.round(score(valence), 6)
