"""Labelling rules: the lexicon cascade, token ratios, and the English-share ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.functions.lexicon import RATIO_SHENG, RATIO_SWAHILI, SHENG, SWAHILI


def _hits(known: Column, lexicon: tuple[str, ...]) -> Column:
    return F.size(F.filter(known, lambda x: x.isin(*lexicon)))


def lexicon_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_letters, enough_letters, n_tokens, n_sw, n_sh``; hits count distinct tokens. Null text counts as empty."""
    given = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn("_tokens", X.tokens(given))
    # Few tokens of a text are in a lexicon, so repeats are looked for among those only.
    out = out.withColumn("_known", F.array_distinct(F.filter("_tokens", lambda x: x.isin(*SWAHILI, *SHENG))))
    return out.withColumns({
        "n_letters": X.letter_count(given), "enough_letters": X.enough_letters(given),
        "n_tokens": F.size("_tokens"), "n_sw": _hits(F.col("_known"), SWAHILI), "n_sh": _hits(F.col("_known"), SHENG),
    }).drop("_tokens", "_known")


def lexicon_rule() -> Column:
    """The first rule that fits, over ``lexicon_counts``; null leaves the text to a model."""
    sw, sh, n = F.col("n_sw"), F.col("n_sh"), F.col("n_tokens")
    return (
        F.when(~F.col("enough_letters") | (n == 0), F.lit(None).cast("string"))
        .when((sw == 0) & (sh == 0) & (n >= 4), "English")
        .when((sw >= 3) & (sh == 0), "Swahili")
        .when(sh >= 1, "Sheng")
        .when(sw.between(1, 2), "English and Swahili")
    )


def ruled(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the lexicon rule decides, with its ``label``.

    Rows without one are dropped by a generator: a filter on the label would be pushed down to the scan, with the
    rule evaluated for each mention of a count in it, and again for the label.
    """
    said = F.explode(F.filter(F.array(lexicon_rule()), lambda x: x.isNotNull()))
    return lexicon_counts(df, text).select(*df.columns, said.alias("label"))


def token_tags(texts: DataFrame, word_lid: DataFrame) -> DataFrame:
    """``(id, text)`` and ``(word, lang, prob)`` to a row a token: ``id, pos, word, tag``.

    Sheng words first, then Swahili words, then the model's language above 0.7, else Unknown. Each
    distinct word meets the model table once; the tags then join the tokens.
    """
    tok = texts.select("id", F.posexplode(X.tokens(F.coalesce(F.col("text"), F.lit("")))).alias("pos", "word"))
    return tok.join(_tagged_words(tok, word_lid), "word").select("id", "pos", "word", "tag")


def _tag() -> Column:
    sure = F.coalesce(F.col("prob"), F.lit(0.0)) > 0.7
    return (
        F.when(F.col("word").isin(*RATIO_SHENG), "Sheng")
        .when(F.col("word").isin(*RATIO_SWAHILI), "Swahili")
        .when(sure & (F.col("lang") == "en"), "English")
        .when(sure & (F.col("lang") == "sw"), "Swahili")
        .otherwise("Unknown")
    )


def _tagged_words(tok: DataFrame, word_lid: DataFrame) -> DataFrame:
    return tok.select("word").distinct().join(word_lid, "word", "left").select("word", _tag().alias("tag"))


#: The most frequent words, of so many occurrences at least, are looked up in place: at most so many.
COMMON, OFTEN = 50_000, 100


def _common_words(word_lid: DataFrame) -> DataFrame:
    """``word, tag`` of the listed words and, where ``word_lid`` counts occurrences (``n``), of the most frequent others."""
    listed = word_lid.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, (*RATIO_SHENG, *RATIO_SWAHILI)))).alias("word"))
    listed = listed.select("word", F.when(F.col("word").isin(*RATIO_SHENG), "Sheng").otherwise("Swahili").alias("tag"))
    if "n" not in word_lid.columns:
        return listed
    often = word_lid.where(F.col("n") >= OFTEN).orderBy(F.desc("n")).limit(COMMON)
    # Listed words are left out behind the limit: before it, the filter would go down to the tokens, and the words be counted anew for it.
    return listed.unionByName(often.where(~F.col("word").isin(*RATIO_SHENG, *RATIO_SWAHILI)).select("word", _tag().alias("tag")))


def token_ratios(texts: DataFrame, word_lid: DataFrame) -> DataFrame:
    """``id, n_tokens, en_ratio, sw_ratio, sh_ratio`` over all tokens, repeats included; a row for each text.

    Common words, most of all tokens, are tagged in place and summed by text before anything is dealt; only the others
    are joined, once for each text and distinct word, so no word's rows are many.
    """
    tok = texts.select("id", F.explode(X.tokens(F.coalesce(F.col("text"), F.lit("")))).alias("word"))
    known = tok.join(F.broadcast(_common_words(word_lid).withColumnRenamed("tag", "_known")), "word", "left")
    # A common word gives way to its tag: tags have capitals, tokens none. Tags meet no word; with a number they are spread.
    per = known.groupBy("id", F.coalesce("_known", "word").alias("key")).agg(F.count("*").alias("n"))
    summed = F.col("key").isin("Sheng", "Swahili", "English", "Unknown")
    per = per.withColumn("word", F.when(summed, F.concat("key", F.hash("id").cast("string"))).otherwise(F.col("key")))
    rest = word_lid.select("word", _tag().alias("tag")).where("tag <> 'Unknown'")
    tagged = per.join(rest, "word", "left").select("id", "n", F.when(summed, F.col("key")).otherwise(F.col("tag")).alias("tag"))
    n = lambda t: F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0))
    sums = tagged.groupBy("id").agg(F.sum("n").alias("n_tokens"), n("English").alias("en"), n("Swahili").alias("sw"), n("Sheng").alias("sh"))
    out = texts.select("id").join(sums, "id", "left")
    total = F.coalesce("n_tokens", F.lit(0))
    return out.select("id", total.alias("n_tokens"), *[X.ratio(F.coalesce(c, F.lit(0)), total).alias(f"{c}_ratio") for c in ("en", "sw", "sh")])


def ratio_rule(en: Column, sw: Column, sh: Column) -> Column:
    """Strict bounds, in order; null leaves the text to a model with the ratios as a hint."""
    return (
        F.when((sh > 0.2) & (sh > sw) & (sh > en), "Sheng")
        .when((sw > 0.7) & (sw > sh), "Swahili")
        .when((en > 0.8) & (sw < 0.1), "English")
        .when((sw > 0.2) & (sw < 0.6) & (en > 0.2), "English and Swahili")
    )


def english_ladder(total: Column, ratio: Column) -> Column:
    """Label of a sentence from its English share; bounds belong to the upper label."""
    return (
        F.when(total < 3, "short").when(ratio >= 0.95, "English").when(ratio >= 0.80, "code_mix_light")
        .when(ratio >= 0.50, "light_swahili").otherwise("heavy_swahili")
    )


def word_zipf(texts: DataFrame) -> DataFrame:
    """``(text)`` of English texts to ``word, zipf``: log10 of occurrences in 10^9 words."""
    tok = texts.select(F.explode(X.tokens(F.coalesce(F.col("text"), F.lit("")))).alias("word"))
    counts = tok.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).first()["total"] or 1
    return counts.select("word", F.log10(F.col("n") * F.lit(1e9) / F.lit(float(total))).alias("zipf"))


#: English words up to which they become a literal set; a bound on zipf bounds them too: 10 ** (9 - zipf) at most.
LITERALS = 10_000


def sentence_shares(lines: DataFrame, zipf: DataFrame, least: float = 3.0) -> DataFrame:
    """``(line_id, text)`` to a row for each sentence with a token:
    ``line_id, sent_id, label, total_tokens, en_tokens, en_ratio, text``.

    Sentences are numbered from 1, those without tokens included. The label takes the exact share,
    the output a rounded one. A short list of English words is looked up in place, without a shuffle; a long one
    is joined, once for each sentence and distinct word.
    """
    s = lines.select("line_id", F.posexplode(X.sentences(F.coalesce(F.col("text"), F.lit("")))).alias("pos", "sentence"))
    s = s.select("line_id", (F.col("pos") + 1).cast("long").alias("sent_id"), "sentence", X.tokens(F.col("sentence")).alias("tok")).where(F.size("tok") > 0)
    english = zipf.where(F.col("zipf") >= least).select("word").distinct()
    few = [r["word"] for r in english.limit(LITERALS + 1).collect()]
    if len(few) <= LITERALS:
        hits = F.size(F.filter("tok", lambda x: x.isin(*few))) if few else F.lit(0)
        counted = s.select("line_id", "sent_id", "sentence", F.size("tok").cast("long").alias("total_tokens"), hits.cast("long").alias("en_tokens"))
    else:
        words = s.select("line_id", "sent_id", F.explode("tok").alias("word")).groupBy("line_id", "sent_id", "word").agg(F.count("*").alias("n"))
        known = words.join(english.withColumn("en", F.lit(True)), "word", "left")
        counts = known.groupBy("line_id", "sent_id").agg(F.sum("n").alias("total_tokens"), F.sum(F.when(F.col("en"), F.col("n")).otherwise(0)).alias("en_tokens"))
        counted = s.drop("tok").join(counts, ["line_id", "sent_id"])
    ratio = F.col("en_tokens") / F.col("total_tokens")
    return counted.select(
        "line_id", "sent_id", english_ladder(F.col("total_tokens"), ratio).alias("label"), "total_tokens", "en_tokens", F.round(ratio, 3).alias("en_ratio"), F.col("sentence").alias("text")
    )
