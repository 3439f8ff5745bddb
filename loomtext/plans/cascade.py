"""The cheapest-first cascade: checkpoint, cache, rule, then the model for what is left.

Each distinct text reaches the model once. What the model says is stored before anything else reads
it, so no plan asks twice. Every item that passes the gate comes out, labelled or with a reason.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import clean, joins, rules
from loomtext.operators.providers import HashProvider, LabelProvider, Retry, label_batches


@dataclass(frozen=True)
class Preset:
    """One published set of options. ``gate``: blank, quote, min2 or min3; caps of None are off."""

    gate: str = "min2"
    use_rule: bool = True
    use_cache: bool = True
    resume: bool = True
    chars: int | None = None
    words: int | None = None
    token_cap: bool = False
    batch: int = 15
    retry: Retry = field(default_factory=Retry)


PRESETS = {
    "v1": Preset("blank", use_rule=False, use_cache=False, resume=False, chars=800, batch=25),
    "v3": Preset("quote", use_rule=False, chars=800, words=500, batch=40),
    "v4": Preset("quote", use_rule=False, chars=800, words=500, batch=50),
    "v5": Preset("quote", use_rule=False, chars=800, words=500, batch=40),
    "v6": Preset("quote", use_rule=False, chars=800, words=500, batch=40),
    "v7": Preset("quote", use_rule=False, words=500, batch=40),
    "v8": Preset("min3", use_rule=False, words=500, batch=40),
    "cascade": Preset(token_cap=True),
    "ratio": Preset("blank", use_rule=False, use_cache=False, resume=False, chars=1500, batch=10),
    "sample": Preset("blank", use_rule=False, use_cache=False, resume=False, batch=40),
}
GATES = {
    "blank": clean.not_blank,
    "quote": clean.quote_gate,
    "min2": lambda t: clean.min_length(t, 2),
    "min3": lambda t: clean.min_length(t, 3),
}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A temporary folder where it names none and Spark runs in one process; elsewhere that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='loomtext-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back; a provider is never asked twice by a recomputed plan."""
    path = f"{shared_folder(df.sparkSession)}/loomtext-labels-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prompt_text(preset: Preset):
    def cap(t):
        t = X.word_cap(t, preset.words) if preset.words else t
        t = X.token_cap(t) if preset.token_cap else t
        return X.prefix(t, preset.chars) if preset.chars else t

    return cap


def run_cascade(items: DataFrame, preset: Preset = PRESETS["cascade"], done: DataFrame | None = None, cache: DataFrame | None = None, provider: LabelProvider | None = None) -> DataFrame:
    """``(id, text)`` to ``id, text, label, origin, failure``; origin is cache, rule or model.

    ``done`` has ids to skip, ``cache`` labels by content key. Items without an id or under the gate are
    left out (count them with ``clean.skip_reasons``).
    """
    gated = items.where(clean.has_id(F.col("id")) & GATES[preset.gate](F.col("text"))).select("id", "text")
    if preset.resume and done is not None:
        gated = joins.unprocessed(gated, done)
    keyed = gated.withColumn("h", X.hash_key(F.col("text")))
    if preset.use_cache and cache is not None:
        keyed = keyed.join(cache.select("h", F.col("label").alias("_cached")), "h", "left")
    else:
        keyed = keyed.withColumn("_cached", F.lit(None).cast("string"))
    if preset.use_rule:
        keyed = rules.lexicon_counts(keyed).withColumn("_rule", rules.lexicon_rule()).select("id", "text", "h", "_cached", "_rule")
    else:
        keyed = keyed.withColumn("_rule", F.lit(None).cast("string"))
    # Gate, cache and rule are evaluated once; only rows that they leave open meet the model's answers.
    origin = F.when(F.col("_cached").isNotNull(), "cache").when(F.col("_rule").isNotNull(), "rule")
    seen = _stored(keyed.select("id", "text", "h", F.coalesce("_cached", "_rule").alias("label"), origin.alias("origin")))
    closed, left = seen.where("label IS NOT NULL"), seen.where("label IS NULL")
    open_ = left.groupBy(F.col("h").alias("id")).agg(F.min("text").alias("text"))
    asked = label_batches(open_.select("id", prompt_text(preset)(F.col("text")).alias("text")), provider or HashProvider(), preset.retry, preset.batch)
    answers = _stored(asked).select(F.col("id").alias("h"), "label", "failure")
    told = left.drop("label").join(answers, "h", "left").select("id", "text", "label", F.lit("model").alias("origin"), "failure")
    return closed.select("id", "text", "label", "origin", F.lit(None).cast("string").alias("failure")).unionByName(told)


def new_cache_rows(labelled: DataFrame) -> DataFrame:
    """``h, label`` that a run adds: rule and model labels of distinct texts."""
    fresh = labelled.where("label IS NOT NULL AND origin <> 'cache'")
    return fresh.groupBy(X.hash_key(F.col("text")).alias("h")).agg(F.min("label").alias("label"))


def recheck(labelled: DataFrame, cache: DataFrame, provider: LabelProvider, cache_share: float = 0.02, rule_share: float = 0.08, seed: str = "recheck") -> tuple[DataFrame, DataFrame]:
    """Sampled cheap labels against the model: their outcomes, and the cache with mismatches replaced.

    Rows that are already written don't change. The sample is drawn and asked once: expected label and content key
    go along with its rows, and what is stored has no texts.
    """
    from loomtext.operators.sampling import draw

    share = F.when(F.col("origin") == "cache", cache_share).when(F.col("origin") == "rule", rule_share).otherwise(0.0)
    picked = labelled.where(draw(seed, F.col("id")) < share * F.lit(2.0**32)).select("id", "text", F.col("label").alias("expected"), X.hash_key(F.col("text")).alias("h"))
    told = _stored(label_batches(picked, provider, keep=("expected", "h"))).select(F.col("id").alias("recheck_id"), "expected", F.col("label").alias("language"), "h")
    outcomes = told.select("recheck_id", "expected", "language", joins.recheck_outcome().alias("outcome"), "h")
    wrong = outcomes.where("outcome = 'mismatch'").select("h", F.col("language").alias("label"), "recheck_id")
    return outcomes.drop("h"), joins.upsert_cache(cache, wrong, "recheck_id")


def checkpoint_policy(done: int, total: int, near: int = 0) -> str:
    """``restart`` where the checkpoint covers (nearly, by ``near`` rows) the whole input, else ``resume``."""
    return "restart" if total > 0 and done >= total - near else "resume"


def ratio_labels(texts: DataFrame, word_lid: DataFrame) -> DataFrame:
    """``id, label, hint``: the token-ratio rule, with the ratios as a hint for the model where it is silent."""
    r = rules.token_ratios(texts, word_lid)
    en, sw, sh = F.col("en_ratio"), F.col("sw_ratio"), F.col("sh_ratio")
    out = r.withColumn("label", rules.ratio_rule(en, sw, sh))
    return out.withColumn("hint", F.when(F.col("label").isNull(), X.ratio_hint(en, sw, sh)))
