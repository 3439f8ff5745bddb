"""Rules, text functions and cleaning against hand-written rows."""

import random

import pytest
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.functions.lexicon import RATIO_SHENG, RATIO_SWAHILI, SHENG, SWAHILI
from loomtext.operators import clean, rules

LEXICON = [
    ("The weather is nice today", "English"), ("hello there friend", None), ("mimi na wewe", "Swahili"), ("mimi na wewe bro", "Sheng"), ("niko sawa bro", "Sheng"),
    ("ng'ara sana", "Sheng"), ("I will come kesho morning", "English and Swahili"), ("na na na ya", "English and Swahili"), ("ok", None), ("12 34 !!", None), ("école été ñandú", None), (None, None),
]


def _one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_lexicons():
    assert (len(SWAHILI), len(SHENG), len(RATIO_SWAHILI), len(RATIO_SHENG)) == (35, 26, 45, 29)
    assert not set(SWAHILI) & set(SHENG) and not set(RATIO_SWAHILI) & set(RATIO_SHENG)


def test_lexicon_rule(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LEXICON)], "i int, text string")
    got = {r.i: r.label for r in rules.lexicon_counts(df).withColumn("label", rules.lexicon_rule()).collect()}
    assert [got[i] for i in range(len(LEXICON))] == [x for _, x in LEXICON]


def test_ruled_evaluates_the_rule_once(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LEXICON)], "i int, text string")
    out = rules.ruled(df).where("label IS NOT NULL AND i >= 0")
    assert sorted(map(tuple, out.collect())) == [(i, t, x) for i, (t, x) in enumerate(LEXICON) if x]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


@pytest.mark.parametrize(
    "en, sw, sh, label",
    [(0, 0, 0.2, None), (0.1, 0.1, 0.21, "Sheng"), (0, 0.7, 0.1, None), (0, 0.71, 0, "Swahili"), (0.81, 0.09, 0, "English"), (0.8, 0, 0, None), (0.81, 0.1, 0, None), (0.3, 0.4, 0, "English and Swahili"), (0.2, 0.4, 0, None), (0.3, 0.6, 0, None), (0.3, 0.3, 0.3, "English and Swahili")],
)
def test_ratio_rule(spark, en, sw, sh, label):
    assert _one(spark, rules.ratio_rule(F.col("en"), F.col("sw"), F.col("sh")), en=float(en), sw=float(sw), sh=float(sh)) == label


@pytest.mark.parametrize("en, n, label", [(2, 2, "short"), (3, 3, "English"), (19, 20, "English"), (18, 20, "code_mix_light"), (4, 5, "code_mix_light"), (3, 4, "light_swahili"), (1, 2, "short"), (2, 4, "light_swahili"), (1, 3, "heavy_swahili")])
def test_ladder(spark, en, n, label):
    assert _one(spark, rules.english_ladder(F.col("n"), F.col("en") / F.col("n")), en=en, n=n) == label


def test_sentences_keep_their_numbers(spark):
    lines = spark.createDataFrame([(1, "Hello there. ... 123! Bye now ok?"), (2, None), (3, "")], "line_id long, text string")
    zipf = spark.createDataFrame([("hello", 4.0), ("bye", 2.9), ("now", 3.0), ("ok", 5.0)], "word string, zipf double")
    got = sorted(tuple(r) for r in rules.sentence_shares(lines, zipf).collect())
    assert got == [(1, 1, "short", 2, 1, 0.5, "Hello there"), (1, 3, "light_swahili", 3, 2, 0.667, "Bye now ok")]


def test_shares_by_join_equal_shares_by_array(spark):
    rng = random.Random(1)
    words = ["aa", "bb", "cc", "dd", "It's", "é"]
    lines = spark.createDataFrame([(i, " ".join(rng.choice(words) + rng.choice(["", ".", "!?"]) for _ in range(rng.randint(0, 30)))) for i in range(50)], "line_id long, text string")
    zipf = spark.createDataFrame([("aa", 3.0), ("it's", 9.0)], "word string, zipf double")
    a = rules.sentence_shares(lines, zipf).select("line_id", "sent_id", "total_tokens", "en_tokens")
    s = lines.select("line_id", F.posexplode(X.sentences(F.col("text"))).alias("p", "s")).select("line_id", (F.col("p") + 1).alias("sent_id"), X.tokens(F.col("s")).alias("t")).where("size(t) > 0")
    b = s.select("line_id", "sent_id", F.size("t"), F.size(F.filter("t", lambda w: w.isin("aa", "it's"))))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_token_tags_and_ratios(spark):
    texts = spark.createDataFrame([(1, "bro mtoto house house nyumba?"), (2, None), (3, "!!")], "id long, text string")
    lid = spark.createDataFrame([("house", "en", 0.71), ("mtoto", "en", 0.99), ("bro", "en", 0.9)], "word string, lang string, prob double")
    tags = {(r.pos, r.word): r.tag for r in rules.token_tags(texts, lid).collect()}
    assert tags == {(0, "bro"): "Sheng", (1, "mtoto"): "Swahili", (2, "house"): "English", (3, "house"): "English", (4, "nyumba"): "Swahili"}
    got = sorted(tuple(r) for r in rules.token_ratios(texts, lid).collect())
    assert got == [(1, 5, 0.4, 0.4, 0.2), (2, 0, 0.0, 0.0, 0.0), (3, 0, 0.0, 0.0, 0.0)]


def test_ratios_with_common_words_tagged_in_place(spark, monkeypatch):
    """Whichever words are common; a repeated id sums its texts, a null one has none; names of tags and listed words as words."""
    rng = random.Random(2)
    words = ["bro", "Mtoto", "house", "Unknown", "english", "it's", "rare", "é", "calle", "nyumba", "'"]
    texts = spark.createDataFrame([(i // 2 if i < 20 else i, " ".join(rng.choices(words, range(11, 0, -1), k=rng.randint(0, 40)))) for i in range(60)] + [(None, "bro house"), (99, None)], "id long, text string")
    lid = spark.createDataFrame([("house", "en", 0.9, 300), ("unknown", "en", 0.7, 200), ("english", "sw", 0.8, 150), ("it's", "en", 1.0, 120), ("rare", "sw", 1.0, 99), ("bro", "en", 1.0, 400)], "word string, lang string, prob double, n long")
    want, seen = {}, {"house": "en", "english": "sw", "it's": "en", "rare": "sw", "bro": "sh", "mtoto": "sw", "nyumba": "sw"}
    for r in texts.collect():
        t = [seen.get(w, "") for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz'" else " " for c in (r.text or "").lower()).split()] if r.id is not None else []
        want.setdefault(r.id, []).append(t)
    want = sorted(((i, n := len(t := sum(ts, [])), *[t.count(c) / max(n, 1) for c in ("en", "sw", "sh")]) for i, ts in want.items() for _ in ts), key=repr)
    for most, often in ((50_000, 100), (2, 1), (0, 1)):
        monkeypatch.setattr(rules, "COMMON", most)
        monkeypatch.setattr(rules, "OFTEN", often)
        assert sorted(map(tuple, rules.token_ratios(texts, lid).collect()), key=repr) == want
    assert sorted(map(tuple, rules.token_ratios(texts, lid.drop("n")).collect()), key=repr) == want


def test_clean(spark):
    raw = spark.createDataFrame([("a", "  hi "), ("b", "[Deleted]"), ("c", "[removed]"), ("d", "   "), ("e", None), (None, "no id")], "id string, body string")
    assert sorted(map(tuple, clean.clean_comments(raw).collect())) == [("", "no id"), ("a", "hi")]


def test_gates_and_caps(spark):
    t = F.col("t")
    assert _one(spark, clean.quote_gate(t), t="it's") and not _one(spark, clean.quote_gate(t), t="its")
    assert not _one(spark, clean.min_length(t, 3), t=" ab ") and _one(spark, clean.min_length(t, 2), t=" ab ")
    same = "  ".join(["w"] * 500)
    assert _one(spark, X.word_cap(t), t=same) == same and _one(spark, X.word_cap(t), t=same + " w") == " ".join(["w"] * 500)
    assert _one(spark, X.token_estimate(t), t="a" * 100) == 32 and _one(spark, X.token_estimate(t), t="a b c") == 3
    assert _one(spark, X.strip(t), t="　 x\t\n") == "x" and _one(spark, X.prefix(t, 2), t="é🎉x") == "é🎉"
    assert _one(spark, X.falsy_coalesce(F.col("a"), F.col("b")), a="", b="t") == "t" and _one(spark, X.falsy_coalesce(F.col("a"), F.col("b")), a="b", b="t") == "b"
    assert _one(spark, X.ratio(F.lit(0), F.lit(0))) == 0.0 and _one(spark, X.percent_done(F.lit(0), F.lit(0))) == 0.0
    assert _one(spark, X.ratio_hint(F.lit(0.5), F.lit(0.25), F.lit(0.0))) == "en=0.50 sw=0.25 sh=0.00"


def test_numbered_ids(spark):
    df = spark.createDataFrame([(i * 3000, None if i % 2 else f"k{i}") for i in range(10)], "n long, id string")
    assert [r.id for r in clean.numbered_ids(df, "n").orderBy("n").collect()] == ["k0", "auto_1", "k2", "auto_2", "k4", "auto_3", "k6", "auto_4", "k8", "auto_5"]
    assert [r.id for r in clean.numbered_ids(df, "n", count_all=True).orderBy("n").collect()][1::2] == ["auto_2", "auto_4", "auto_6", "auto_8", "auto_10"]


def test_sentence_shares_join_and_literals_agree(spark, monkeypatch):
    lines = spark.createDataFrame([(1, "The cat sat on the mat. ... 123! Bye"), (2, None), (3, "the the the the. zz yy xx the")], "line_id long, text string")
    zipf = spark.createDataFrame([("the", 7.0), ("cat", 5.0), ("on", 6.5), ("rare", 1.0)], "word string, zipf double")
    one = sorted(tuple(r) for r in rules.sentence_shares(lines, zipf).collect())
    monkeypatch.setattr(rules, "LITERALS", 0)
    assert sorted(tuple(r) for r in rules.sentence_shares(lines, zipf).collect()) == one and len(one) == 4
