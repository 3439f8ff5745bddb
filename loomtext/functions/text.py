"""Column functions on text: stripping, words, tokens, caps, estimates, slugs. All run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.lexicon import LABELS

TOKEN = "[A-Za-z']+"
#: Some terms keep their own file name when results are split by label.
SHORT_SLUGS = {"Swahili": "swahili", "English and Swahili": "mixed", "Sheng": "sheng", "English": "english"}


#: Unicode white space and the four ASCII separators, as ``strip`` of most scripting languages takes them.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends. Linear in the text, however many blanks it has within."""
    return F.btrim(text, F.lit(BLANKS))


def falsy_coalesce(*values: Column) -> Column:
    """The first value that is neither null nor empty, else an empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def first_text(*values: Column) -> Column:
    """The first value that isn't blank, stripped; null if none."""
    return F.coalesce(*[F.nullif(strip(v), F.lit("")) for v in values])


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and apostrophes, lower-cased; other letters separate them."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z']+"), F.lit(0))


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def enough_letters(text: Column, least: int = 3) -> Column:
    """Whether a text has so many letters; looks no further than they are."""
    return text.rlike(r"(?s)\A" + r"\P{L}*+\p{L}" * least)


def prefix(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def word_cap(text: Column, most: int = 500) -> Column:
    """Texts over ``most`` words keep the first ones, joined by single spaces; others don't change."""
    w = words(text)
    return F.when(F.size(w) > most, F.array_join(F.slice(w, 1, most), " ")).otherwise(text)


def token_estimate(text: Column) -> Column:
    """The larger of the number of words and 0.32 tokens a character, rounded down."""
    return F.greatest(F.size(words(text)).cast("long"), F.floor(F.length(text) * 0.32).cast("long"))


def token_cap(text: Column, over: int = 600, most: int = 2500) -> Column:
    """Texts estimated over ``over`` tokens keep ``most`` words at most, joined by single spaces."""
    return F.when(token_estimate(text) > over, F.array_join(F.slice(words(text), 1, most), " ")).otherwise(text)


def sentences(text: Column) -> Column:
    """Stripped, non-blank pieces between runs of . ! ?"""
    return F.filter(F.transform(F.split(text, "[.!?]+"), strip), lambda s: s != "")


def slug(label: Column) -> Column:
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def short_slug(label: Column) -> Column:
    """File slugs in which the mix is ``mixed``; null for other labels."""
    return reduce(lambda c, kv: F.when(label == kv[0], kv[1]).otherwise(c), SHORT_SLUGS.items(), F.lit(None).cast("string"))


def known_label(label: Column) -> Column:
    return label.isin(*LABELS)


def hash_key(text: Column) -> Column:
    """Content key of a text: hex MD5 of its UTF-8 bytes."""
    return F.md5(text)


def ratio(hits: Column, total: Column) -> Column:
    """``hits / total``, with a total of zero taken as one."""
    return hits.cast("double") / F.greatest(total, F.lit(1)).cast("double")


def percent_done(done: Column, total: Column) -> Column:
    return F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0))


def ratio_hint(en: Column, sw: Column, sh: Column) -> Column:
    return F.format_string("en=%.2f sw=%.2f sh=%.2f", en, sw, sh)
