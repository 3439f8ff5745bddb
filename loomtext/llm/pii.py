"""Personal data: format-preserving Feistel pseudonyms, in DataFrame functions only.

Values that pass their format's check (Luhn sums, octets, calendar days, number plans) are permuted
by a keyed Feistel network inside that format, so equal values stay equal across documents and
different ones stay different. Mail addresses and hex secrets have no such small domain; they get keyed digests.
Phones are covered as ``(ddd) ddd-dddd``, ``ddd-ddd-dddd`` or ``ddd.ddd.dddd``, with or without ``+`` and a country code, not
space-separated, unseparated or in other national forms; dates as yyyy-MM-dd, MM/dd/yyyy and dd.MM.yyyy, not with the day first before slashes.
A text is split at its matches and put together again around their pseudonyms; a text
without a digit or an @ isn't searched further.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import columns, free_name

#: The session setting that holds the secret key. Who knows the key can undo the permutations.
KEY_SETTING = "spark.loomtext.pii.key"
#: Stands in where no key is set: pseudonyms are then stable, but no secret. Set a key for data that leaves the house.
DEMO_KEY = "no-secret"
ROUNDS = 8
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
SECRET = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])"
US_DATE = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])"
DOT_DATE = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])"
#: Cards are unbroken, or 4-4-4-4 (and 3 more), 4-6-5 or 4-6-4 with one kind of separator, so that a separator doesn't join
#: a card to the next number; digits in other groups are a card only as a whole, where no such form is among them.
_GROUPED = "|".join(rf"[0-9]{{4}}(?:{c}[0-9]{{4}}){{3}}(?:{c}[0-9]{{3}}(?![ \-./]?[0-9]))?|[0-9]{{4}}{c}[0-9]{{6}}{c}[0-9]{{4,5}}" for c in (" ", "-"))
_FORMS = rf"(?<![0-9])(?:[0-9]{{13,19}}|{_GROUPED})(?![0-9])"
_LOOSE = rf"(?<![0-9])(?=[0-9](?:[ \-]?[0-9]){{12}})(?![0-9 \-]{{0,36}}?{_FORMS})[0-9](?:[ \-]?[0-9]){{12,18}}(?![0-9]|\.[0-9])"
CARD = f"(?:{_FORMS}|{_LOOSE})"
ANY = "|".join((EMAIL, SECRET, IPV4, ISO_DATE, US_DATE, DOT_DATE, SSN, PHONE, CARD))
#: Days from 1800-01-01 through 2199-12-31, a whole Gregorian cycle: 627 x 233.
FIRST_DAY, DAYS, DAY_LEFT, DAY_RIGHT = "1800-01-01", 146097, 627, 233


def _digest(key: str, kind: str | Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind) if isinstance(kind, str) else kind, *parts), 256)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, kind: str | Column, key: str = DEMO_KEY) -> Column:
    """A keyed permutation of pairs in Z_left_size x Z_right_size, as a struct (l, r) of longs."""

    def step(acc: Column, i: Column) -> Column:
        def drawn(x: Column, size: Column) -> Column:
            return F.conv(F.substring(_digest(key, kind, i.cast("string"), x.cast("string")), 1, 12), 16, 10).cast("long") % size

        even = i % 2 == 0
        return F.struct(
            F.when(even, (acc["l"] + drawn(acc["r"], left_size)) % left_size).otherwise(acc["l"]).cast("long").alias("l"),
            F.when(even, acc["r"]).otherwise((acc["r"] + drawn(acc["l"], right_size)) % right_size).cast("long").alias("r"),
        )

    start = F.struct(F.coalesce(left.cast("long"), F.lit(0)).alias("l"), F.coalesce(right.cast("long"), F.lit(0)).alias("r"))
    start = F.struct(F.when(left.isNotNull(), start["l"]).cast("long").alias("l"), F.when(right.isNotNull(), start["r"]).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _padded(x: Column, width: Column) -> Column:
    return F.lpad(x.cast("string"), width, F.lit("0"))


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``; everything else stays in place."""

    def char(i: Column) -> Column:
        c = F.substr(m, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substr(digits, F.length(_digits(F.substr(m, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), char), "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum with the last digit counted once."""

    def add(acc: Column, i: Column) -> Column:
        v = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    """Length, first digit, separators and a right check digit stay; numbers that fail the check aren't cards."""

    def made(d: Column) -> Column:
        body = F.length(d) - 2
        u = F.floor(body / 2).cast("int")
        v = body - u
        out = feistel(F.substr(d, F.lit(2), u).cast("long"), F.substr(d, u + 2, v).cast("long"), _power(u), _power(v), "card", key)
        head = F.transform(F.array(out), lambda x: F.concat(F.substring(d, 1, 1), _padded(x["l"], u), _padded(x["r"], v)))[0]
        return F.transform(F.array(head), lambda h: F.concat(h, ((10 - luhn_sum(F.concat(h, F.lit("0"))) % 10) % 10).cast("string")))[0]

    def checked(m: Column, other: Column) -> Column:
        return F.transform(F.array(_digits(m)), lambda d: F.when(luhn_sum(d) % 10 == 0, _refill(m, made(d))).otherwise(other))[0]

    # A number of three digits after 4-4-4-4 is the end of a card of 19 digits only where the first 16 aren't a card.
    tail = F.when(m.rlike(r"^[0-9]{4}(?:[ \-][0-9]{4}){3}[ \-][0-9]{3}$"), F.substring(m, 20, 4)).otherwise("")
    head = F.substr(m, F.lit(1), F.length(m) - F.length(tail))
    whole = F.when(tail != "", checked(m, m)).otherwise(m)
    return F.transform(F.array(checked(head, F.lit(None).cast("string"))), lambda x: F.coalesce(F.concat(x, tail), whole))[0]


def _phone(m: Column, key: str) -> Column:
    """The ten digits of the national number are permuted; country code and punctuation stay.

    North American area codes and exchanges begin with 2 to 9. Each of the two parts stays below or above 200,
    so a valid number's pseudonym is valid and another's is not.
    """

    def made(d: Column) -> Column:
        n = F.length(d)
        area, exchange, line = (F.substr(d, n - at, F.lit(k)).cast("long") for at, k in ((9, 3), (6, 3), (3, 4)))
        low = lambda x: F.when(x < 200, F.lit(0)).otherwise(F.lit(200)).cast("long")
        size = lambda x: F.when(x < 200, F.lit(200)).otherwise(F.lit(800)).cast("long")
        kind = F.concat(F.lit("phone"), low(area).cast("string"), F.lit("-"), low(exchange).cast("string"))
        out = feistel((area - low(area)) * size(exchange) + exchange - low(exchange), line, size(area) * size(exchange), F.lit(10000).cast("long"), kind, key)

        def shown(x: Column) -> Column:
            a, e = F.floor(x["l"] / size(exchange)) + low(area), x["l"] % size(exchange) + low(exchange)
            return F.concat(F.substr(d, F.lit(1), n - 10), _padded(a, F.lit(3)), _padded(e, F.lit(3)), _padded(x["r"], F.lit(4)))

        return F.transform(F.array(out), shown)[0]

    return F.transform(F.array(_digits(m)), lambda d: F.transform(F.array(made(d)), lambda x: _refill(m, x))[0])[0]


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99 and serials 0001 to 9999; others aren't such numbers."""
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    good = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    out = feistel(area - F.when(area < 666, 1).otherwise(2), (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), "ssn", key)

    def shown(x: Column) -> Column:
        a = x["l"] + 1
        a = F.when(a < 666, a).otherwise(a + 1)
        return F.concat_ws("-", _padded(a, F.lit(3)), _padded(F.floor(x["r"] / 9999) + 1, F.lit(2)), _padded(x["r"] % 9999 + 1, F.lit(4)))

    return F.when(good, F.transform(F.array(out), shown)[0]).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    o = F.split(m, r"\.")
    pair = lambda i: F.element_at(o, i + 1).cast("long") * 256 + F.element_at(o, i + 2).cast("long")
    out = feistel(pair(0), pair(2), F.lit(65536).cast("long"), F.lit(65536).cast("long"), "ip", key)
    return F.transform(F.array(out), lambda x: F.concat_ws(".", *[(F.floor(x[h] / 256) if hi else x[h] % 256).cast("string") for h in "lr" for hi in (1, 0)]))[0]


def _date(m: Column, pattern: str, key: str) -> Column:
    """A day from 1800 through 2199 becomes another one, in the same notation; other days stay."""
    day = F.try_to_date(m, pattern) if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(m, F.lit(pattern)))
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    out = feistel(F.floor(n / DAY_RIGHT), n % DAY_RIGHT, F.lit(DAY_LEFT).cast("long"), F.lit(DAY_RIGHT).cast("long"), "date", key)
    shown = F.transform(F.array(out), lambda x: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (x["l"] * DAY_RIGHT + x["r"]).cast("int")), pattern))[0]
    return F.when((n >= 0) & (n < DAYS), shown).otherwise(m)


def _secret(m: Column, key: str) -> Column:
    """Hex digits of the same number and case."""
    out = F.substr(_digest(key, "secret", F.lower(m)), F.lit(1), F.length(m))
    return F.when(m == F.upper(m), F.upper(out)).otherwise(out)


def pseudonym(m: Column, key: str = DEMO_KEY) -> Column:
    """The pseudonym of one match of ``ANY``; ``m`` itself where its format's check fails."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    cases = [
        (F.contains(m, F.lit("@")), F.concat(F.lit("u"), F.substring(_digest(key, "mail", F.lower(m)), 1, 12), F.lit("@mail.invalid"))),
        (whole(IPV4), _ip(m, key)),
        (whole(ISO_DATE), _date(m, "yyyy-MM-dd", key)),
        (whole(US_DATE), _date(m, "MM/dd/yyyy", key)),
        (whole(DOT_DATE), _date(m, "dd.MM.yyyy", key)),
        (whole(SSN), _ssn(m, key)),
        (whole(PHONE), _phone(m, key)),
        (whole(CARD), _card(m, key)),
    ]
    return reduce(lambda tail, case: F.when(case[0], case[1]).otherwise(tail), reversed(cases), _secret(m, key))


def session_key(docs: DataFrame) -> str:
    """The key of the session's ``spark.loomtext.pii.key``, or the stand-in."""
    return docs.sparkSession.conf.get(KEY_SETTING, DEMO_KEY)


def pseudonymise(docs: DataFrame, count: str | None = "n_pii", key: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and the number of changed values appended.

    ``key`` is the secret of the permutations and digests; left out, that of the session counts.
    The count takes ``count`` or a free variant of it; None leaves it out. A null text stays null
    and counts 0. Texts of any length are searched whole. Every other column is kept as it is, except
    ``n_chars``, which follows the new text where the table has it. Repeated rows come out alike.
    """
    found, made = free_name(docs, "pii_found"), free_name(docs, "pii_made")
    secret = session_key(docs) if key is None else key
    text = F.col("text")
    hit = text.rlike("[0-9@]") & text.rlike(ANY)
    seen = docs.withColumn(found, F.when(hit, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    seen = seen.withColumn(made, F.transform(found, lambda m: pseudonym(m, secret)))
    woven = F.concat(F.array_join(F.zip_with(F.slice(F.split(text, ANY, -1), F.lit(1), F.size(made)), F.col(made), lambda a, b: F.concat(a, b)), ""), F.element_at(F.split(text, ANY, -1), -1))
    changed = F.size(F.filter(F.zip_with(found, made, lambda a, b: a != b), lambda x: x))
    out = seen.withColumn("text", F.when(F.col(found).isNotNull(), woven).otherwise(text))
    keep = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else q for c, q in zip(docs.columns, columns(docs))]
    if count:
        keep.append(F.when(F.col(found).isNotNull(), changed).otherwise(0).cast("long").alias(free_name(docs, count)))
    return out.select(*keep)
