"""PII: validated numbers, dates and addresses become keyed permutations of themselves within their format.

Column functions only. Equal values get equal pseudonyms in every document, different ones different pseudonyms: all
kinds go through a Feistel network over exactly the values of their format, so nothing is drawn again until it fits.
"""

from __future__ import annotations

import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import small_table
from .common import fresh, shared_dir, table

#: The setting that holds the key of the pseudonyms.
KEY_SETTING = "spark.gridloom.pii.key"
ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31
DAYS_LEFT, DAYS_RIGHT = 17, 4_297  # two factors of DAYS
# Valid social security numbers: areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
AREAS, GROUPS, SERIALS = 898, 99, 9_999

# The countries of the IBAN registry by the length of their numbers.
IBAN_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
LISTED = "|".join(IBAN_COUNTRIES.values()).replace(" ", "|")
IBAN_BODIES = "|".join(  # groups of four and what is left
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in IBAN_COUNTRIES.items()
)

# What may be personal, in the order in which a place of the text is tried. Every repetition of a group is bounded,
# for Java's regex recurses once for each: a local part has at most 64 characters, a label 63, a name 127 labels.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@(?:[A-Za-z0-9\-]{1,63}+\.){1,126}[A-Za-z]{2,63}",
    # Of a country's own length, so that a word behind it is not taken in; of countries not listed, any length.
    "iban": (
        rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN_BODIES}"
        rf"|(?!{LISTED})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![0-9A-Za-z])"
    ),
    # American numbers (any digits behind +1 or with the area code in brackets), then others by their digits alone: no
    # group of a card that follows is taken in, and none is left that a dot, hyphen or slash joins to what was taken.
    "phone": (
        r"(?<![0-9A-Za-z+])(?:\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}"
        r"|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-][0-9]{4}|[2-9][0-9]{2}([ .\-])[2-9][0-9]{2}\1[0-9]{4}"
        r"|\+(?!1)[1-9](?:(?:[ .\-/](?![0-9]{4}(?:[ \-][0-9]{4}){3}|3[0-9]{3}[ \-][0-9]{6}[ \-][0-9]{5}))?\(?[0-9]\)?){7,14}(?![.\-/][0-9])"
        r")(?![0-9A-Za-z])"
    ),
    "card": r"(?<![0-9A-Za-z.\-])(?:[2-6][0-9]{12,18}|[2-6][0-9]{3}(?:[ \-][0-9]{4}){3}|3[0-9]{3}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z\-])",
    "date": (
        r"(?<![0-9A-Za-z./\-])(?:[12][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}|[12][0-9]{3}/[0-9]{1,2}/[0-9]{1,2}"
        r"|[0-9]{1,2}/[0-9]{1,2}/[12][0-9]{3}|[0-9]{1,2}-[0-9]{1,2}-[12][0-9]{3}|[0-9]{1,2}\.[0-9]{1,2}\.[12][0-9]{3})"
        r"(?![0-9/\-]|(?![Tt][0-9]{2}|Z(?![0-9A-Za-z]))[A-Za-z])"
    ),
}
ANY = "|".join(PATTERNS.values())
#: What a match that looks like an IBAN but fails its check digits is searched for once more.
INSIDE = "|".join(p for k, p in PATTERNS.items() if k != "iban")


def session_key(spark: SparkSession) -> str:
    """The key from KEY_SETTING; where that is unset, one drawn at random and kept in the shared folder, so that later
    runs on the same cluster give the same pseudonyms."""
    key = spark.conf.get(KEY_SETTING, None)
    if key:
        return key
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gridloom-pii-key")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        out = files.create(path, False)
        out.write(bytearray(secrets.token_hex(32).encode()))
        out.close()
    return spark.read.text(path.toString()).first()["value"]


def secret(spark: SparkSession, key: str) -> Column:
    """The key as a column that no plan shows: a scalar subquery of a local table of one row, where a literal would stand
    in every plan's text, and so in event logs."""
    return small_table(spark, [(key,)], "pii_key string").scalar()


def as_column(key: str | Column) -> Column:
    """A key as it is given to the functions below: a column, or, where plans may show it, a text."""
    return key if isinstance(key, Column) else F.lit(key)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, tweak: Column, key: str | Column) -> Column:
    """struct(l, r): a keyed permutation of pairs below (left_size, right_size). Each round adds a hash of one half to
    the other, in turns, so it can be undone round by round whatever the sizes."""

    def hashed(i: Column, half: Column, size: Column) -> Column:
        text = F.concat_ws("|", as_column(key), tweak, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long") % size

    def one(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        return F.when(i % 2 == 1, F.struct(((l + hashed(i, r, left_size)) % left_size).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), ((r + hashed(i, l, right_size)) % right_size).alias("r"))
        )

    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    return F.aggregate(rounds, F.struct(left.alias("l"), right.alias("r")), one)


def with_value(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once however often ``use`` has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted_digits(digits: Column, tweak: Column, key: str | Column) -> Column:
    """A digit string as another of its length (2 to 34 digits)."""
    half = (F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    pair = feistel(
        F.substr(digits, F.lit(1), half).cast("long"), F.substr(digits, half + 1, rest).cast("long"), power(half), power(rest), tweak, key
    )
    return with_value(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), rest, "0")))


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def in_format(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced by ``digits``, one after another."""
    places = F.sequence(F.lit(1), F.length(text))
    letter = lambda i: F.substr(text, i, F.lit(1))
    nth = lambda i: F.length(only_digits(F.substr(text, F.lit(1), i)))
    return with_value(digits, lambda d: F.array_join(F.transform(places, lambda i: F.when(letter(i).between("0", "9"), F.substr(d, nth(i), F.lit(1))).otherwise(letter(i))), ""))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a number without its check digit."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, n + 1 - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def with_luhn(digits: Column) -> Column:
    return F.concat(digits, ((10 - luhn_sum(digits) % 10) % 10).cast("string"))


def iban_remainder(iban: Column) -> Column:
    """The whole IBAN, moved and with letters as numbers, modulo 97."""
    moved = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        c = F.substr(moved, i, F.lit(1))
        return F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def shifted(text: Column, other: Column, forth: str, i: Column, key: str | Column) -> Column:
    """Each ASCII letter of ``text`` moved on in the alphabet and each digit in 0 to 9, by a keyed hash of ``other``."""
    blocks = F.sequence(F.lit(0), (F.length(text) / 32).cast("int"))
    hashes = F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", as_column(key), F.lit("email"), F.lit(forth), i.cast("string"), b.cast("string"), other), 512)), "")

    def moved(c: Column, draw: Column) -> Column:
        code = F.ascii(c)
        return (
            F.when(c.between("0", "9"), F.chr((code - 48 + draw) % 10 + 48)).when(c.between("a", "z"), F.chr((code - 97 + draw) % 26 + 97))
            .when(c.between("A", "Z"), F.chr((code - 65 + draw) % 26 + 65)).otherwise(c)
        )

    def all_moved(h: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(text))
        draw = lambda k: F.conv(F.substr(h, k * 4 - 3, F.lit(4)), 16, 10).cast("long")
        return F.array_join(F.transform(places, lambda k: moved(F.substr(text, k, F.lit(1)), draw(k))), "")

    return F.when(F.length(text) == 0, text).otherwise(with_value(hashes, all_moved))


def email_pseudonym(m: Column, key: str | Column) -> Column:
    """Letters and digits before the top-level domain are permuted among the addresses of the same form; case and the
    rest stay, and addresses that only differ in case stay so. Each round moves one half by a hash of the other."""
    top = F.substring_index(m, ".", -1)
    rest = F.substr(m, F.lit(1), F.length(m) - F.length(top))
    half = (F.length(rest) / 2).cast("int")

    def one(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        return F.when(i % 2 == 1, F.struct(shifted(l, F.lower(r), "l", i, key).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), shifted(r, F.lower(l), "r", i, key).alias("r"))
        )

    start = F.struct(F.substr(rest, F.lit(1), half).alias("l"), F.substr(rest, half + 1, F.length(rest)).alias("r"))
    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    return with_value(F.aggregate(rounds, start, one), lambda p: F.concat(p["l"], p["r"], top))


def phone_pseudonym(m: Column, key: str | Column) -> Column:
    """Country code and the first digits of area code and exchange stay; the other digits are permuted."""
    d = only_digits(m)
    of_ten = lambda x, head: F.concat(
        F.lit(head), F.substr(x, F.lit(1), F.lit(1)), F.substr(x, F.lit(11), F.lit(2)), F.substr(x, F.lit(4), F.lit(1)), F.substr(x, F.lit(13), F.lit(6))
    )
    ten = F.right(d, F.lit(10))
    body = F.concat(F.substr(ten, F.lit(2), F.lit(2)), F.substr(ten, F.lit(5), F.lit(6)))
    american = of_ten(F.concat(ten, permuted_digits(body, F.lit("phone"), key)), "")
    head = F.substr(d, F.lit(1), F.lit(3))
    foreign = F.concat(head, permuted_digits(F.substr(d, F.lit(4), F.length(d)), F.concat(F.lit("phone"), head), key))
    is_foreign = m.startswith("+") & ~m.startswith("+1")
    return in_format(m, F.when(is_foreign, foreign).when(m.startswith("+1"), F.concat(F.lit("1"), american)).otherwise(american))


def card_pseudonym(m: Column, key: str | Column) -> Column:
    """The first digit stays, the check digit follows from the others, which are permuted."""
    d = only_digits(m)
    body = F.substr(d, F.lit(2), F.length(d) - 2)
    return in_format(m, with_value(F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_digits(body, F.substr(d, F.lit(1), F.lit(1)), key)), with_luhn))


def ip_pseudonym(m: Column, key: str | Column) -> Column:
    part = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    size = F.lit(65536).cast("long")
    pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), size, size, F.lit("ip"), key)
    parts = lambda p: F.concat_ws(".", *[(x / 256).cast("int").cast("string") if high else (x % 256).cast("string") for x in (p["l"], p["r"]) for high in (True, False)])
    return with_value(pair, parts)


def ssn_pseudonym(m: Column, key: str | Column) -> Column:
    """The number's place among the valid ones, permuted."""
    part = lambda i: F.split_part(m, F.lit("-"), F.lit(i)).cast("long")
    area = part(1) - F.when(part(1) > 666, 2).otherwise(1)
    pair = feistel(area * GROUPS + part(2) - 1, part(3) - 1, F.lit(AREAS * GROUPS).cast("long"), F.lit(SERIALS).cast("long"), F.lit("ssn"), key)

    def shown(p: Column) -> Column:
        place = (p["l"] / GROUPS).cast("long")
        of = lambda n, width: F.lpad(n.cast("string"), width, "0")
        return F.concat_ws("-", of(place + F.when(place >= 665, 2).otherwise(1), 3), of(p["l"] % GROUPS + 1, 2), of(p["r"] + 1, 4))

    return with_value(pair, shown)


def iban_pseudonym(m: Column, key: str | Column) -> Column:
    """The account's digits are permuted, its letters stay, the check digits follow."""
    plain = F.regexp_replace(m, " ", "")
    land = F.substr(plain, F.lit(1), F.lit(2))
    account = F.substr(plain, F.lit(5), F.length(plain))
    other = F.when(F.length(only_digits(account)) >= 2, in_format(account, permuted_digits(only_digits(account), land, key))).otherwise(account)
    checked = with_value(other, lambda a: F.concat(F.lpad((98 - iban_remainder(F.concat(land, F.lit("00"), a))).cast("string"), 2, "0"), only_digits(a)))
    return in_format(m, checked)


def date_of(m: Column) -> Column:
    """The date, in order year-month-day, day.month.year, day/month/year or, where that is none, month/day/year, with
    hyphens as with slashes; zeros in front may be there or not."""
    plain = F.translate(m, "./", "--")
    day_first = F.try_to_timestamp(plain, F.lit("d-M-yyyy"))
    return F.when(year_first(m), F.try_to_timestamp(plain, F.lit("yyyy-M-d"))).when(m.contains("."), day_first).otherwise(
        F.coalesce(day_first, F.try_to_timestamp(plain, F.lit("M-d-yyyy")))
    ).cast("date")


def year_first(m: Column) -> Column:
    return m.rlike("^[0-9]{4}")


def date_shown(d: Column, like: Column) -> Column:
    """``d`` in the form of the date ``like``: its order, its signs, and zeros in front unless ``like`` goes without."""
    sign = F.regexp_extract(like, "[./\\-]", 0)
    bare = like.rlike("(?<![0-9])[0-9](?![0-9])")
    part = lambda x: F.when(bare, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))
    year, month, day = F.year(d).cast("string"), part(F.month(d)), part(F.day(d))
    day_first = like.contains(".") | F.try_to_timestamp(F.translate(like, "./", "--"), F.lit("d-M-yyyy")).isNotNull()
    parts = lambda *x: F.concat(x[0], sign, x[1], sign, x[2])
    return F.when(year_first(like), parts(year, month, day)).when(day_first, parts(day, month, year)).otherwise(parts(month, day, year))


def date_pseudonym(m: Column, key: str | Column) -> Column:
    """Another day of the same two centuries."""
    left, right = F.lit(DAYS_LEFT).cast("long"), F.lit(DAYS_RIGHT).cast("long")
    n = F.datediff(date_of(m), F.lit(FIRST_DAY).cast("date")).cast("long")
    pair = feistel((n / right).cast("long"), n % right, left, right, F.lit("date"), key)
    day = lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * right + p["r"]).cast("int"))
    return with_value(with_value(pair, day), lambda d: date_shown(d, m))


def is_valid(kind: str, m: Column) -> Column:
    """What the pattern alone does not tell: check digits and calendars."""
    if kind == "card":
        d = only_digits(m)
        return with_luhn(F.substr(d, F.lit(1), F.length(d) - 1)) == d
    if kind == "iban":
        return iban_remainder(F.regexp_replace(m, " ", "")) == 1
    if kind == "date":
        return F.coalesce(F.datediff(date_of(m), F.lit(FIRST_DAY).cast("date")).between(0, DAYS - 1), F.lit(False))
    if kind == "phone":
        return F.length(only_digits(m)).between(8, 15)
    return F.lit(True)


PSEUDONYMS = {
    "email": email_pseudonym, "iban": iban_pseudonym, "phone": phone_pseudonym, "card": card_pseudonym, "ip": ip_pseudonym,
    "ssn": ssn_pseudonym, "date": date_pseudonym,
}


def kind_of(m: Column, kinds: list[str] | None = None) -> Column:
    """The kind of a match, null if it fails its kind's test: then it stays as it is."""
    whole = {k: m.rlike(f"^(?:{PATTERNS[k]})$") for k in kinds or PATTERNS}
    return reduce(lambda c, k: c.when(whole[k], F.when(is_valid(k, m), F.lit(k))), whole, F.when(F.lit(False), F.lit("")))


def parts_of(m: Column) -> Column:
    """Array of (value, kind), joined together ``m``: itself, or, where it failed as an IBAN, what it holds of other
    kinds and what lies between (kind null)."""
    part = lambda value, kind: F.struct(value.alias("value"), kind.alias("kind"))
    nothing = F.lit(None).cast("string")
    others = [k for k in PATTERNS if k != "iban"]

    def searched() -> Column:
        inner = F.transform(F.regexp_extract_all(m, F.lit(INSIDE), F.lit(0)), lambda x: part(x, kind_of(x, others)))
        gaps = F.transform(F.split(m, INSIDE, -1), lambda x: part(x, nothing))
        return F.flatten(F.zip_with(gaps, inner, lambda gap, own: F.filter(F.array(gap, own), lambda x: x.isNotNull())))

    alone = lambda kind: F.array(part(m, kind))
    return with_value(kind_of(m), lambda kind: F.when(kind.isNull() & m.rlike("^[A-Z]{2}[0-9]{2}"), searched()).otherwise(alone(kind)))


def with_pseudonyms(docs: DataFrame, key: str, text: str, found: str, counts: str) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and the columns ``found`` and ``counts``; working columns get names that
    ``docs`` does not have."""
    column = F.col(f"`{text}`")
    parts, done, own_key = fresh(docs, "pii_parts"), fresh(docs, "pii_done"), fresh(docs, "pii_key")
    may_hold = column.rlike("[0-9@]")  # most texts have no digit: they skip the long pattern
    none = F.array().cast("array<string>")
    matches = F.coalesce(F.when(may_hold, F.regexp_extract_all(column, F.lit(ANY), F.lit(0))).otherwise(none), none)

    def pseudonym(x: Column) -> Column:
        chain = reduce(lambda c, k: c.when(x["kind"] == k, PSEUDONYMS[k](x["value"], F.col(own_key))), PSEUDONYMS, F.when(F.lit(False), F.lit("")))
        return F.struct(x["kind"].alias("kind"), x["value"].alias("value"), chain.otherwise(x["value"]).alias("pseudonym"))

    shown = lambda all_parts: F.array_join(F.transform(all_parts, lambda x: x["pseudonym"]), "")
    replaced = F.array_join(
        F.transform(F.split(column, ANY, -1), lambda gap, i: F.concat(gap, F.coalesce(shown(F.get(F.col(done), i)), F.lit("")))), "",
    )
    kinds = F.transform(found, lambda x: x["kind"])
    counted = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda y: y == k)))))
    return (
        docs.withColumn(own_key, secret(docs.sparkSession, key)).withColumn(parts, F.transform(matches, parts_of))
        .withColumn(done, F.transform(parts, lambda of_match: F.transform(of_match, pseudonym)))
        .withColumn(found, F.filter(F.flatten(done), lambda x: x["kind"].isNotNull()))
        .withColumn(text, F.when(F.size(found) == 0, column).otherwise(replaced))
        .withColumn(counts, counted)
        .drop(parts, done, own_key)
    )


def pseudonymise(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and two further columns: pii_kinds (map of kind to count) and pii_found
    (array of kind, value, pseudonym in text order). The key is an argument, the session's or the cluster's own
    (`session_key`); who has it can undo the permutations.

    Handles e-mail addresses, IBANs, phone numbers, payment cards, IPv4 addresses, social security numbers and dates.
    What fails its check digits or calendar stays, but for what it holds of other kinds. A null text stays null with
    nothing found; an empty one stays empty; texts of any length and shape take time in proportion; rows are
    independent, so repeated rows and hot groups change nothing; an empty table gives an empty one; no shuffle. Input
    columns named pii_kinds and pii_found are replaced, all others stay.
    """
    return with_pseudonyms(docs, key or session_key(docs.sparkSession), text, "pii_found", "pii_kinds")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", "text", F.size("pii_found").cast("long").alias("n_found"), "pii_kinds")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their texts pseudonymised. All rows and columns stay, whatever they are named; null and empty
    texts stay as they are; repeated rows stay alike; an empty table stays empty."""
    found, counts = fresh(docs, "pii_found"), fresh(docs, "pii_kinds")
    return with_pseudonyms(docs, session_key(spark), "text", found, counts).drop(found, counts)
