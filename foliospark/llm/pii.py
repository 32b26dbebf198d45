"""Format-preserving pseudonyms for personal data, in native Spark expressions only.

Card, account, social-security and phone numbers, IPv4 addresses and dates are found by pattern, validated (Luhn, modulo 97,
octets, calendar) and permuted inside their format by a keyed Feistel network: an index x of a domain of a * b values is
(x div b, x mod b), and every round adds a keyed SHA-256 of one half to the other, modulo its size. That is a bijection,
so equal values get equal pseudonyms in all documents and different ones stay different. Mail addresses and secrets are not numbers;
they get keyed digests, which keep equal values linked too. Numbers that fail validation are left alone.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.session import exists, shared_dir, spread, table

KINDS = ("secret", "iban", "email", "card", "ssn", "phone", "ip", "date")
#: How many characters account numbers have by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account(length: int, countries: str) -> str:
    """The pattern of one length: groups of four with a space before each, or none, so that no word after the number is taken for a group."""
    whole, rest = divmod(length - 4, 4)
    return rf"(?:{'|'.join(countries.split())})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{whole}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


#: Any other country's number is known without spaces only.
_IBAN = rf"(?i:\b(?:{'|'.join(_account(n, c) for n, c in IBAN_LENGTHS.items())}|(?!(?:{'|'.join(' '.join(IBAN_LENGTHS.values()).split())}))[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}})\b)"
#: What each kind looks like; the first kind that matches at a place has it.
PATTERNS = {
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}+|\bsk-[A-Za-z0-9]{20,}+|(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b)\"? ?[=:] ?\"?[^\s\"',;]{6,}+\"?",
    "iban": _IBAN,
    "email": r"(?<![\p{L}\p{N}_.+%-])[\p{L}\p{N}_.+%-]++@(?:[\p{L}\p{N}-]++\.)++\p{L}{2,}+",
    "card": r"(?<![\d.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+.-])\+\d{1,3}[ .-](?:\(\d{1,4}\) ?|\d{1,4}[ .-])\d{2,4}(?:[ .-]\d{2,4}){1,3}(?!\d)|(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?![\d.-]\d|\d)|\+\d{8,17}(?!\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])",
}
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
#: A text without any of these holds none of the patterns: a cheap first test.
HINT = r"[0-9]{3}|@|[0-9][./-][0-9]|(?i:password|passwd|pwd|secret|token|api[_-]?key)|AKIA|sk-|gh[pousr]_"
ROUNDS = 8
FIRST_DAY, DAY_ROOT = "1900-01-01", 270  # dates are permuted inside spans of 270 * 270 days, one of which begins with FIRST_DAY
KEY_SETTING = "spark.foliospark.pii.key"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value worked out once however often `then` names it."""
    return F.transform(F.array(value), then)[0]


def _digest(key: Column, kind: str, value: Column, length: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256), 1, length)


def feistel(x: Column, a: Column, b: Column, key: Column | str, kind: str, inverse: bool = False) -> Column:
    """The image of x in [0, a * b) under the keyed permutation of that range (or its inverse). All are longs; a * b < 2**62."""

    def noise(round_: Column, half: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), a.cast("string"), b.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size

    sign = F.lit(-1 if inverse else 1)

    def step(acc: Column, round_: Column) -> Column:
        left, right = acc["l"], acc["r"]
        even = round_ % 2 == 0
        return F.struct(
            F.when(even, F.pmod(left + sign * noise(round_, right, a), a)).otherwise(left).alias("l"),
            F.when(even, right).otherwise(F.pmod(right + sign * noise(round_, left, b), b)).alias("r"),
        )

    rounds = F.array(*map(F.lit, range(ROUNDS)[:: -1 if inverse else 1]))
    start = F.struct(F.expr("0L").alias("l"), F.expr("0L").alias("r"))
    halves = let(x, lambda v: F.struct(F.round((v - F.pmod(v, b)) / b).cast("long").alias("l"), F.pmod(v, b).cast("long").alias("r")))
    return F.aggregate(rounds, F.coalesce(halves, start), step, lambda acc: acc["l"] * b + acc["r"])


def _power(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("long")


def permuted_digits(digits: Column, key: Column, kind: str) -> Column:
    """A string of 1 to 18 digits permuted among all strings of as many digits."""

    def moved(d: Column) -> Column:
        n = F.length(d)
        low = F.floor(n / 2)
        halves = F.struct(_power(n - low).alias("a"), _power(low).alias("b"))
        return let(halves, lambda h: F.lpad(feistel(d.cast("decimal(20,0)").cast("long"), h["a"], h["b"], key, kind).cast("string"), n, F.lit("0")))

    return let(digits, moved)


def permuted_letters(letters: Column, key: Column, kind: str) -> Column:
    """A string of up to 11 capital letters permuted among all strings of as many."""
    power = lambda k: F.round(F.pow(F.lit(26), k)).cast("long")

    def moved(word: Column) -> Column:
        n = F.length(word)
        low = F.floor(n / 2)
        value = F.aggregate(F.split(word, ""), F.expr("0L"), lambda acc, c: acc * 26 + F.ascii(c) - 65)
        sizes = F.struct(power(n - low).alias("a"), power(low).alias("b"))
        new = let(sizes, lambda z: feistel(value, z["a"], z["b"], key, kind))
        back = lambda y: F.transform(F.sequence(n - 1, F.lit(0)), lambda i: let(power(i), lambda q: F.char(65 + F.pmod(F.round((y - F.pmod(y, q)) / q).cast("long"), F.lit(26).cast("long")))))
        return F.when(n > 0, let(new, lambda y: F.array_join(back(y), ""))).otherwise("")

    return let(letters, moved)


def _in_parts(text: Column, size: int, parts: int, permuted: Callable[[Column, str], Column], kind: str) -> Column:
    """text with each part of `size` characters, from its start, permuted by itself."""

    def part(i: int) -> Callable[[Column], Column]:
        return lambda x: F.when(x != "", permuted(x, f"{kind}{i}")).otherwise("")

    return let(text, lambda t: F.concat(*(let(F.substring(t, i * size + 1, size), part(i)) for i in range(parts))))


def _laid_out(pattern: Column, digits: Column) -> Column:
    """The digits of `pattern` replaced in order by `digits`; everything else stays."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substr(digits, acc["i"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["i"] + is_digit.cast("int")).alias("i"),
        )

    return F.aggregate(F.split(pattern, ""), start, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; the places counted from the right whose number modulo 2 is `doubled` are doubled."""
    places = F.split(F.reverse(digits), "")
    values = F.transform(places, lambda c, i: F.when(i % 2 == doubled, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + v)


def _card(value: Column, key: Column) -> Column:
    body = lambda d: F.concat(F.left(d, F.lit(1)), permuted_digits(F.substr(d, F.lit(2), F.length(d) - 2), key, "card"))
    whole = lambda x: F.concat(x, F.pmod(10 - luhn_sum(x, 0) % 10, F.lit(10)).cast("string"))
    return let(let(let(_digits(value), body), whole), lambda new: _laid_out(value, new))


def mod97(account: Column) -> Column:
    """The remainder by 97 of an account number whose letters count 10 to 35."""
    places = F.split(account, "")
    number = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(places, F.lit(0), lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + number(c)) % 97).otherwise((acc * 100 + number(c)) % 97))


def _iban(value: Column, key: Column) -> Column:
    """Digits and letters of the account are permuted apart, in parts, and the check digits follow; spaces and small letters stay where they are."""
    digit = lambda c: c.between("0", "9")

    def moved(body: Column) -> Column:
        parts = F.struct(
            _in_parts(_digits(body), 18, 2, lambda x, kind: permuted_digits(x, key, kind), "iban").alias("digits"),
            _in_parts(F.regexp_replace(body, "[0-9]", ""), 11, 3, lambda x, kind: permuted_letters(x, key, kind), "iban-letters").alias("letters"),
        )
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("d"), F.lit(1).alias("l"))

        def step(p: Column) -> Callable[[Column, Column], Column]:
            return lambda acc, c: F.struct(
                F.concat(acc["out"], F.when(digit(c), F.substr(p["digits"], acc["d"], F.lit(1))).otherwise(F.substr(p["letters"], acc["l"], F.lit(1)))).alias("out"),
                (acc["d"] + digit(c).cast("int")).alias("d"),
                (acc["l"] + (~digit(c)).cast("int")).alias("l"),
            )

        return let(parts, lambda p: F.aggregate(F.split(body, ""), start, step(p), lambda acc: acc["out"]))

    def laid_out(fresh: Column) -> Column:
        begin = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
        letter = lambda acc: F.substr(fresh, acc["i"], F.lit(1))
        lay = lambda acc, c: F.struct(F.concat(acc["out"], F.when(c == " ", c).when(c.rlike("[a-z]"), F.lower(letter(acc))).otherwise(letter(acc))).alias("out"), (acc["i"] + (c != " ").cast("int")).alias("i"))
        return F.aggregate(F.split(value, ""), begin, lay, lambda acc: acc["out"])

    def whole(plain: Column) -> Column:
        check = lambda m: F.lpad((98 - mod97(F.concat(m, F.left(plain, F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
        return let(let(moved(F.substr(plain, F.lit(5))), lambda m: F.concat(F.left(plain, F.lit(2)), check(m), m)), laid_out)

    return let(F.upper(F.replace(value, F.lit(" "), F.lit(""))), whole)


def _ssn(value: Column, key: Column) -> Column:
    """Permuted among the valid numbers: areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - (area > 666).cast("long")
    left, right = F.lit(898 * 99).cast("long"), F.lit(9999).cast("long")
    new = feistel((place * 99 + group - 1) * right + serial - 1, left, right, key, "ssn")
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    places = lambda y: F.struct(F.pmod(y, right).alias("serial"), F.round((y - F.pmod(y, right)) / right).cast("long").alias("rest"))
    area = lambda z: let(F.floor(z["rest"] / 99), lambda p: pad(p + 1 + (p >= 665).cast("long"), 3))
    return let(let(new, places), lambda z: F.concat_ws("-", area(z), pad(F.pmod(z["rest"], F.lit(99).cast("long")) + 1, 2), pad(z["serial"] + 1, 4)))


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: x.cast("long"))


def _ip(value: Column, key: Column) -> Column:
    x = F.aggregate(_octets(value), F.expr("0L"), lambda acc, o: acc * 256 + o)
    y = feistel(x, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    octets = lambda v: F.transform(F.array(*map(F.lit, (24, 16, 8, 0))), lambda s: F.expr("cast(1 as long)") * F.floor(v / F.pow(F.lit(2), s)).cast("long") % 256)
    return let(y, lambda v: F.array_join(octets(v).cast("array<string>"), "."))


def _date(value: Column) -> Column:
    """The date that a value writes: year first, or day before month unless only the other order is a date."""
    part = F.transform(F.split(value, "[-/.]"), lambda x: x.cast("int"))
    write = lambda y, m, d: F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")), "yyyy-MM-dd")
    return F.when(value.rlike(r"^\d{4}-"), write(part[0], part[1], part[2])).otherwise(F.coalesce(write(part[2], part[1], part[0]), write(part[2], part[0], part[1])))


def _moved_date(value: Column, key: Column) -> Column:
    """Another date of the same span of days, written as the first is: order of day and month, separators, and zeros before single digits.

    A month-first date is known by a day above 12; its pseudonym keeps that order, and may look like a day-first one.
    """
    first, size = F.lit(FIRST_DAY).cast("date"), F.lit(DAY_ROOT * DAY_ROOT).cast("long")
    lowest, highest = (F.date_diff(F.lit(d).cast("date"), first).cast("long") for d in ("0001-01-01", "9999-12-31"))

    def moved(day: Column) -> Column:
        begin = F.greatest(day - F.pmod(day, size), lowest)
        span = F.struct(begin.alias("begin"), (F.least(day - F.pmod(day, size) + size, highest + 1) - begin).alias("days"))
        root = F.lit(DAY_ROOT).cast("long")
        # the spans at both ends of the calendar are shorter: their days turn by a keyed number
        halves = lambda z: F.struct(F.when(z["days"] == size, root).otherwise(F.lit(1).cast("long")).alias("a"), F.when(z["days"] == size, root).otherwise(z["days"]).alias("b"))
        return let(span, lambda z: let(halves(z), lambda h: F.date_add(first, (z["begin"] + feistel(day - z["begin"], h["a"], h["b"], key, "date")).cast("int"))))

    def written(z: Column) -> Column:
        new, part = z["new"], z["part"]
        pad = lambda x, old: F.when(F.length(old) > 1, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
        year, month, dom = F.lpad(F.year(new).cast("string"), 4, "0"), F.month(new), F.dayofmonth(new)
        sep = F.regexp_extract(value, "[-/.]", 0)
        iso = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(dom.cast("string"), 2, "0"))
        day_first = F.concat(pad(dom, part[0]), sep, pad(month, part[1]), sep, year)
        return F.when(value.rlike(r"^\d{4}-"), iso).when(z["month"] == part[1].cast("int"), day_first).otherwise(F.concat(pad(month, part[0]), sep, pad(dom, part[1]), sep, year))

    known = lambda old: F.struct(let(F.date_diff(old, first).cast("long"), moved).alias("new"), F.month(old).alias("month"), F.split(value, "[-/.]").alias("part"))
    return let(let(_date(value), known), written)


def kind_of(value: Column) -> Column:
    """The kind of a match that is validated; null for one that is to be left alone."""
    digits = _digits(value)
    fits = lambda k: value.rlike(f"^(?:{PATTERNS[k]})$")
    plain = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    valid_iban = mod97(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))) == 1
    return (
        F.when(fits("secret"), "secret")
        .when(fits("iban"), F.when(valid_iban, "iban"))
        .when(fits("email"), "email")
        .when(fits("card"), F.when(luhn_sum(digits, 1) % 10 == 0, "card"))
        .when(fits("ssn"), F.when(~digits.rlike(r"^(?:000|666|9)|^...00|0000$"), "ssn"))
        .when(fits("ip"), F.when(F.forall(_octets(value), lambda o: o <= 255), "ip"))
        .when(fits("date"), F.when(_date(value).isNotNull(), "date"))
        .when(fits("phone"), "phone")
    )


def pseudonym(kind: Column, value: Column, key: Column) -> Column:
    """The pseudonym of a validated match, or the match itself where kind is null."""
    word = F.regexp_extract(value, r"^(?i)((?:password|passwd|pwd|secret|token|api[_-]?key)\"? ?[=:] ?\"?)", 1)
    digits = _digits(value)
    lead = F.when(value.startswith("+"), F.greatest(F.length(digits) - 10, F.lit(0))).otherwise(0)
    phone = F.concat(F.left(digits, lead), permuted_digits(F.substr(digits, lead + 1), key, "phone"))
    return (
        F.when(kind == "secret", F.concat(word, F.lit("SECRET_"), _digest(key, "secret", value, 16), F.when((word != "") & value.endswith('"'), '"').otherwise("")))
        .when(kind == "email", F.concat(F.lit("user."), _digest(key, "email", F.lower(value), 16), F.lit("@pseudonym.invalid")))
        .when(kind == "iban", _iban(value, key))
        .when(kind == "card", _card(value, key))
        .when(kind == "ssn", _ssn(value, key))
        .when(kind == "ip", _ip(value, key))
        .when(kind == "date", _moved_date(value, key))
        .when(kind == "phone", _laid_out(value, phone))
        .otherwise(value)
    )


def pseudonym_key(spark: SparkSession) -> DataFrame:
    """One row with the key of pseudonyms: the session's setting KEY_SETTING, or else the one kept beside the applications' folders, drawn by the first run that needs it.

    So runs that share spark.checkpoint.dir agree, and their documents stay linked; who may read that folder can undo the numbers. The key is a column of a
    table, so it stands in no plan, event log or page of the UI.
    """
    said = spark.conf.get(KEY_SETTING, None)
    if said:
        return spark.createDataFrame([(said,)], "value string")
    kept = shared_dir(spark).rpartition("/")[0] + "/foliospark-pseudonym-key"
    if not exists(spark, f"{kept}/_SUCCESS"):
        spark.createDataFrame([(secrets.token_hex(32),)], "value string").coalesce(1).write.mode("overwrite").text(kept)
    return spark.read.text(kept)


def pseudonymise(docs: DataFrame, key: str | DataFrame) -> DataFrame:
    """docs with the personal data in `text` replaced, and an array column `private` of (kind, old, new) in text order.

    Every other column stays as it is (a column named `private` is replaced). A null text stays null and an empty one empty, with
    no matches. Texts are handled whole, whatever their length; repeated rows get equal results. key: a secret, or a table of one row that holds it; who has it can undo the numbers.
    """
    if isinstance(key, str):
        if not key:
            raise ValueError("pseudonyms need a key")
        key = docs.sparkSession.createDataFrame([(key,)], "value string")
    text = F.col("text")
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    one, two, three, own = (next(f"__{k}{i}" for i in range(99) if f"__{k}{i}" not in docs.columns) for k in ("found", "kinds", "all", "key"))
    docs = docs.join(F.broadcast(key.agg(F.min("value").alias(own))), F.lit(True))  # one row
    kinds = F.transform(one, lambda m: F.struct(kind_of(m).alias("kind"), m.alias("old")))
    news = F.transform(two, lambda m: F.struct(m["kind"].alias("kind"), m["old"].alias("old"), pseudonym(m["kind"], m["old"], F.col(own)).alias("new")))
    ends = F.concat(F.transform(three, lambda m: m["new"]), F.array(F.lit("")))
    parts = F.zip_with(F.split(text, ANY, -1), ends, lambda gap, new: F.concat(gap, new))
    out = docs.withColumn(one, found).withColumn(two, kinds).withColumn(three, news)
    changed = F.exists(three, lambda m: m["kind"].isNotNull())
    out = out.withColumn("private", F.filter(three, lambda m: m["kind"].isNotNull()))
    return out.withColumn("text", F.when(changed, F.array_join(parts, "")).otherwise(text)).drop(one, two, three, own)


def op8_pii_pseudonyms(spark, sf_dir: str) -> DataFrame:
    out = pseudonymise(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"), pseudonym_key(spark))
    count = lambda k: F.size(F.filter("private", lambda m: m["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", *map(count, KINDS))
