"""Personal data replaced by format-preserving pseudonyms.

Candidates are found by one pattern and validated by kind: card numbers by their check
digit, IBANs by theirs, dates by the calendar, addresses of the internet protocol and
telephone and social-security numbers by their ranges. A valid value is put through a
keyed Feistel network over its own format: a digit stays a digit, a letter a letter of its
case, everything else stays where it is, check digits are computed anew, and a date stays
a date. A Feistel network is a permutation, so equal values have equal pseudonyms in all
documents and different values different ones. Numbers are permuted without their blanks, hyphens
and brackets, so the forms in which one card, IBAN or telephone number is written have one pseudonym, each in its form;
a number of the North American plan also links with and without its country code. The country code stays, and so
do the ranges: where the network leaves them it is applied again until it is back. Candidates that are not valid stay.

Only DataFrame functions are used; a text is split around its matches and put together again
within its row, whatever its length. A pseudonym may by chance equal its value, with a
probability of one in the number of values of the format.

Defined results: null and empty texts stay as they are; every row gives a row; an empty
table gives an empty result; other columns are kept, but not those named like the count or a
helper (a leading underscore).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.worker import beside

ROUNDS = 8
#: Further permutations at most until a value is back in its ranges.
WALK = 32
# Codes of digits that are at least 2, a class of their own.
_FROM_TWO = 200
# The patterns of the kinds, in the order in which they are tried. Every part is bounded
# and starts where no longer run of its own characters does, so matching is linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
#: Length of the numbers of each country of the IBAN registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _of_length(n: int, countries: str) -> str:
    groups, rest = divmod(n - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")


# By the length of its country, so that a word after the number is not taken for its last group; else any length.
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_of_length(n, c) for n, c in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
SECRET = r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])"
NAMES = "(?:[Pp]assword|PASSWORD|[Pp]asswd|PASSWD|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Aa]pi_key|API_KEY)"
# In prose a colon may follow these words: without quotes, what comes then must hold a digit or be longer than words are.
PROSE = r"(?<=[Tt]oken: |TOKEN: |[Ss]ecret: |SECRET: )(?![A-Za-z+/_-]{0,40}[0-9]|[A-Za-z+/_-]{41})"
ASSIGNED = rf"(?<![A-Za-z0-9]){NAMES}(?: ?= ?[\"']|=|: [\"']?)(?!{PROSE})[A-Za-z0-9+/_-]{{8,}}+(?:\.[A-Za-z0-9+/_-]++){{0,4}}+"
DATE = r"(?<![0-9.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9-])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,4}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
#: Without a country code, by the ranges of the North American plan.
NATIONAL = r"(?<![0-9+.-])(?:1-)?[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9+.-])(?:1\.)?[2-9][0-9]{2}\.[2-9][0-9]{2}\.[0-9]{4}(?![0-9]|[.-][0-9])"
PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9])"
KINDS = (
    ("email", EMAIL), ("iban", IBAN), ("secret", SECRET), ("assigned", ASSIGNED), ("date", DATE),
    ("ip", IPV4), ("ssn", SSN), ("phone", PHONE), ("national", NATIONAL), ("card", CARD),
)
ANY = "|".join(f"(?:{pattern})" for _, pattern in KINDS)
#: Calling codes of one and two digits, fixed values; the others have three.
CALLING = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# The days of four centuries, the period of the calendar: 189 * 773 of them.
_FIRST_DAY, _DAYS_HIGH, _DAYS_LOW = "1800-01-01", 189, 773


def _codes(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def _noise(key: str, kind: str, round_no: Column, other: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the kind, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_no.cast("string"), other), 256)


def _byte(noise: Column, i: Column) -> Column:
    """The i-th of 31 overlapping 16-bit numbers of the noise."""
    return F.conv(F.substr(noise, F.pmod(i, F.lit(31)) * 2 + 1, F.lit(4)), 16, 10).cast("int")


def _turned(codes: Column, noise: Column) -> Column:
    """Every digit and letter moved on within its own class by the noise."""

    def turn(c: Column, i: Column) -> Column:
        by = _byte(noise, i)
        return (
            F.when(c.between(48, 57), 48 + F.pmod(c - 48 + by, F.lit(10)))
            .when(c.between(97, 122), 97 + F.pmod(c - 97 + by, F.lit(26)))
            .when(c.between(65, 90), 65 + F.pmod(c - 65 + by, F.lit(26)))
            .when(c.between(_FROM_TWO, _FROM_TWO + 7), _FROM_TWO + F.pmod(c - _FROM_TWO + by, F.lit(8)))
            .otherwise(c)
        )

    return F.transform(codes, turn)


def _permuted_codes(codes: Column, key: str, kind: str) -> Column:
    half = F.size(codes) / 2
    start = F.struct(
        F.slice(codes, F.lit(1), F.ceil(half).cast("int")).alias("a"),
        F.slice(codes, F.ceil(half).cast("int") + 1, F.floor(half).cast("int")).alias("b"),
    )

    def step(state: Column, r: Column) -> Column:
        # Even rounds change the first half, odd rounds the second.
        a, b = state["a"], state["b"]
        even = r % 2 == 0
        noise = _noise(key, kind, r, F.array_join(F.when(even, b).otherwise(a).cast("array<string>"), ","))
        return F.struct(
            F.when(even, _turned(a, noise)).otherwise(a).alias("a"),
            F.when(even, b).otherwise(_turned(b, noise)).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _text(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.char(c)), "")


def permuted(text: Column, key: str, kind: str) -> Column:
    """`text` under a keyed permutation of all strings with the same pattern of classes."""
    return F.when(F.length(text) > 0, _text(_permuted_codes(_codes(text), key, kind))).otherwise(text)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a number, its check digit last."""
    last = F.length(digits)
    values = F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(F.pmod(last - i, F.lit(2)) == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d, lambda s: s % 10)


def _spread(digits: Column, like: Column, places: str = "[0-9]") -> Column:
    """`digits` set into the places of the digits of `like`."""
    state = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.rlike(places)
        return F.struct(
            (s["n"] + F.when(is_digit, 1).otherwise(0)).alias("n"),
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
        )

    return F.aggregate(F.filter(F.split(like, ""), lambda c: c != ""), state, put, lambda s: s["out"])


def _card(m: Column, key: str) -> Column:
    """The first digit stays, the check digit is that of the new number."""
    digits = _digits(m)
    body = F.concat(F.left(digits, F.lit(1)), permuted(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card"))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    return F.when(_luhn(digits) == 0, _spread(F.concat(body, check.cast("string")), m))


def _mod97(text: Column) -> Column:
    """The remainder modulo 97 of an IBAN-like string, letters counting as 10 to 35."""
    values = F.transform(_codes(text), lambda c: F.when(c >= 65, c - 55).otherwise(c - 48))
    return F.aggregate(values, F.lit(0), lambda s, v: F.pmod(s * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))


def _iban(m: Column, key: str) -> Column:
    """The country stays, the check digits are those of the new number; blanks stay in place."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.left(plain, F.lit(2)), F.substr(plain, F.lit(5))
    valid = _mod97(F.concat(body, F.left(plain, F.lit(4)))) == 1
    new = permuted(body, key, "iban")
    rest = _mod97(F.concat(new, country, F.lit("00")))
    return F.when(valid, _spread(F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), new), m, "[A-Z0-9]"))


def _day(day: Column, key: str) -> Column:
    """A day of the four centuries under a keyed permutation of them."""
    number = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
    start = F.struct((number / _DAYS_LOW).cast("int").alias("h"), (number % _DAYS_LOW).alias("l"))

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        noise = _noise(key, "date", r, F.when(even, s["l"]).otherwise(s["h"]).cast("string"))
        by = F.conv(F.left(noise, F.lit(7)), 16, 10).cast("int")
        return F.struct(
            F.when(even, F.pmod(s["h"] + by, F.lit(_DAYS_HIGH))).otherwise(s["h"]).alias("h"),
            F.when(even, s["l"]).otherwise(F.pmod(s["l"] + by, F.lit(_DAYS_LOW))).alias("l"),
        )

    new = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["h"] * _DAYS_LOW + s["l"])
    known = number.between(0, _DAYS_HIGH * _DAYS_LOW - 1)
    return F.when(known, F.date_add(F.lit(_FIRST_DAY).cast("date"), new))


def _date(m: Column, key: str) -> Column:
    """Year first, day first, or where that is no date month first; the form stays."""
    out = F.lit(None).cast("string")
    for pattern, form in (
        ("[0-9]{4}-.*", "yyyy-MM-dd"), (".*/.*", "dd/MM/yyyy"), (".*/.*", "MM/dd/yyyy"), (r".*\..*", "dd.MM.yyyy"),
    ):
        day = F.when(m.rlike(f"^{pattern}$"), F.try_to_timestamp(m, F.lit(form)).cast("date"))
        out = F.coalesce(out, F.date_format(_day(day, key), form))
    return out


def _ip(m: Column, key: str) -> Column:
    """Four numbers up to 255, without leading zeros, permuted as 32 bits."""
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("int"))
    valid = F.forall(F.split(m, r"\."), lambda p: (p.cast("int") <= 255) & ~p.rlike("^0[0-9]"))
    start = F.struct((F.get(parts, 0) * 256 + F.get(parts, 1)).alias("h"), (F.get(parts, 2) * 256 + F.get(parts, 3)).alias("l"))

    def step(s: Column, r: Column) -> Column:
        noise = _noise(key, "ip", r, s["l"].cast("string"))
        by = F.conv(F.left(noise, F.lit(4)), 16, 10).cast("int")
        return F.struct(s["l"].alias("h"), F.pmod(s["h"] + by, F.lit(65536)).alias("l"))

    def put(s: Column) -> Column:
        return F.concat_ws(".", *[F.floor(x / d) % 256 if d > 1 else x % 256 for x in (s["h"], s["l"]) for d in (256, 1)])

    return F.when(valid, F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, put))


def _ssn(m: Column, key: str) -> Column:
    """Within the ranges in use. A step of the walk leaves them with a probability of 0.11, all of them with one of 1e-31."""

    def valid(x: Column) -> Column:
        return ~x.rlike("^(000|666|9..)-|-00-|-0000$")

    def step(x: Column, _: Column) -> Column:
        return F.when(valid(x), x).otherwise(permuted(x, key, "ssn"))

    return F.when(valid(m), F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permuted(m, key, "ssn"), step))


def _phone(m: Column, key: str) -> Column:
    """Between 7 and 15 digits; the country code stays. In the North American plan area and exchange begin with 2 to 9."""
    digits, abroad = _digits(m), F.startswith(m, F.lit("+"))
    american = digits.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$") & (~abroad | F.startswith(digits, F.lit("1")) & (F.length(digits) == 11))
    codes = F.transform(_codes(F.right(digits, F.lit(10))), lambda c, i: F.when((i == 0) | (i == 3), c - 50 + _FROM_TWO).otherwise(c))
    moved = F.transform(_permuted_codes(codes, key, "american"), lambda c: F.when(c >= _FROM_TWO, c - _FROM_TWO + 50).otherwise(c))
    lead = F.when(american, F.left(digits, F.length(digits) - 10)).when(abroad, F.regexp_extract(digits, CALLING, 0)).otherwise("")
    new = F.when(american, _text(moved)).otherwise(permuted(F.substr(digits, F.length(lead) + 1), key, "phone"))
    return F.when(F.length(digits).between(7, 15), _spread(F.concat(lead, new), m))


def _email(m: Column, key: str) -> Column:
    """The domain stays, and tells the permutations of its local parts apart."""
    at = F.instr(m, "@")
    return F.concat(permuted(F.left(m, at - 1), key, "email"), F.substr(m, at))


def _assigned(m: Column, key: str) -> Column:
    lead = F.regexp_extract(m, r"^[A-Za-z_]+[ =:\"']+", 0)
    return F.concat(lead, permuted(F.substr(m, F.length(lead) + 1), key, "assigned"))


def _secret(m: Column, key: str) -> Column:
    lead = F.regexp_extract(m, "^(AKIA|ghp_|sk-)", 0)
    return F.concat(lead, permuted(F.substr(m, F.length(lead) + 1), key, "secret"))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match, null if it is not a valid value of its kind."""
    return (
        F.when(F.contains(m, F.lit("@")), _email(m, key))
        .when(m.rlike(f"^(?:{SECRET})$"), _secret(m, key))
        .when(m.rlike(f"^{NAMES}"), _assigned(m, key))
        .when(m.rlike("^[A-Z]{2}[0-9]{2}"), _iban(m, key))
        .when(m.rlike(f"^(?:{DATE})$"), _date(m, key))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), _ip(m, key))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(m, key))
        .when(m.rlike(rf"^[+(]|^(?:{NATIONAL})$"), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_pseudonyms") -> DataFrame:
    """`docs` with the texts replaced and, if wanted, how many values were."""
    text, found, names = F.col(text_col), F.col("_found"), F.col("_names")
    # Arrays that lambdas read are columns of their own, used more than once, so that they are computed once a row.
    step = docs.select(*beside(docs.columns, ["_found", "_names", "_pieces", *([count_col] if count_col else [])]))
    # No other text can hold a match.
    some = text.rlike("[0-9@=]") | text.rlike(f"{NAMES}: |ghp_|sk-")
    step = step.withColumn("_found", F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    step = step.withColumn("_names", F.when(F.size(found) > 0, F.transform(found, lambda m: pseudonym(m, key))))
    step = step.withColumn("_pieces", F.when(F.size(found) > 0, F.split(text, ANY, -1)))
    pieces = F.col("_pieces")
    values = F.zip_with(names, found, lambda new, old: F.coalesce(new, old))
    put = F.zip_with(values, F.slice(pieces, F.lit(2), F.size(found)), lambda value, after: F.concat(value, after))
    replaced = F.when(F.size(found) > 0, F.concat(F.get(pieces, 0), F.array_join(put, ""))).otherwise(text)
    if count_col:
        step = step.withColumn(count_col, F.coalesce(F.size(F.array_compact("_names")), F.lit(0)).cast("bigint"))
    return step.withColumn(text_col, replaced).drop("_found", "_names", "_pieces")
