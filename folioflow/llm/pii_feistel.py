"""Format-preserving pseudonyms: validated numbers and dates are permuted by a keyed Feistel network.

What is found, in this order at each place: mail addresses, keys of 32 to 64 hexadecimal digits, bank
accounts (IBAN) with a right check number, IPv4 addresses, dates, social security numbers, payment
cards with a right check digit, telephone numbers. A value is permuted among the values of its kind
and shape: equal values get equal pseudonyms in every document, different ones different, and a
pseudonym is again a valid value, written the same way.

* Characters: the two halves of the value take turns, each character moving on within its class
  (digits, small, large letters, hexadecimal digits) by an amount that SHA-256 of key, kind, round and the
  other half gives. Cards and IBANs permute all but the check digits, which are computed anew; a
  telephone number keeps its country code, a mail address its domain.
* Numbers: dates (days of 1900 to 2099), IPv4 addresses and social security numbers are numbered
  without gaps and permuted as two digits of a mixed radix, so every result is allowed.
* Dates in figures are read day first, month first where only that is a date (not with dots), or year first.
  An IBAN has the length of its country, whatever word or number follows.

Edge cases: a null text stays null and an empty one empty; numbers that fail their check are no personal
data and stay, as does every other character; repeated rows get equal results; other columns stay,
whatever their names; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

_BEFORE_MAIL = r"(?<![\p{L}\p{N}._%+-])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
MAIL = _BEFORE_MAIL + r"[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
HEX = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
# Characters of a bank account number by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE BI", 18: "DK FO FI GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL OM SO",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR DZ", 27: "BF BJ CF CG CM CI DJ FR GA GQ GR HN IT KM MC MG MR ML NE SM SN TD TG",
    28: "AL AZ BY CY DO GT HU LB MA NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    each = []
    for length, lands in _IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        each.append(f"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}")
    return f"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(each)})(?![0-9A-Za-z])"


IBAN = _iban_pattern()
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
DATE = (
    r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
    r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9/-])"
)
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
PHONE = (
    r"(?<![0-9A-Za-z+])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
)
ANY = "|".join((MAIL, HEX, IBAN, IPV4, DATE, SSN, CARD, PHONE))
_ROUNDS = 10
_ZERO = "0123456789abcdef"
_FIRST_DAY, _DAY_RADIX = "1900-01-01", (17, 4297)
_WALK = 99
_SSN_RADIX = (898 * 99, 9999)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(s: Column, change) -> Column:
    """``s`` with each character c at place i (from 1) replaced by ``change(c, i)``."""
    places = F.when(F.char_length(s) > 0, F.sequence(F.lit(1), F.char_length(s))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: change(F.substr(s, i, F.lit(1)), i)), "")


def _moved(s: Column, digest: Column, hexadecimal: bool) -> Column:
    def change(c, i):
        k = F.conv(F.substr(digest, 1 + 4 * ((i - 1) % 16), F.lit(4)), 16, 10).cast("int")
        code = F.ascii(c)
        if hexadecimal:
            value = F.when(code < 58, code - 48).otherwise(code - 87)
            return F.substr(F.lit(_ZERO), (value + k) % 16 + 1, F.lit(1))
        moved = F.when(code.between(48, 57), 48 + (code - 48 + k) % 10)
        moved = moved.when(code.between(97, 122), 97 + (code - 97 + k) % 26).when(code.between(65, 90), 65 + (code - 65 + k) % 26)
        return F.when((F.octet_length(c) == 1) & moved.isNotNull(), F.char(moved)).otherwise(c)

    return _chars(s, change)


def permute_characters(value: Column, key: str, kind: str, hexadecimal=False) -> Column:
    half = F.floor(F.char_length(value) / 2).cast("int")
    zero = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1, F.char_length(value)).alias("b"))

    def step(acc, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), acc["b"]), 256)
        return F.struct(acc["b"].alias("a"), _moved(acc["a"], digest, hexadecimal).alias("b"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(_ROUNDS)]), zero, step, lambda acc: F.concat(acc["a"], acc["b"]))


def permute_number(number: Column, radix: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of 0 to radix[0] * radix[1] - 1."""
    first, second = radix
    zero = F.struct(F.floor(number / second).cast("long").alias("a"), (number % second).cast("long").alias("b"))

    def step(acc, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), acc["b"].cast("string")), 256)
        move = F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long")
        size = F.when(i % 2 == 0, F.lit(first)).otherwise(F.lit(second)).cast("long")
        return F.struct(acc["b"].alias("a"), ((acc["a"] + move) % size).alias("b"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(_ROUNDS)]), zero, step, lambda acc: acc["a"] * second + acc["b"])


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _written_as(bare: Column, shape: Column) -> Column:
    """The characters of ``bare`` in the places that ``shape`` has letters and digits in."""

    def change(c, i):
        return F.when(c.rlike("[0-9A-Za-z]"), F.substr(bare, F.char_length(_bare(F.substr(shape, F.lit(1), i))), F.lit(1))).otherwise(c)

    return _chars(shape, change)


def luhn_digit(payload: Column) -> Column:
    n = F.char_length(payload)

    def add(acc, i):
        d = F.substr(payload, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return ((10 - F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10) % 10).cast("string")


def mod97(s: Column) -> Column:
    def add(acc, i):
        code = F.ascii(F.substr(s, i, F.lit(1)))
        return F.when(code < 58, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(s)), F.lit(0), add)


def _mail(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permute_characters(local, key, "mail"), F.substr(m, F.char_length(local) + 1, F.char_length(m)))


def _card(m: Column, key: str) -> Column:
    def make(bare):
        payload = F.substr(bare, F.lit(1), F.char_length(bare) - 1)
        made = _let(permute_characters(payload, key, "card"), lambda p: F.concat(p, luhn_digit(p)))
        return F.when(luhn_digit(payload) == F.substr(bare, F.char_length(bare), F.lit(1)), _written_as(made, m))

    return _let(_bare(m), make)


def _iban(m: Column, key: str) -> Column:
    def make(bare):
        land, account = F.substr(bare, F.lit(1), F.lit(2)), F.substr(bare, F.lit(5), F.char_length(bare))

        def checked(own):
            check = F.lpad((98 - mod97(F.concat(own, land, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(land, check, own)

        good = mod97(F.concat(account, F.substr(bare, F.lit(1), F.lit(4)))) == 1
        return F.when(good, _written_as(_let(permute_characters(account, key, "iban"), checked), m))

    return _let(_bare(m), make)


def _ipv4(m: Column, key: str) -> Column:
    part = F.split(m, r"\.")
    number = sum(F.get(part, F.lit(i)).cast("long") * (1 << 8 * (3 - i)) for i in range(4))

    def written(n):
        return F.concat_ws(".", *[(F.shiftright(n, 8 * (3 - i)) % 256).cast("string") for i in range(4)])

    return _let(permute_number(number, (1 << 16, 1 << 16), key, "ipv4"), written)


def _late_day(number: Column, key: str) -> Column:
    """A permutation of the days after the twelfth of their month: moved on until it meets one of them."""

    def late(n):
        return F.day(F.date_add(F.lit(_FIRST_DAY).cast("date"), n.cast("int"))) > 12

    def step(acc, i):
        return F.when((i > 0) & late(acc), acc).otherwise(permute_number(acc, _DAY_RADIX, key, "date"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(_WALK)), number, step, lambda n: F.when(late(n), n))


def _date(m: Column, key: str) -> Column:
    mark = F.when(m.contains("/"), "/").when(m.contains("-"), "-").otherwise(".")
    part = F.split(F.translate(m, "/.", "--"), "-")
    one, two, three = (F.get(part, F.lit(i)) for i in range(3))
    year_first = F.char_length(one) == 4
    # Where the month comes first for certain; such dates stay among themselves, so no two values meet.
    month_first = ~year_first & (mark != ".") & (two.cast("int") > 12)
    year = F.when(year_first, one).otherwise(three)
    month, day_of = F.when(month_first, one).otherwise(two), F.when(year_first, three).when(month_first, two).otherwise(one)
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day_of, 2, "0"))
    day = F.datediff(text.try_cast("date"), F.lit(_FIRST_DAY).cast("date"))
    allowed = day.between(0, _DAY_RADIX[0] * _DAY_RADIX[1] - 1)

    def written(d):
        def field(value, shape):
            return F.when(F.char_length(shape) == 1, value.cast("string")).otherwise(F.lpad(value.cast("string"), 2, "0"))

        y, mo, da = F.year(d).cast("string"), field(F.month(d), month), field(F.day(d), day_of)
        return F.when(year_first, F.concat(y, mark, mo, mark, da)).when(month_first, F.concat(mo, mark, da, mark, y)).otherwise(F.concat(da, mark, mo, mark, y))

    number = day.cast("long")
    to = F.when(month_first, _late_day(number, key)).otherwise(permute_number(number, _DAY_RADIX, key, "date"))
    moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), to.cast("int"))
    return F.when(allowed, _let(moved, written))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.get(F.split(m, "-"), F.lit(i)).cast("long") for i in range(3))
    number = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * _SSN_RADIX[1] + serial - 1

    def written(n):
        rank = F.floor(n / (99 * _SSN_RADIX[1]))
        made = rank + F.when(rank >= 665, 2).otherwise(1), F.floor(n / _SSN_RADIX[1]) % 99 + 1, n % _SSN_RADIX[1] + 1
        return F.concat_ws("-", *[F.lpad(v.cast("string"), w, "0") for v, w in zip(made, (3, 2, 4))])

    return _let(permute_number(number, _SSN_RADIX, key, "ssn"), written)


def _key(m: Column, key: str) -> Column:
    made = permute_characters(F.lower(m), key, "key", hexadecimal=True)
    return _let(made, lambda v: F.when(m.rlike("[A-F]"), F.upper(v)).otherwise(v))


def _phone(m: Column, key: str) -> Column:
    land = F.regexp_extract(m, r"^\+[0-9]{1,3}(?![0-9])", 0)

    def make(rest):
        return F.concat(land, _written_as(permute_characters(_bare(rest), key, "phone"), rest))

    return _let(F.substr(m, F.char_length(land) + 1, F.char_length(m)), make)


_KINDS = (
    ("mail", MAIL, _mail),
    ("key", HEX, _key),
    ("iban", IBAN, _iban),
    ("ipv4", IPV4, _ipv4),
    ("date", DATE, _date),
    ("ssn", SSN, _ssn),
    ("card", CARD, _card),
    ("phone", PHONE, _phone),
)


def pseudonym(found: Column, key: str) -> Column:
    """``(kind, value)`` for a string that one of the patterns matched; the kind is null where it failed its check."""

    def judged(kind, made):
        return _let(made, lambda v: F.struct(F.when(v.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(v, found).alias("value")))

    chosen = None
    for kind, pattern, make in _KINDS:
        test = found.rlike(f"^(?:{pattern})$")
        chosen = F.when(test, judged(kind, make(found, key))) if chosen is None else chosen.when(test, judged(kind, make(found, key)))
    return chosen.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), found.alias("value")))


def pseudonymize(docs: DataFrame, key: str, text="text", kinds="pii_kinds") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the kinds found, in order, in ``kinds``."""
    found, made = f"{kinds}_found", f"{kinds}_made"
    one = docs.withColumn(found, F.regexp_extract_all(text, F.lit(ANY), 0))
    two = one.withColumn(made, F.transform(found, lambda m: pseudonym(m, key)))
    rest = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(rest, F.col(made)["value"], lambda r, v: F.concat(r, F.coalesce(v, F.lit("")))), "")
    three = two.withColumns(
        {
            text: F.when(F.size(found) > 0, joined).otherwise(F.col(text)),
            kinds: F.coalesce(F.filter(F.col(made)["kind"], lambda k: k.isNotNull()), F.array().cast("array<string>")),
        }
    )
    return three.drop(found, made)
