"""Personal data replaced by format-preserving pseudonyms, in DataFrame functions only.

One pattern finds all kinds; each find is validated and replaced, and the text between stays. Numbers of cards and IBANs
may stand beside other groups, so all strings of whole groups are tried first, and the row's pattern has the valid ones
(the longest at a place) as they are written; what is not valid hides nothing:

* ``card``: 13 to 19 digits that pass the Luhn test and begin as an issuer's do (``ISSUER``), single blanks or hyphens
  between, never both. The issuer's digits stay, those after it are permuted, and the last is set so that all pass again.
  Other numbers of this length are no cards and stay.
* ``phone``: a country code and ten digits, or ten digits in the usual groups. The ten digits are permuted.
* ``ssn``: three, two and four digits with hyphens, none of the groups that are never issued; permuted. Others stay.
* ``iban``: two letters, two right check digits and 11 to 30 letters or digits. Digits of the account are permuted and
  the check digits set again. Others stay.
* ``ip``: four numbers up to 255; permuted among all addresses. Others are no address and stay.
* ``date``: year-month-day, or day and month in either order with a four-digit year, that exist and lie in
  ``FIRST_DAY`` and the ``DAYS`` days from it; permuted among those days. Others stay.
* ``email``: the part before the sign becomes ``u`` and sixteen digits that depend on the whole address in lower case,
  the domain becomes ``example.invalid``.

The permutation is a Feistel network over two halves that adds, in turn, a keyed digest (SHA-256) of one half to the
other modulo its own range. It is a bijection on the values of a format, so equal values stay equal across documents,
different ones stay different, and nothing has to be stored or joined.

Defined cases: a null text stays null; an empty text stays empty; repeated rows give repeated results; an empty table
gives an empty result; other columns, of any name, are as they were; a text of any length is searched whole, and of
finds that overlap the first in the order above at the first place wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import fresh, table

KEY = "pseudonyms"  # a deployment passes its own
ROUNDS = 8
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 270, 271  # DAYS_A * DAYS_B days, to 2100-05

# The formats, in the order in which they are tried at a place. No word character touches a number.
_START, _STOP = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
EMAIL = r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
PHONE = r"(?:\+[0-9]{1,3}[ .\-]?)(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|\([0-9]{3}\) ?[0-9]{3}[ .\-]?[0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9](?:[ \-]?[0-9]){12,18}"
ISSUER = r"^(?:4|5[0-9]|22(?:2[1-9]|[3-9][0-9])|2[3-6][0-9]{2}|27(?:[01][0-9]|20)|3[4-9]|6[0-9])"
KINDS = {"email": EMAIL, "iban": IBAN, "phone": PHONE, "ip": IP, "date": DATE, "ssn": SSN, "card": CARD}
PATTERN = (EMAIL + "|" + _START + r"(?:" + IBAN + ")" + _STOP + r"|(?<![\p{L}\p{N}_+])(?:" + PHONE + ")" + _STOP + "|" + _START + "(?:"
           + "|".join([SSN, IP, DATE, CARD]) + ")" + _STOP)
# Strings of whole groups that may be a card or an IBAN, from every place: one pattern for each length.
_CARDS = [_START + r"(?=([0-9](?:[ \-]?[0-9]){%d})" % (n - 1) + _STOP + ")" for n in range(13, 20)]
_IBANS = [_START + r"(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){%d}%s)" % (n, end) + _STOP + ")"
          for n in range(2, 8) for end in ("", " ?[A-Z0-9]{1,3}")]
_USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{3})?|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5})$"


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted(key: Column, label: Column, a: Column, b: Column, mod_a: Column, mod_b: Column) -> Column:
    """``struct(a, b)`` under the Feistel network on pairs below ``mod_a`` and ``mod_b``."""

    def step(pair: Column, round_: Column) -> Column:
        digest = lambda half, modulus: F.conv(F.substring(F.sha2(F.concat_ws(
            "|", key, label, round_.cast("string"), half.cast("string")), 256), 1, 15), 16, 10).cast("long") % modulus
        even = round_ % 2 == 0
        return F.struct(
            F.when(even, (pair["a"] + digest(pair["b"], mod_a)) % mod_a).otherwise(pair["a"]).alias("a"),
            F.when(even, pair["b"]).otherwise((pair["b"] + digest(pair["a"], mod_b)) % mod_b).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _ten_to(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def permuted_digits(key: Column, label: str, digits: Column) -> Column:
    """A digit string of two to twenty digits under the network, as long as before."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    a, b = F.substring(digits, 1, left), F.substring(digits, left + 1, n - left)
    tag = F.concat(F.lit(label), n.cast("string"))
    pair = permuted(key, tag, a.cast("long"), b.cast("long"), _ten_to(left), _ten_to(n - left))
    return _let(pair, lambda p: F.concat(F.lpad(p["a"].cast("string"), left, "0"), F.lpad(p["b"].cast("string"), n - left, "0")))


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by ``digits``."""
    step = lambda acc, c: F.when(
        c.between("0", "9"),
        F.struct(F.concat(acc["out"], F.substring(acc["rest"], 1, 1)).alias("out"), F.substring(acc["rest"], 2, 100).alias("rest")),
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["rest"].alias("rest")))
    start = F.struct(F.lit("").alias("out"), digits.alias("rest"))
    return F.aggregate(F.filter(F.split(form, ""), lambda c: c != ""), start, step, lambda acc: acc["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted once."""
    backwards = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(backwards, value), F.lit(0), lambda acc, x: acc + x)


def _card(key: Column, found: Column) -> Column:
    digits = only_digits(found)

    def valid(d: Column) -> Column:
        issuer = F.regexp_extract(d, ISSUER, 0)
        inner = permuted_digits(key, "card", F.substring(d, F.length(issuer) + 1, F.length(d) - F.length(issuer) - 1))
        body = F.concat(issuer, inner)
        return _let(body, lambda x: F.concat(x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))

    return _let(digits, lambda d: F.when(d.rlike(ISSUER) & (luhn_sum(d) % 10 == 0), filled(found, valid(d))).otherwise(found))


def _ssn(key: Column, found: Column) -> Column:
    given = ~found.rlike("^(?:000|666|9)") & ~found.rlike("-00-") & ~found.rlike("-0000$")  # never issued
    return F.when(given, filled(found, permuted_digits(key, "ssn", only_digits(found)))).otherwise(found)


def _phone(key: Column, found: Column) -> Column:
    digits = only_digits(found)
    return _let(digits, lambda d: filled(found, F.concat(
        F.substring(d, F.lit(1), F.length(d) - 10), permuted_digits(key, "phone", F.substring(d, -10, 10)))))


def _ip(key: Column, found: Column) -> Column:
    parts = F.transform(F.split(found, r"\."), lambda x: x.cast("long"))

    def new(o: Column) -> Column:
        pair = permuted(key, F.lit("ip"), F.get(o, 0) * 256 + F.get(o, 1), F.get(o, 2) * 256 + F.get(o, 3), F.lit(65536), F.lit(65536))
        return _let(pair, lambda p: F.concat_ws(".", *[
            x.cast("string") for half in ("a", "b") for x in (F.floor(p[half] / 256), p[half] % 256)]))

    return _let(parts, lambda o: F.when(F.forall(o, lambda x: x <= 255), new(o)).otherwise(found))


def _date(key: Column, found: Column) -> Column:
    parts = F.split(found, "[-/.]")

    def new(day: Column, show) -> Column:
        number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        pair = permuted(key, F.lit("date"), F.floor(number / DAYS_B), number % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B))
        moved = _let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["a"] * DAYS_B + p["b"]).cast("int")))
        inside = day.isNotNull() & (number >= 0) & (number < DAYS_A * DAYS_B)
        return F.when(inside, _let(moved, show)).otherwise(found)

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    first_year = F.length(F.get(parts, 0)) == 4
    sign = F.substring(found, F.length(F.get(parts, 0)) + 1, F.lit(1))
    day_first = day(F.get(parts, 2), F.get(parts, 1), F.get(parts, 0))
    month_first = day(F.get(parts, 2), F.get(parts, 0), F.get(parts, 1))
    shown = lambda pattern: lambda x: F.concat(
        F.date_format(x, pattern[0]), sign, F.date_format(x, pattern[1]), sign, F.date_format(x, "yyyy"))
    return F.when(first_year, new(day(F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)), lambda x: F.date_format(x, "yyyy-MM-dd"))) \
        .when(day_first.isNotNull(), new(day_first, shown(("dd", "MM")))).otherwise(new(month_first, shown(("MM", "dd"))))


def _rest(text: Column) -> Column:
    """Letters and digits as a number, modulo 97."""
    letter = lambda c: F.when(c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string"))
    number = lambda t: F.array_join(F.transform(F.filter(F.split(t, ""), lambda c: c != ""), letter), "")
    return F.aggregate(
        F.filter(F.split(number(text), ""), lambda c: c != ""), F.lit(0), lambda acc, c: (acc * 10 + c.cast("int")) % 97)


def _iban(key: Column, found: Column) -> Column:
    plain = F.regexp_replace(found, " ", "")
    country, check, account = F.substring(plain, 1, 2), F.substring(plain, 3, 2), F.substring(plain, 5, 40)
    valid = _rest(F.concat(account, country, check)) == 1
    digits = only_digits(account)
    # up to 30 digits: halves of at most fifteen
    moved = F.when(F.length(digits) < 2, account).otherwise(filled(account, permuted_digits(key, "iban", digits)))

    def whole(new: Column) -> Column:
        new_check = F.lpad((98 - _rest(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(new_check, only_digits(new))

    return F.when(valid, filled(found, _let(moved, whole))).otherwise(found)


def _email(key: Column, found: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", key, F.lit("email"), F.lower(found)), 256)
    number = F.lpad(F.conv(F.substring(digest, 1, 13), 16, 10), 16, "0")
    return F.concat(F.lit("u"), number, F.lit("@example.invalid"))


def kind_of(found: Column) -> Column:
    """Kind of a find; the tests are as exclusive as the pattern's order."""
    out = F.when(found.contains("@"), F.lit("email"))
    for kind in ("iban", "phone", "ssn", "ip", "date"):
        out = out.when(found.rlike(f"^(?:{KINDS[kind]})$"), F.lit(kind))
    return out.otherwise(F.lit("card"))


def pseudonym(found: Column, key: Column) -> Column:
    """What replaces a find; a find that is not valid stays."""
    by_kind = {"iban": _iban, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date, "card": _card}
    kind = kind_of(found)
    out = F.when(kind == "email", _email(key, found))
    for name, new in by_kind.items():
        out = out.when(kind == name, new(key, found))
    return out


def valid_cards(text: Column) -> Column:
    """Cards in a text, the longest first. A string in no usual form that ends inside a card in a usual form is none."""

    def good(cards: Column) -> Column:
        usual = F.filter(cards, lambda c: c.rlike(_USUAL))

        def cut(c: Column) -> Column:
            inside = lambda i: lambda u: (
                u.startswith(F.substring(c, i, F.length(c))) & (F.length(u) > F.length(c) - i + 1)
                & F.contains(text, F.concat(F.substring(c, F.lit(1), i - 1), u)))
            starts = F.filter(F.sequence(F.lit(2), F.length(c)), lambda i: F.substring(c, i - 1, F.lit(1)).isin(" ", "-"))
            return F.exists(starts, lambda i: F.exists(usual, inside(i)))

        return F.filter(cards, lambda c: c.rlike(_USUAL) | ~cut(c))

    every = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), 1) for p in reversed(_CARDS)])))
    # a blank and a hyphen in one number part two numbers
    found = F.filter(every, lambda c: ~(c.contains(" ") & c.contains("-")) & _let(
        only_digits(c), lambda d: d.rlike(ISSUER) & (luhn_sum(d) % 10 == 0)))
    return F.when(text.rlike(_START + CARD), _let(found, good)).otherwise(F.array().cast("array<string>"))


def valid_ibans(text: Column) -> Column:
    """IBANs in a text, the longest first."""
    every = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), 1) for p in reversed(_IBANS)])))
    turned = lambda x: F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 4))
    found = F.filter(every, lambda x: _rest(turned(F.regexp_replace(x, " ", ""))) == 1)
    return F.when(text.rlike(_START + IBAN), found).otherwise(F.array().cast("array<string>"))


def pattern_of(text: Column) -> Column:
    """The pattern of a text's finds: its valid cards and IBANs as written, the other kinds by their form."""
    listed = lambda x: F.when(F.size(x) > 0, F.array_join(x, "|")).otherwise("(?!)")
    return F.concat(F.lit(EMAIL + "|" + _START + "(?:"), _let(valid_ibans(text), listed),
                    F.lit(")" + _STOP + r"|(?<![\p{L}\p{N}_+])(?:" + PHONE + ")" + _STOP + "|" + _START + "(?:"
                          + "|".join([SSN, IP, DATE]) + "|"), _let(valid_cards(text), listed), F.lit(")" + _STOP))


def pseudonymise(docs: DataFrame, key: str = KEY, text_column: str = "text", kinds_column: str | None = None) -> DataFrame:
    """``docs`` with personal data in the text replaced; ``kinds_column`` names a column for the kinds found, in order.

    Texts without a find are not taken apart.
    """
    text = F.col(text_column)
    old, new_ones, pattern = fresh(docs, "found"), fresh(docs, "pseudonyms"), fresh(docs, "pattern")
    some = docs.withColumn(pattern, F.when(text.rlike(PATTERN), pattern_of(text)))
    found = some.withColumn(old, F.when(F.col(pattern).isNotNull(), F.regexp_extract_all(text, F.col(pattern), F.lit(0))))
    secret = F.lit(key)
    new = found.withColumn(new_ones, F.transform(old, lambda m: pseudonym(m, secret)))
    between = F.split(text, F.col(pattern), -1)
    pairs = F.zip_with(between, F.concat(F.col(new_ones), F.array(F.lit(""))), lambda t, p: F.concat(t, p))
    joined = F.array_join(pairs, "")
    out = new.withColumn(text_column, F.when(F.col(old).isNull(), text).otherwise(joined))
    if kinds_column:
        kinds = F.zip_with(old, new_ones, lambda m, p: F.when(m != p, kind_of(m)))  # nulls are not joined
        out = out.withColumn(kinds_column, F.coalesce(F.array_join(kinds, ","), F.lit("")))
    return out.drop(old, new_ones, pattern)


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced, and the kinds that were found in each."""
    return pseudonymise(table(spark, sf_dir, "documents"), kinds_column="kinds")


QUERIES = {"op5_pii_pseudonyms": op5_pii_pseudonyms}
SQL: dict[str, str] = {}
