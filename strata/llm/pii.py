"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found and checked values are replaced by other values of the same format through keyed
permutations (Feistel networks whose round function is SHA-256 with the key), so
equal values get equal pseudonyms in every document, different values different
ones, and whoever holds the key can go back (``decrypt``).

========== ============================ =============================================
kind       found, and checked by        permuted
========== ============================ =============================================
card       13 to 19 digits, Luhn        the digits but the last; that is the check digit
phone      + country (area) number,     the digits behind the first; signs stay
           9 to 15 digits; national
           forms with a bracketed area,
           of 3-3-4 digits, or from 0 on
national   ddd-dd-dddd                  the digits
ip         four numbers up to 255       the 32 bits
date       yyyy-mm-dd, yyyy/mm/dd,      the day within the 400 years from 1800 on; the
           dd.mm.yyyy, mm/dd/yyyy,      format stays
           a day of the calendar
iban       two letters, two digits,     letters and digits behind the check digits, which
           11 to 30 more, modulo 97     are computed anew
email      name@host                    letters and digits of the name and of the host's
                                        first label, each within its class
secret     key=value (password, secret, letters and digits, each within its class
           token, api_key, ...; quoted
           or spaced with a digit or
           sign in the value), AKIA,
           ghp_ and sk- keys, eyJ...
           tokens of two or three parts
========== ============================ =============================================

A match that fails its check stays as it is.  A run of groups of digits may hold a card and its
neighbours (security code, expiry, quantity): its stretches of whole groups are tried, groups of 13 to 19
digits and the groupings that cards are printed in first, then the whole run, all neighbouring groups of one size
(however many), and others of at most ``GROUPS`` groups (``stretches``): any stretch of a table of numbers would fit by chance.  An IBAN ends where its country's length does; of
other countries the last groups go until modulo 97 fits (one text in 97 with such a group behind may not go back).  A pseudonym that would make
another stretch of its run fit is permuted again (``WALK`` times at most), so ``decrypt`` finds the same
stretches; such a run's card has a pseudonym of its own there.  Digits are permuted as numbers of up to 9
digits a half; other values character by character, the halves of a value
turning each other (classes a-z, A-Z, 0-9; other characters stay).

Defined results: null stays null and a text without matches stays the same text, byte for
byte; repeated rows get the same pseudonyms; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 6
DAYS_A, DAYS_B = 189, 773            # their product: the days of 400 years
SECRET_NAMES = "password|passwd|pwd|secret|token|api_key|apikey|access_key|auth"

GROUPS = 6                           # groups of digits in a stretch of a run
WALK = 32                            # times that a run is permuted again
WALK_GROUPS = 64                     # in longer runs of groups once: numbers in tables

# How cards are printed, by the digits of their groups.
PRINTED = ["4 4 4 4", "4 6 5", "4 6 4", "4 4 4 4 3", "4 4 4 4 2", "4 4 4 4 1", "6 13"]

# Lengths of IBANs by country (ISO 13616 registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{groups}}}" \
        + (rf"[ ]?[A-Z0-9]{{{rest}}}\b" if rest else r"\b")


_NATIONAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])"
_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|" \
        r"[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z])"
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"

# A secret's value: with a digit or a sign in it, up to white space, a quote or a comma (a full stop behind it is not part
# of it); or letters and digits alone, directly behind the name.
_SIGNED = r"""(?=[^\s"'<>,;]*[0-9@!#$%^&*])[^\s"'<>,;]{5,}(?<![.:!?)\]}])"""
_PLAIN = r"[A-Za-z0-9_\-/+]{6,}+"
_ASSIGNED = r"(?i:\b(?:" + SECRET_NAMES + r")[=:][ ]?)"
_SPACED = r"""(?i:\b(?:""" + SECRET_NAMES + r""")["']?[ ]{0,2}(?:=>|:=|[=:])[ ]{0,2}["']?)"""

# The formats, by kind, in the order in which they are tried.  Java regular expressions.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}",
    "secret": rf"{_ASSIGNED}(?:{_SIGNED}|{_PLAIN})|{_SPACED}{_SIGNED}"
              r"|\beyJ[A-Za-z0-9_\-]{8,}+(?:\.[A-Za-z0-9_\-]++){1,2}"
              r"|\bAKIA[0-9A-Z]{16}\b|\bghp_[A-Za-z0-9]{20,}+\b|\bsk-(?:[a-z]{2,12}-)*[A-Za-z0-9_]{16,}+\b",
    "iban": r"\b(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items()) + r"|[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)",
    # With the country, with the area in brackets, in groups of 3, 3 and 4, and an area that begins with 0.
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .\-]?\(?[0-9]{2,4}\)?[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9A-Za-z+])\([0-9]{2,5}\)[ ]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9A-Za-z]|[ .\-][0-9])"
             r"|(?<![0-9A-Za-z+.\-])[0-9]{3}([.\-])[0-9]{3}\2[0-9]{4}(?![0-9A-Za-z]|[.\-][0-9])"
             r"|(?<![0-9A-Za-z+.\-])(?<![0-9][ ])0[0-9]{1,4}[ /][0-9]{5,8}(?![0-9A-Za-z]|[ .\-][0-9])",
    "national": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "date": r"(?<![0-9A-Za-z])(?:[0-9]{4}([\-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|"
            r"[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z])",
    # A run of groups, up to a letter or a value of another format.
    "card": r"(?<![0-9A-Za-z.+\-])(?=[0-9](?:[ \-]?[0-9]){12})[0-9]++(?![A-Za-z])"
            rf"(?:[ \-](?!{_NATIONAL}|{_DATE}|{_IP})[0-9]++(?![A-Za-z]))*+",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
}
#: What every format has somewhere; a text without it is not searched.
HINT = r"[0-9]|@|[=:]|AKIA|ghp_|sk-|eyJ"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once."""
    return F.transform(F.array(value), body)[0]


def _number(key: str, name: str, turn: int, other: Column) -> Column:
    """60 bits that depend on the key, the kind, the round and the other half."""
    said = F.concat(F.lit(f"{key}|{name}|{turn}|"), other.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, m: Column, n: Column, key: str, name: str,
            back: bool = False) -> Column:
    """struct<l, r>: the keyed permutation of pairs (below m, below n); ``back`` undoes it."""
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    sign = -1 if back else 1
    def step(turn):
        moved = (lambda s: (s["l"], s["r"], m)) if turn % 2 == 0 else (lambda s: (s["r"], s["l"], n))

        def body(s):
            own, other, size = moved(s)
            new = F.pmod(own + sign * F.pmod(_number(key, name, turn, other), size), size)
            return F.struct(*((new.alias("l"), s["r"].alias("r")) if turn % 2 == 0
                              else (s["l"].alias("l"), new.alias("r"))))
        return body

    for turn in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        state = _let(state, step(turn))
    return state


def _power(k: Column) -> Column:
    return F.rpad(F.lit("1"), (k + 1).cast("int"), "0").cast("long")


def permute_digits(d: Column, key: str, name: str, back: bool = False) -> Column:
    """A string of 2 to 18 digits as another of the same length."""
    half = F.floor(F.length(d) / 2).cast("int")
    rest = F.length(d) - half
    return _let(
        feistel(F.substr(d, F.lit(1), half).cast("long"), F.substr(d, half + 1, rest).cast("long"),
                _power(half), _power(rest), key, name, back),
        lambda s: F.concat(F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), rest, "0")))


def _refill(format_: Column, digits: Column) -> Column:
    """The format with its digits replaced in order."""
    chars = F.split(format_, "")
    numbered = F.transform(F.sequence(F.lit(1), F.size(chars)), lambda i: F.when(
        F.get(chars, i - 1).rlike("^[0-9]$"),
        F.substr(digits, F.length(F.regexp_replace(F.substr(format_, F.lit(1), i), "[^0-9]", "")).cast("int"),
                 F.lit(1))).otherwise(F.get(chars, i - 1)))
    return F.array_join(numbered, "")


def _only_digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit behind a string of digits."""
    total = F.aggregate(
        F.split(F.reverse(payload), ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")),
        lambda a, c: F.struct(
            (a["s"] + F.when(a["i"] % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9)
                             .otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))).alias("s"),
            (a["i"] + 1).alias("i")), lambda a: a["s"])
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _is_card(d: Column) -> Column:
    return luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d), F.lit(1))


def _one_card(d: Column, key: str, back: bool) -> Column:
    payload = F.substr(d, F.lit(1), F.length(d) - 1)
    return _let(permute_digits(payload, key, "card", back), lambda p: F.concat(p, luhn_digit(p)))


def _alike(sizes: Column) -> Column:
    """For each group how many groups from it on have its number of digits."""
    back = F.aggregate(F.reverse(sizes), F.array().cast("array<struct<s:int,n:int>>"), lambda a, s: F.concat(
        F.array(F.struct(s.alias("s"), F.when(F.get(a, F.lit(0))["s"] == s, F.get(a, F.lit(0))["n"] + 1).otherwise(1).alias("n"))), a))
    return F.transform(back, lambda x: x["n"])


def _scan(groups: Column, sizes: Column, equal: Column, taken: Column, tried: list[int], printed: bool) -> Column:
    """For each group the number of groups of the stretch that starts there (0: none), from the left.
    Numbers of groups are ``tried`` in order (0: the whole run, -1: all neighbouring groups of one size); ``taken`` are
    stretches that are found already."""
    def step(a, i):
        def fits(m):
            own = F.slice(sizes, i + 1, m)
            shape = F.array_join(own, " ").isin([str(n) for n in range(13, 20)] + PRINTED) if printed else \
                F.aggregate(own, F.lit(0), lambda s, x: s + x).between(13, 19)
            return (i + m <= F.size(groups)) & shape & ~F.exists(F.slice(taken, i + 1, m), lambda x: x != 0) \
                & _is_card(F.array_join(F.slice(groups, i + 1, m), ""))
        alike = F.when((i == 0) | (F.get(sizes, i - 1) != F.get(sizes, i)), F.get(equal, i)).otherwise(1)
        own = {0: F.when(i == 0, F.size(groups)).otherwise(1), -1: alike}
        those = F.array(*(own.get(m, F.lit(m)) for m in tried))
        found = F.when(i < a["next"], 0).otherwise(F.greatest(F.get(taken, i), F.coalesce(F.get(F.filter(those, fits), F.lit(0)), F.lit(0))))
        return _let(found.cast("int"), lambda m: F.struct(
            F.concat(a["out"], F.array(m)).alias("out"), F.greatest(a["next"], i + m).alias("next")))

    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("next"))
    return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda a: a["out"])


def stretches(groups: Column) -> Column:
    """The cards among groups of digits, as numbers of groups by first group."""
    def body(sizes):
        # Of many groups only where nothing else stands with them: numbers in tables are no cards.
        def scans(equal):
            first = _scan(groups, sizes, equal, F.transform(sizes, lambda _: F.lit(0)), [1, 4, 3, 5, 2], True)
            return _let(first, lambda taken: _scan(groups, sizes, equal, taken, [0, -1, *range(GROUPS, 1, -1)], False))
        return _let(_alike(sizes), scans)
    return _let(F.transform(groups, F.length), body)


def _exchanged(groups: Column, cut: Column, key: str, back: bool) -> Column:
    """The groups with the stretches ``cut`` permuted."""
    def step(a, i):
        m = F.get(cut, i)
        own = F.slice(groups, i + 1, m)

        def dealt(new):
            at = lambda j: F.aggregate(F.slice(own, 1, j), F.lit(0), lambda s, x: s + F.length(x))
            return F.transform(own, lambda x, j: F.substr(new, at(j) + 1, F.length(x)))
        return F.when(m > 0, F.struct(F.concat(a["out"], _let(
            _one_card(F.array_join(own, ""), key, back), dealt)).alias("out"), (i + m).alias("next"))) \
            .when(i >= a["next"], F.struct(F.concat(a["out"], F.array(F.get(groups, i))).alias("out"),
                                           a["next"].alias("next"))).otherwise(a)

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("next"))
    return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda a: a["out"])


def _cards(v: Column, groups: Column, key: str, back: bool) -> Column:
    """The run ``v`` with the cards among its groups permuted."""
    def body(cut):
        again = lambda s, _: F.when(s["done"], s).otherwise(_let(
            _exchanged(s["g"], cut, key, back), lambda g: F.struct(g.alias("g"), (stretches(g) == cut).alias("done"))))
        times = F.when(F.size(groups) <= WALK_GROUPS, WALK).otherwise(1)
        new = F.aggregate(F.sequence(F.lit(1), times), F.struct(groups.alias("g"), F.lit(False).alias("done")),
                          again, lambda s: F.array_join(s["g"], ""))
        return F.when(F.exists(cut, lambda m: m > 0), _let(new, lambda n: _refill(v, n))).otherwise(v)
    return _let(stretches(groups), body)


def card(v: Column, key: str, back: bool = False) -> Column:
    alone = F.when(F.length(v).between(13, 19) & _is_card(v), _one_card(v, key, back)).otherwise(v)
    return F.when(v.rlike("^[0-9]+$"), alone).otherwise(
        _let(F.split(v, "[ -]"), lambda g: _cards(v, g, key, back)))


def phone(v: Column, key: str, back: bool = False) -> Column:
    return _let(_only_digits(v), lambda d: _let(
        F.concat(F.substr(d, F.lit(1), F.lit(1)),
                 permute_digits(F.substr(d, F.lit(2), F.length(d) - 1), key, "phone", back)),
        lambda n: _refill(v, n)))


def national(v: Column, key: str, back: bool = False) -> Column:
    return _let(permute_digits(_only_digits(v), key, "national", back), lambda n: F.concat_ws(
        "-", F.substr(n, F.lit(1), F.lit(3)), F.substr(n, F.lit(4), F.lit(2)), F.substr(n, F.lit(6), F.lit(4))))


def ip(v: Column, key: str, back: bool = False) -> Column:
    def body(p):
        half = F.lit(65536).cast("long")
        new = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], half, half, key, "ip", back)
        text = _let(new, lambda s: F.concat_ws(
            ".", F.shiftright(s["l"], 8).cast("string"), (s["l"] % 256).cast("string"),
            F.shiftright(s["r"], 8).cast("string"), (s["r"] % 256).cast("string")))
        # A number written with a leading zero is no address.
        return F.when(F.forall(p, lambda x: x <= 255) & ~v.rlike(r"(^|\.)0[0-9]"), text).otherwise(v)
    return _let(F.transform(F.split(v, r"\."), lambda x: x.cast("long")), body)


def date(v: Column, key: str, back: bool = False) -> Column:
    def of(pattern: str) -> Column:
        # try_to_timestamp also takes 31 April in some parsers: the day has to come back as it was.
        day = F.to_date(F.try_to_timestamp(v, F.lit(pattern)))
        first = F.lit("1800-01-01").cast("date")
        n = F.datediff(day, first).cast("long")
        new = _let(feistel(F.floor(n / DAYS_B), n % DAYS_B, F.lit(DAYS_A).cast("long"),
                           F.lit(DAYS_B).cast("long"), key, "date", back),
                   lambda s: F.date_add(first, (s["l"] * DAYS_B + s["r"]).cast("int")))
        return F.when((F.date_format(day, pattern) == v) & (n >= 0) & (n < DAYS_A * DAYS_B),
                      F.date_format(new, pattern)).otherwise(v)
    return F.when(v.rlike(r"^\d{4}-"), of("yyyy-MM-dd")).when(v.rlike(r"^\d{4}/"), of("yyyy/MM/dd")) \
        .when(v.rlike(r"^\d\d\."), of("dd.MM.yyyy")).otherwise(of("MM/dd/yyyy"))


def _turn(part: Column, other: Column, key: str, name: str, turn: int, sign: int) -> Column:
    """Each letter and digit of ``part`` moved within its class by a number of the other half."""
    def move(c, i, half):
        code = F.ascii(c)
        # 32 characters take two bytes each from one digest; a longer half takes further digests.
        digest = F.sha2(F.concat(F.lit(f"{key}|{name}|{turn}|"), F.floor(i / 32).cast("string"), F.lit("|"), half), 512)
        k = F.conv(F.substr(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int") * sign
        shift = lambda first, size: F.char(F.pmod(code - first + k, F.lit(size)) + first)
        return F.when(c.rlike("^[0-9]$"), shift(48, 10)).when(c.rlike("^[A-Z]$"), shift(65, 26)) \
            .when(c.rlike("^[a-z]$"), shift(97, 26)).otherwise(c)
    # The other half goes in as one digest, so a long value takes time in proportion to its length.
    return F.aggregate(F.array(F.sha2(other, 256)), F.lit(""), lambda _, half: F.array_join(
        F.transform(F.split(part, ""), lambda c, i: move(c, i, half)), ""))


def permute_text(v: Column, key: str, name: str, back: bool = False) -> Column:
    """A text with its letters and digits permuted within their classes; a network over its two halves."""
    half = F.floor(F.length(v) / 2).cast("int")
    state = F.struct(F.substr(v, F.lit(1), half).alias("l"), F.substr(v, half + 1, F.length(v)).alias("r"))
    sign = -1 if back else 1
    def step(turn):
        if turn % 2 == 0:
            return lambda s: F.struct(_turn(s["l"], s["r"], key, name, turn, sign).alias("l"), s["r"].alias("r"))
        return lambda s: F.struct(s["l"].alias("l"), _turn(s["r"], s["l"], key, name, turn, sign).alias("r"))

    for turn in (reversed(range(4)) if back else range(4)):
        state = _let(state, step(turn))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def email(v: Column, key: str, back: bool = False) -> Column:
    """The name and the host's first label change; the rest of the host stays."""
    name, host = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    label = F.substring_index(host, ".", 1)
    return _let(permute_text(F.concat(name, F.lit("@"), label), key, "email", back), lambda n: F.concat(
        n, F.substr(host, F.length(label) + 1, F.length(host))))


def secret(v: Column, key: str, back: bool = False) -> Column:
    """What stands behind ``=``, ``:`` or a key's fixed beginning."""
    head = F.regexp_extract(v, rf"^(?:{_SPACED}|AKIA|ghp_|sk-(?:[a-z]{{2,12}}-)*|eyJ)", 0)
    return F.concat(head, permute_text(F.substr(v, F.length(head) + 1, F.length(v)), key, "secret", back))


def _mod97(text: Column) -> Column:
    """A text of digits and capital letters (A = 10) modulo 97."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("^[0-9]$"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _one_iban(v: Column, key: str, back: bool) -> Column:
    """Null if modulo 97 does not fit."""
    def body(d):
        country, rest = F.substr(d, F.lit(1), F.lit(2)), F.substr(d, F.lit(5), F.length(d))
        new = _let(permute_text(rest, key, "iban", back), lambda r: F.concat(
            country, F.lpad((98 - _mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))
        spaced = F.trim(F.regexp_replace(new, "(.{4})", "$1 "))
        return F.when(_mod97(F.concat(rest, F.substr(d, F.lit(1), F.lit(4)))) == 1,
                      F.when(v.contains(" "), spaced).otherwise(new))
    return _let(F.regexp_replace(v, " ", ""), body)


def iban(v: Column, key: str, back: bool = False) -> Column:
    """The longest beginning of whole groups that fits; what stands behind it stays."""
    def body(g):
        def step(a, k):
            head = F.array_join(F.slice(g, 1, k), " ")
            return F.when(a.isNotNull(), a).otherwise(F.when(
                F.length(F.regexp_replace(head, " ", "")) >= 12, _let(head, lambda h: F.concat(
                    _one_iban(h, key, back), F.substr(v, F.length(h) + 1, F.length(v))))))
        return F.coalesce(F.aggregate(F.sequence(F.size(g), F.lit(1), F.lit(-1)),
                                      F.lit(None).cast("string"), step), v)
    return _let(F.split(v, " "), body)


KINDS: dict[str, Callable[..., Column]] = {
    "email": email, "secret": secret, "iban": iban, "phone": phone, "card": card,
    "national": national, "date": date, "ip": ip}


def _numbered(kind: str) -> str:
    # The date's own group gets a name, so that formats can stand next to each other.
    return FORMATS[kind].replace(r"([\-/])", r"(?<sign>[\-/])").replace(r"\1", r"\k<sign>") \
        .replace(r"([.\-])", r"(?<gap>[.\-])").replace(r"\2", r"\k<gap>")


def replacement(v: Column, key: str, kinds: list[str], back: bool = False) -> Column:
    """The pseudonym of one match: by the first format that it has as a whole."""
    out = None
    for kind in kinds:
        is_it = v.rlike(f"^(?:{_numbered(kind)})$")
        new = KINDS[kind](v, key, back)
        out = F.when(is_it, new) if out is None else out.when(is_it, new)
    return out.otherwise(v)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", kinds: list[str] | None = None,
                 decrypt: bool = False) -> DataFrame:
    """The documents with the values of ``kinds`` (all by default) replaced in ``text``.

    One pass finds the matches and one cuts the text at them; both are regular expressions over the
    same text, so pieces and matches alternate."""
    kinds = [k for k in FORMATS if kinds is None or k in kinds]
    pattern = "|".join(f"(?:{_numbered(k)})" for k in kinds)
    t = F.col(text).cast("string")
    both = F.struct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"), F.split(t, pattern, -1).alias("cut"))
    new = _let(both, lambda x: F.when(F.size(x["m"]) == 0, t).otherwise(F.concat(
        F.array_join(F.zip_with(
            F.slice(x["cut"], F.lit(1), F.size(x["m"])),
            F.transform(x["m"], lambda v: replacement(v, key, kinds, decrypt)), lambda a, b: F.concat(a, b)), ""),
        F.element_at(x["cut"], -1))))
    columns = [F.when(t.rlike(HINT), new).otherwise(t).alias(c) if c == text else F.col(c) for c in docs.columns]
    return docs.select(*columns)


def counted(docs: DataFrame, row_id: str = "doc_id", text: str = "text", kinds: list[str] | None = None) -> DataFrame:
    """``id`` and the number of places that have a format, checked or not."""
    kinds = [k for k in FORMATS if kinds is None or k in kinds]
    pattern = "|".join(f"(?:{_numbered(k)})" for k in kinds)
    return docs.select(F.col(row_id).alias("id"), F.coalesce(
        F.regexp_count(F.col(text).cast("string"), F.lit(pattern)), F.lit(0)).cast("long").alias("n_places"))
