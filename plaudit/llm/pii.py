"""Personal data replaced by format-preserving pseudonyms, in SQL functions only.

Numbers and dates are validated and moved by a keyed permutation of the valid
values of their own format: a Feistel network over Z_a x Z_b with modular
addition, where a * b is exactly the number of valid values, so a pseudonym is
valid again, two values never meet, and equal values get equal pseudonyms in
every document. ``back=True`` undoes it.

==========  =================================================  ===================================
kind        found and valid                                    permuted
==========  =================================================  ===================================
card        13-19 digits, plain or in fours, Luhn sum valid    all but the check digit; it is
                                                               computed anew
ssn         ddd-dd-dddd, area not 000, 666 or 9xx, group       area and group x serial
            not 00, serial not 0000
phone       NANP shape, ten digits, with or without +1         the ten digits
ip          four numbers up to 255                             the 32 bits
date        yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy, a calendar   the days 1900-01-01 .. 2099-12-31
            date of 1900-2099
email       local@domain, domain kept                          local part: keyed digest, one way
==========  =================================================  ===================================

What fails validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_text

# Possessive quantifiers and look-behinds keep every pattern linear on texts
# without blanks.
_EMAIL = r"(?<![\p{L}0-9._+-])[\p{L}0-9._+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP = rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])"
_DATE = (r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
         r"(?![0-9A-Za-z]|[./-][0-9])")
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"
_PHONE = (r"(?<![0-9A-Za-z+.-])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
          r"(?![0-9A-Za-z]|[.-][0-9])")
_CARD = (r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9A-Za-z]|[.-][0-9])")
_ANY = "|".join((_EMAIL, _IP, _DATE, _SSN, _PHONE, _CARD))
# No match without one of these: most texts stop here.
_HINT = r"@|[0-9][0-9 ()./+-]{5,}[0-9]"

KINDS = ("email", "ip", "date", "ssn", "phone", "card")
_ROUNDS = 8
_FIRST_DAY, _DAYS_A, _DAYS_B = "1900-01-01", 229, 319  # 229 * 319 days


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def kind_of(m: Column) -> Column:
    """Kind of a match, null where it fails validation."""
    digits = _digits(m)
    day = _day(m)
    return (F.when(m.contains("@"), "email")
            .when(m.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})$"),
                  F.when(day.isNotNull() & (F.year(day) >= 1900) & (F.year(day) <= 2099), "date"))
            .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
                  F.when(~m.rlike("^(000|666|9)") & ~m.contains("-00-") & ~m.endswith("-0000"), "ssn"))
            .when(m.rlike(r"^(\+?1[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"), "phone")
            .when(F.call_function("luhn_check", digits), "card"))


def _day(m: Column) -> Column:
    return F.coalesce(
        F.when(m.rlike("^[0-9]{4}-"), F.try_to_date(m, "yyyy-MM-dd")),
        F.when(m.rlike("^[0-9]{2}/"), F.try_to_date(m, "dd/MM/yyyy")),
        F.when(m.rlike(r"^[0-9]{2}\."), F.try_to_date(m, "dd.MM.yyyy")))


def _keyed(key: str, purpose: str, i: Column, x: Column) -> Column:
    """60 pseudo-random bits of a round."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(purpose), i, x).cast("binary"), 256), 1, 15),
                  16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, purpose: str, back: bool = False) -> Column:
    """struct(l, r): the keyed permutation of Z_a x Z_b at (left, right)."""
    rounds = F.sequence(F.lit(_ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(_ROUNDS - 1))
    sign = -1 if back else 1

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        mix = _keyed(key, purpose, i, F.when(even, s["r"]).otherwise(s["l"]))
        return F.struct(
            F.when(even, F.pmod(s["l"] + sign * (mix % a), a)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * (mix % b), b)).alias("r"))

    return F.aggregate(rounds, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def _move_digits(digits: Column, key: str, purpose: str, back: bool) -> Column:
    """Permutation of all digit strings of one length."""
    n = F.length(digits)
    high = F.floor(n / 2).cast("int")
    low = n - high
    out = feistel(F.left(digits, high), F.right(digits, low), F.pow(F.lit(10.0), high).cast("long"),
                  F.pow(F.lit(10.0), low).cast("long"), key, purpose, back)
    return F.concat(F.lpad(out["l"].cast("string"), high, "0"), F.lpad(out["r"].cast("string"), low, "0"))


def _check_digit(body: Column) -> Column:
    """Luhn digit that follows ``body``."""
    n = F.length(body)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(
        (n - i) % 2 == 0, F.lit(0) + _luhn_double(F.substring(body, i, F.lit(1)).cast("int"))).otherwise(
        F.substring(body, i, F.lit(1)).cast("int")))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _luhn_double(d: Column) -> Column:
    return d * 2 - F.when(d > 4, 9).otherwise(0)


def _into_format(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced, in order, by those of ``digits``."""
    chars = F.split(pattern, "")
    state = F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(
            F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))))
    return state["out"]


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """Pseudonym of a match, the match itself where it fails validation. With
    ``back`` the original of a pseudonym; e-mail addresses stay."""
    digits, n = _digits(m), F.length(_digits(m))
    kind = kind_of(m)

    body = _move_digits(F.left(digits, n - 1), key, "card", back)
    card = _into_format(m, F.concat(body, _check_digit(body)))

    area = F.left(digits, F.lit(3)).cast("long")
    rank = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + F.substring(digits, 4, 2).cast("long") - 1
    ssn = feistel(rank, F.right(digits, F.lit(4)).cast("long") - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", back)
    new_area = F.floor(ssn["l"] / 99) + 1
    new_area = new_area + F.when(new_area >= 666, 1).otherwise(0)
    ssn_text = F.concat(F.lpad(new_area.cast("string"), 3, "0"), F.lit("-"),
                        F.lpad((ssn["l"] % 99 + 1).cast("string"), 2, "0"), F.lit("-"),
                        F.lpad((ssn["r"] + 1).cast("string"), 4, "0"))

    ten = F.right(digits, F.lit(10))
    phone = _into_format(m, F.concat(F.left(digits, n - 10), _move_digits(ten, key, "phone", back)))

    part = F.split(m, r"\.")
    octet = [F.get(part, i).cast("long") for i in range(4)]
    bits = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536), F.lit(65536), key, "ip", back)
    ip = F.concat_ws(".", F.floor(bits["l"] / 256), bits["l"] % 256, F.floor(bits["r"] / 256), bits["r"] % 256)

    days = F.date_diff(_day(m), F.lit(_FIRST_DAY).cast("date")).cast("long")
    at = feistel(F.floor(days / _DAYS_B), days % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), key, "date", back)
    new_day = F.date_add(F.lit(_FIRST_DAY).cast("date"), (at["l"] * _DAYS_B + at["r"]).cast("int"))
    date = (F.when(m.contains("-"), F.date_format(new_day, "yyyy-MM-dd"))
            .when(m.contains("/"), F.date_format(new_day, "dd/MM/yyyy")).otherwise(F.date_format(new_day, "dd.MM.yyyy")))

    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    email = m if back else F.concat(F.lit("p"), F.left(F.sha2(F.concat_ws(
        "|", F.lit(key), F.lit("email"), F.lower(local), F.lower(domain)).cast("binary"), 256), F.lit(16)),
        F.lit("@"), domain)
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "date", date)
            .when(kind == "ssn", ssn_text).when(kind == "phone", phone).when(kind == "card", card).otherwise(m))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", id_col: str = "doc_id",
                 back: bool = False) -> DataFrame:
    """(doc_id, text, n_found, found) per row of ``docs``: the text with its
    personal data replaced, the number of replaced places, and the places as
    array<struct<kind, pseudonym>> in order. Null texts count as empty;
    repeated rows stay and get the same pseudonyms."""
    rows = docs.select(F.col(id_col).alias("doc_id"), no_text(text).alias("_t"))
    rows = rows.withColumn("_m", F.when(F.col("_t").rlike(_HINT), F.regexp_extract_all("_t", F.lit(_ANY), F.lit(0)))
                           .otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_p", F.transform("_m", lambda m: F.struct(
        kind_of(m).alias("kind"), pseudonym(m, key, back).alias("pseudonym"))))
    # the gaps between the matches, one more than there are matches
    gaps = F.split("_t", _ANY)
    joined = F.array_join(F.zip_with(gaps, "_p", lambda g, p: F.concat(g, F.coalesce(p["pseudonym"], F.lit("")))), "")
    found = F.filter("_p", lambda p: p["kind"].isNotNull())
    return rows.select("doc_id", F.when(F.size("_m") == 0, F.col("_t")).otherwise(joined).alias("text"),
                       F.size(found).alias("n_found"), found.alias("found"))
