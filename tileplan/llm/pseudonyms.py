"""Personal data as format-preserving pseudonyms, on SQL functions alone.

Numbers that pass their check (payment cards and account numbers by check digits, network addresses and dates by
range), telephone and social security numbers, the local part of mail addresses and quoted secrets are replaced by a
keyed permutation of the values of their format: a Feistel network whose round function is SHA-256 under a key. The
permutation does not depend on the document, so equal values stay equal everywhere, and who holds the key can undo it.
Numbers that fail their check are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.llm.tables import without

ROUNDS = 10
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# 146097 days, from 1800-01-01 to 2199-12-31, are 189 * 773, so a network of these two moduli permutes the days.
FIRST_DAY, DAY_MODULI = "1800-01-01", (189, 773)

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
PHONE = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9/-])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])"
SECRET = r"""(?<=(?i:token|secret|api_key|apikey|password) ?[=:] ?["'])[A-Za-z0-9_-]{16,}(?=["'])|(?<=["'])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?=["'])"""
ANY = "|".join([EMAIL, SECRET, DATE, ADDRESS, PHONE, SOCIAL, CARD, ACCOUNT])


def _number(key: str, kind: str, turn: Column, other: Column) -> Column:
    """The round function: 60 bits of SHA-256 over key, kind, round and the other half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(left: Column, right: Column, a: Column, b: Column, key: str, kind: str, undo: bool = False) -> Column:
    """Struct (a, b) of halves 0 <= left < a and 0 <= right < b after ROUNDS keyed rounds; ``undo`` runs them back."""

    def turn(s: Column, i: Column) -> Column:
        step = F.lit(ROUNDS - 1) - i if undo else i
        sign = -1 if undo else 1
        return F.when(step % 2 == 0, F.struct(
            F.pmod(s["a"] + sign * (_number(key, kind, step, s["b"]) % a), a).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), F.pmod(s["b"] + sign * (_number(key, kind, step, s["a"]) % b), b).alias("b")))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permuted_digits(digits: Column, key: str, kind: str, undo: bool = False) -> Column:
    """Another string of as many digits, 2 to 36; the number of digits is part of the key."""
    size = F.length(digits)
    half = (size / 2).cast("int")
    power = [F.pow(F.lit(10), n).cast("long") for n in (half, size - half)]
    out = permuted(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1), *power, key, kind, undo)
    return F.concat(F.lpad(out["a"].cast("string"), half, "0"), F.lpad(out["b"].cast("string"), size - half, "0"))


def _shifted(text: Column, other: Column, step: Column, key: str, kind: str, sign: int, alphabets: list[str]) -> Column:
    """Each character moved inside its alphabet by a keyed amount; characters of no alphabet stay."""

    def one(c: Column, j: Column) -> Column:
        amount = sign * _number(key, kind, F.concat_ws(":", step.cast("string"), j.cast("string")), other)
        out = c
        for alphabet in alphabets:
            at = F.instr(F.lit(alphabet), c)
            out = F.when(at > 0, F.substr(F.lit(alphabet), (F.pmod(at - 1 + amount, F.lit(len(alphabet))) + 1).cast(
                "int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def permuted_text(text: Column, key: str, kind: str, undo: bool = False, hexadecimal: bool = False) -> Column:
    """Another text with digits, small and capital letters in the same places."""
    alphabets = [DIGITS + "abcdef"] if hexadecimal else [UPPER, LOWER, DIGITS]
    half = (F.length(text) / 2).cast("int")
    sign = -1 if undo else 1

    def turn(s: Column, i: Column) -> Column:
        step = F.lit(ROUNDS - 1) - i if undo else i
        return F.when(step % 2 == 0, F.struct(
            _shifted(s["a"], s["b"], step, key, kind, sign, alphabets).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), _shifted(s["b"], s["a"], step, key, kind, sign, alphabets).alias("b")))

    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return F.concat(out["a"], out["b"])


def _refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order by ``digits``."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), F.struct(
            F.concat(s["text"], F.substr(digits, s["at"], F.lit(1))).alias("text"), (s["at"] + 1).alias("at"))).otherwise(
            F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at")))

    return F.aggregate(F.split(form, ""), start, put)["text"]


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number, its last digit counted once."""

    def value(c: Column, j: Column) -> Column:
        d = c.cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(j % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), value), F.lit(0),
                       lambda s, d: s + d)


def remainder_97(text: Column) -> Column:
    """An account number's remainder by 97, letters as 10 to 35."""

    def add(s: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, (s * 100 + letter + 9) % 97).when(
            c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise(s)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _email(m: Column, key: str, undo: bool) -> Column:
    at = F.instr(m, "@")
    return F.concat(permuted_text(F.substr(m, F.lit(1), at - 1), key, "email", undo), F.substr(m, at))


def _address(m: Column, key: str, undo: bool) -> Column:
    part = F.split(m, r"\.")
    number = [part[i].cast("long") for i in range(4)]
    out = permuted(number[0] * 256 + number[1], number[2] * 256 + number[3], F.lit(65536), F.lit(65536), key, "address", undo)
    new = F.concat_ws(".", *[x.cast("long").cast("string") for x in (
        F.floor(out["a"] / 256), out["a"] % 256, F.floor(out["b"] / 256), out["b"] % 256)])
    right = number[0] < 256
    for n in number[1:]:
        right = right & (n < 256)
    return F.when(right, new).otherwise(m)


def _date(m: Column, key: str, undo: bool) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    year_first = m.rlike("^[0-9]{4}")
    day = F.when(year_first, F.try_to_timestamp(digits, F.lit("yyyyMMdd"))).otherwise(
        F.try_to_timestamp(digits, F.lit("ddMMyyyy"))).cast("date")
    number = F.datediff(day, F.to_date(F.lit(FIRST_DAY)))
    a, b = DAY_MODULI
    out = permuted(F.floor(number / b), number % b, F.lit(a), F.lit(b), key, "date", undo)
    new = F.date_add(F.to_date(F.lit(FIRST_DAY)), (out["a"] * b + out["b"]).cast("int"))
    written = F.when(year_first, F.date_format(new, "yyyyMMdd")).otherwise(F.date_format(new, "ddMMyyyy"))
    return F.when(number.between(0, a * b - 1), _refilled(m, written)).otherwise(m)


def _phone(m: Column, key: str, undo: bool) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    code = F.length(digits) - 10
    return _refilled(m, F.concat(F.substr(digits, F.lit(1), code), permuted_digits(
        F.substr(digits, code + 1), key, "phone", undo)))


def _card(m: Column, key: str, undo: bool) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    new = permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card", undo)
    check = F.pmod(-luhn_sum(F.concat(new, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(luhn_sum(digits) % 10 == 0, _refilled(m, F.concat(new, check))).otherwise(m)


def _account(m: Column, key: str, undo: bool) -> Column:
    country, rest = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(5))
    new = permuted_text(rest, key, "account", undo)
    check = F.lpad((F.lit(98) - remainder_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    right = remainder_97(F.concat(rest, F.substr(m, F.lit(1), F.lit(4)))) == 1
    return F.when(right, F.concat(country, check, new)).otherwise(m)


def pseudonym(m: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of one value found by ANY; the value itself if its check fails. Account numbers of A-F and digits are
    told from hexadecimal secrets by length: those have 32 characters at least."""
    def whole(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")

    social = _refilled(m, permuted_digits(F.regexp_replace(m, "-", ""), key, "social", undo))
    secret = F.when(m.rlike("^[0-9a-f]+$"), permuted_text(m, key, "hex", undo, hexadecimal=True)).when(
        m.rlike("^[0-9A-F]+$"), F.upper(permuted_text(F.lower(m), key, "hex", undo, hexadecimal=True))).otherwise(
        permuted_text(m, key, "secret", undo))
    return (F.when(whole(EMAIL), _email(m, key, undo)).when(whole(DATE), _date(m, key, undo))
            .when(whole(ADDRESS), _address(m, key, undo)).when(whole(PHONE), _phone(m, key, undo))
            .when(whole(SOCIAL), social).when(whole(CARD), _card(m, key, undo))
            .when(whole(ACCOUNT) & ~m.rlike("^[0-9A-F]{32,}$"), _account(m, key, undo)).otherwise(secret))


def pseudonymised(docs: DataFrame, key: str, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and the column n_replaced, the number of values that changed.

    One pass without a shuffle. A null text stays null with 0; texts without such values stay as they are; a column
    named n_replaced is replaced. ``undo`` turns pseudonyms back.
    """
    docs = without(docs, "n_replaced")
    value = F.col(f"`{text}`")
    found = F.when(value.rlike(ANY), F.regexp_extract_all(value, F.lit(ANY), F.lit(0)))
    staged = docs.withColumn("_found", found).withColumn("_new", F.transform("_found", lambda m: pseudonym(m, key, undo)))
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x))
    filled = F.array_join(F.zip_with(F.split(value, ANY, -1), "_new", lambda gap, new: F.concat(
        gap, F.coalesce(new, F.lit("")))), "")
    return staged.select(*[F.when(F.col("_found").isNotNull(), filled).otherwise(value).alias(c) if c == text
                           else F.col(f"`{c}`") for c in docs.columns],
                         F.coalesce(F.when(F.col("_found").isNotNull(), changed), F.lit(0)).cast("long").alias("n_replaced"))
