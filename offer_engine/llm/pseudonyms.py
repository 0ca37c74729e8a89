"""Format-preserving pseudonyms by Feistel networks, as SQL expressions.

Numbers and dates in texts are found by pattern, validated, and permuted within their format under
a key: a pseudonym looks like what it stands for, equal values have equal pseudonyms in all
documents, different values of a kind have different ones, and the key turns them back.

kind     validated by                            permuted
card     13 to 19 digits                         all digits but the last; the last keeps its
                                                 distance from the Luhn digit, so valid numbers
                                                 stay valid and others stay invalid
phone    + and 8 to 15 digits                    digits after the country code
ip       four numbers up to 255                  the 32-bit address
ssn      area, group and serial as issued        the number among all that may be issued
date     a day of 1800 to 2199, three formats    the day among the 146,097 of those 400 years
email    local part and domain                   letters and digits of the local part

Strings go through a network over characters: a round shifts each character at even (or odd)
places by a hash of the characters at the other places, within its class (digit, small or capital
Latin letter). Others go through one over two numbers whose ranges multiply to exactly the number
of values, so no walk over cycles is needed.

Edge cases: a null text stays null; texts without a match stay as they are; what does not
validate stays. A match is found once, kinds in the order email, ssn, date, ip, phone, card. Equal
rows get equal results. An empty table gives an empty one. The key is part of the plan: a caller
that must hide it from plan listings sets Spark's redaction pattern.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import packed, unpacked

ROUNDS = 8
FIRST_DAY = "date'1800-01-01'"
#: 400 years have 189 * 773 days.
DAYS = (189, 773)
#: Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
SSN = (898 * 99, 9999)

PATTERNS = {
    # A local part has 64 characters at most, and is looked for from the start of a word only.
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "phone": r"\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6}(?!\d)",
    "card": r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])",
}
FOUND = "|".join(PATTERNS.values())


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def keyed_number(key: str, tweak: str, parts: str) -> str:
    """60 bits of a hash of key, tweak and what the SQL in `parts` gives."""
    said = f"concat_ws('|', {quoted(key)}, {quoted(tweak)}, {parts})"
    return f"cast(conv(substring(sha2({said}, 256), 1, 15), 16, 10) as bigint)"


def over_characters(text: str, key: str, tweak: str, back: bool = False) -> str:
    """SQL of the character network on the SQL string `text`."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    others = "array_join(filter(split(s, ''), (c, i) -> i % 2 <> r % 2), '')"
    number = keyed_number(key, tweak, "cast(r as string), cast(i as string), o")
    sign = "-" if back else "+"

    def within(low: int, size: int) -> str:
        return f"char({low} + pmod(ascii(c) - {low} {sign} {number}, {size}))"

    shifted = (
        f"case when i % 2 <> r % 2 then c"
        f" when c between '0' and '9' then {within(48, 10)}"
        f" when c between 'a' and 'z' then {within(97, 26)}"
        f" when c between 'A' and 'Z' then {within(65, 26)} else c end"
    )
    # The inner transform binds the other half to o, so it is worked out once a round.
    step = (
        f"element_at(transform(array({others}), o -> "
        f"array_join(transform(split(s, ''), (c, i) -> {shifted}), '')), 1)"
    )
    return f"aggregate({rounds}, {text}, (s, r) -> {step})"


def over_numbers(
    high: str, low: str, sizes: tuple[int, int], key: str, tweak: str, back: bool = False
) -> str:
    """SQL of the network on two numbers below `sizes`, as a struct (a, b)."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    sign = "-" if back else "+"
    a, b = sizes
    by_b = keyed_number(key, tweak, "cast(r as string), cast(s.b as string)")
    by_a = keyed_number(key, tweak, "cast(r as string), cast(s.a as string)")
    return (
        f"aggregate({rounds}, named_struct('a', cast({high} as bigint), 'b', cast({low} as bigint)),"
        f" (s, r) -> if(r % 2 = 0,"
        f" named_struct('a', pmod(s.a {sign} {by_b}, {a}L), 'b', s.b),"
        f" named_struct('a', s.a, 'b', pmod(s.b {sign} {by_a}, {b}L))))"
    )


def with_value(value: str, name: str, body: str) -> str:
    """SQL of body with `name` bound to the SQL `value`, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digits_of(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def luhn_digit(d: str) -> str:
    """SQL of the check digit of the digits d."""
    doubled = "cast(c as int) * 2 - if(cast(c as int) > 4, 9, 0)"
    terms = f"transform(split(reverse({d}), ''), (c, i) -> if(i % 2 = 0, {doubled}, cast(c as int)))"
    return f"pmod(10 - aggregate({terms}, 0, (x, y) -> x + y) % 10, 10)"


def refilled(m: str, digits: str) -> str:
    """SQL of m with its digits replaced one after the other."""
    return with_value(
        digits,
        "f",
        f"aggregate(split({m}, ''), named_struct('t', '', 'n', 1), (z, c) -> if(c between '0' and '9',"
        f" named_struct('t', concat(z.t, substring(f, z.n, 1)), 'n', z.n + 1),"
        f" named_struct('t', concat(z.t, c), 'n', z.n)), z -> z.t)",
    )


def card(key: str, back: bool) -> str:
    body = over_characters("substring(d, 1, length(d) - 1)", key, "card", back)
    off = f"cast(right(d, 1) as int) - {luhn_digit('substring(d, 1, length(d) - 1)')}"
    last = f"cast(pmod({luhn_digit('p')} + {off}, 10) as string)"
    new = with_value(digits_of("m"), "d", with_value(body, "p", f"concat(p, {last})"))
    return f"if(length({digits_of('m')}) between 13 and 19, {refilled('m', new)}, m)"


def phone(key: str, back: bool) -> str:
    code = r"regexp_extract(m, '^\\+\\d{1,3}', 0)"
    # Where no sign ends the country code, its first digit is taken for it.
    code = f"if(length({code}) = 4 and substring(m, 5, 1) between '0' and '9', substring(m, 1, 2), {code})"
    rest = "substring(m, length(k) + 1)"
    new = over_characters(digits_of(rest), key, "phone", back)
    made = with_value(code, "k", f"concat(k, {refilled(rest, new)})")
    return f"if(length({digits_of('m')}) between 8 and 15, {made}, m)"


def ip(key: str, back: bool) -> str:
    octets = "transform(split(m, '[.]'), x -> cast(x as int))"
    net = over_numbers("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", (1 << 16, 1 << 16), key, "ip", back)
    shown = "concat_ws('.', cast(n.a div 256 as string), cast(n.a % 256 as string), cast(n.b div 256 as string), cast(n.b % 256 as string))"
    made = f"if(exists(o, x -> x > 255), m, {with_value(net, 'n', shown)})"
    return with_value(octets, "o", made)


def ssn(key: str, back: bool) -> str:
    area, group, serial = (f"cast(substring(m, {s}, {n}) as int)" for s, n in ((1, 3), (5, 2), (8, 4)))
    place = f"{area} - if({area} > 666, 2, 1)"
    net = over_numbers(f"({place}) * 99 + {group} - 1", f"{serial} - 1", SSN, key, "ssn", back)
    new_area = "n.a div 99 + if(n.a div 99 + 1 >= 666, 2, 1)"
    shown = (
        f"concat_ws('-', lpad(cast({new_area} as string), 3, '0'),"
        " lpad(cast(n.a % 99 + 1 as string), 2, '0'), lpad(cast(n.b + 1 as string), 4, '0'))"
    )
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    return f"if({valid}, {with_value(net, 'n', shown)}, m)"


def date(key: str, back: bool) -> str:
    form = (
        "case when substring(m, 5, 1) = '-' then 'yyyy-MM-dd'"
        " when substring(m, 3, 1) = '.' then 'dd.MM.yyyy' else 'dd/MM/yyyy' end"
    )
    b = DAYS[1]
    total = DAYS[0] * b
    net = over_numbers(f"d div {b}", f"d % {b}", DAYS, key, "date", back)
    shown = f"date_format(date_add({FIRST_DAY}, cast(n.a * {b} + n.b as int)), {form})"
    days = f"datediff(cast(try_to_timestamp(m, {form}) as date), {FIRST_DAY})"
    made = f"if(d between 0 and {total - 1}, {with_value(net, 'n', shown)}, m)"
    return with_value(days, "d", f"if(d is null, m, {made})")


def email(key: str, back: bool) -> str:
    local = over_characters("substring_index(m, '@', 1)", key, "email", back)
    return f"concat({local}, '@', substring_index(m, '@', -1))"


def pseudonym(key: str, back: bool = False) -> str:
    """SQL of the pseudonym of the match m, or of what the pseudonym m stands for."""
    kinds = {"email": email, "ssn": ssn, "date": date, "ip": ip, "phone": phone, "card": card}
    # A match is a kind if the kind's own pattern spans it; look-arounds hold at its ends.
    tests = {
        "email": "m like '%@%'",
        "ssn": r"m rlike '^\\d{3}-\\d{2}-\\d{4}$'",
        "date": r"m rlike '^(\\d{4}-\\d{2}-\\d{2}|\\d{2}[.]\\d{2}[.]\\d{4}|\\d{2}/\\d{2}/\\d{4})$'",
        "ip": r"m rlike '^\\d{1,3}([.]\\d{1,3}){3}$'",
        "phone": "m like '+%'",
    }
    cases = " ".join(f"when {t} then {kinds[k](key, back)}" for k, t in tests.items())
    return f"case {cases} else {card(key, back)} end"


def pseudonymised(
    docs: DataFrame,
    key: str,
    text: str = "text",
    columns: Sequence[str] | None = None,
    back: bool = False,
) -> DataFrame:
    """The named columns of docs (all by default), with `text` pseudonymised and `replaced`, the
    number of values that were. back=True turns pseudonyms back. A column of docs named `replaced`
    is replaced."""
    names = docs.columns if columns is None else list(columns)
    body = F.col(f"`{text}`")
    # Texts without a digit after a digit, or an @, hold nothing to look for.
    may = body.rlike(r"\d[^\p{L}]{0,3}\d|@")
    rows = docs.select(
        packed(docs, names),
        body.alias("body"),
        F.when(may, F.regexp_extract_all(body, F.lit(FOUND), F.lit(0))).alias("old"),
    )
    rows = rows.withColumn("new", F.expr(f"transform(old, m -> {pseudonym(key, back)})"))
    joined = F.expr(
        "array_join(transform(gaps, (g, i) -> concat(g, if(i < size(new), new[i], ''))), '')"
    )
    rows = rows.withColumn("gaps", F.when(F.size("old") > 0, F.split("body", FOUND, -1)))
    result = rows.select(
        "row",
        F.when(F.size("old") > 0, joined).otherwise(F.col("body")).alias("text"),
        F.coalesce(
            F.expr("size(filter(zip_with(old, new, (a, b) -> a <> b), x -> x))"), F.lit(0)
        ).alias("replaced"),
    )
    if text != "text":
        result = result.withColumnRenamed("text", text)
    return unpacked(result, names, (text, "replaced"))
