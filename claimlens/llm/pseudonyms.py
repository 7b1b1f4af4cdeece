"""Format-preserving Feistel pseudonyms, with DataFrame functions only.

Numbers and dates that pass their validation are permuted under a key inside their
own format: a card number becomes another valid card number, a date another date.
A value is split into two parts, L modulo a and R modulo b; each round adds a keyed
hash of one part to the other, so every round is a bijection of exactly a * b values
and the inverse subtracts the same hashes. The rounds are undone, the value takes one
step in its domain, and the rounds are done again: no step leads back to its start, so
no value is its own pseudonym. Equal values get equal pseudonyms in all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name

ROUNDS = 8


def keyed(key: str, tag: str, i: int, part: Column, modulus: Column | int) -> Column:
    """A hash of ``part`` under the key, below ``modulus``."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), F.lit(str(i)), part.cast("string")), 256)
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return F.pmod(number, F.lit(modulus) if isinstance(modulus, int) else modulus)


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str, tag: str, invert: bool = False) -> Column:
    """A keyed permutation of pairs (left below a, right below b) without a fixed point, for a > 1; struct(left, right).

    Each round is bound as a lambda variable, so a round's hash is evaluated once.
    """
    a = F.lit(a).cast("long") if isinstance(a, int) else a.cast("long")
    b = F.lit(b).cast("long") if isinstance(b, int) else b.cast("long")

    def one(i: int, sign: int) -> Callable[[Column], Column]:
        def run(s: Column) -> Column:
            if i % 2 == 0:
                new = F.pmod(s["l"] + F.lit(sign) * keyed(key, tag, i, s["r"], a), a)
                return F.struct(new.alias("l"), s["r"].alias("r"))
            new = F.pmod(s["r"] + F.lit(sign) * keyed(key, tag, i, s["l"], b), b)
            return F.struct(s["l"].alias("l"), new.alias("r"))

        return run

    state = F.array(F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")))
    for i in reversed(range(ROUNDS)):
        state = F.transform(state, one(i, -1))
    step = F.lit(-1 if invert else 1)
    state = F.transform(state, lambda s: F.struct(F.pmod(s["l"] + step, a).alias("l"), s["r"].alias("r")))
    for i in range(ROUNDS):
        state = F.transform(state, one(i, 1))
    return F.get(state, F.lit(0))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def put_digits(shape: Column, new: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``new``."""
    gaps = F.split(shape, "[0-9]", -1)
    given = F.split(F.rpad(new, F.length(digits(shape)), "0"), "")
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(given, i), F.lit("")))), "")


def permute_digits(value: Column, key: str, tag: str, invert: bool = False) -> Column:
    """A digit string of 2 to 30 digits as another of the same length."""
    n = F.length(value)
    cut = F.floor(n / 2).cast("int")
    a = F.pow(F.lit(10.0), cut).cast("long")
    b = F.pow(F.lit(10.0), n - cut).cast("long")
    out = feistel(F.substring(value, F.lit(1), cut).cast("long"), F.substring(value, cut + 1, n - cut).cast("long"), a, b, key, tag, invert)
    joined = F.transform(F.array(out), lambda s: F.concat(F.lpad(s["l"].cast("string"), cut, "0"), F.lpad(s["r"].cast("string"), n - cut, "0")))
    return F.get(joined, F.lit(0))


def luhn_sum(value: Column, doubled_from: int) -> Column:
    """Luhn sum of a digit string; places counted from the right, every other one doubled from ``doubled_from``."""
    places = F.filter(F.split(F.reverse(value), ""), lambda x: x != "")
    weighed = F.transform(
        places,
        lambda x, i: F.when((i % 2) == doubled_from, F.when(x.cast("int") * 2 > 9, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)).otherwise(x.cast("int")),
    )
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x)


def is_card(value: Column) -> Column:
    """13 to 19 digits with a right Luhn check digit, not all the same."""
    d = digits(value)
    return F.length(d).between(13, 19) & (F.pmod(luhn_sum(d, 1), F.lit(10)) == 0) & ~d.rlike(r"^(\d)\1*$")


def permute_card(value: Column, key: str, invert: bool = False) -> Column:
    """Another card number of the same length and layout; the check digit is made anew."""
    d = digits(value)

    def body(x: Column) -> Column:
        check = F.pmod(F.lit(10) - F.pmod(luhn_sum(x, 0), F.lit(10)), F.lit(10))
        return F.concat(x, check.cast("string"))

    inner = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card", invert)
    return put_digits(value, F.get(F.transform(F.array(inner), body), F.lit(0)))


# the Gregorian calendar repeats after 146097 days, which are 189 * 773
FIRST_DAY, SPAN_A, SPAN_B = "1800-01-01", 189, 773


def date_of(value: Column) -> Column:
    """The date of yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy; null unless it exists and lies in 1800-2199."""
    found = F.coalesce(
        F.try_to_date(F.when(value.rlike(r"^\d{4}-\d\d-\d\d$"), value), "yyyy-MM-dd"),
        F.try_to_date(F.when(value.rlike(r"^\d\d\.\d\d\.\d{4}$"), value), "dd.MM.yyyy"),
        F.try_to_date(F.when(value.rlike(r"^\d\d/\d\d/\d{4}$"), value), "MM/dd/yyyy"),
    )
    return F.when(found.between(F.lit(FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date")), found)


def permute_date(value: Column, key: str, invert: bool = False) -> Column:
    """Another date of the same 400 years in the same notation."""
    n = F.datediff(date_of(value), F.lit(FIRST_DAY).cast("date"))
    out = feistel(F.floor(n / SPAN_B), F.pmod(n, F.lit(SPAN_B)), SPAN_A, SPAN_B, key, "date", invert)
    day = F.get(F.transform(F.array(out), lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["l"] * SPAN_B + s["r"]).cast("int"))), F.lit(0))
    return (
        F.when(value.rlike(r"^\d{4}-"), F.date_format(day, "yyyy-MM-dd"))
        .when(value.rlike(r"^\d\d\."), F.date_format(day, "dd.MM.yyyy"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
    )


def is_ssn(value: Column) -> Column:
    return value.rlike(r"^(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}$")


def permute_ssn(value: Column, key: str, invert: bool = False) -> Column:
    """Another valid number: 898 areas, 99 groups and 9999 serials are counted without the void ones."""
    area, group, serial = (F.split(value, "-")[i].cast("int") for i in range(3))
    left = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(left, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", invert)

    def show(s: Column) -> Column:
        new = F.when(s["l"] + 1 >= 666, s["l"] + 2).otherwise(s["l"] + 1)
        return F.concat_ws(
            "-",
            F.lpad(new.cast("string"), 3, "0"),
            F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(s["r"], F.lit(9999)) + 1).cast("string"), 4, "0"),
        )

    return F.get(F.transform(F.array(out), show), F.lit(0))


def is_ip(value: Column) -> Column:
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return value.rlike(rf"^{octet}(\.{octet}){{3}}$")


def permute_ip(value: Column, key: str, invert: bool = False) -> Column:
    o = [F.split(value, r"\.")[i].cast("long") for i in range(4)]
    out = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip", invert)

    def show(s: Column) -> Column:
        return F.concat_ws(".", *[x.cast("string") for p in ("l", "r") for x in (F.floor(s[p] / 256), F.pmod(s[p], F.lit(256)))])

    return F.get(F.transform(F.array(out), show), F.lit(0))


def is_phone(value: Column) -> Column:
    """7 to 15 digits with a separator or a leading plus."""
    return F.length(digits(value)).between(7, 15) & value.rlike(r"[+() .-]")


def permute_phone(value: Column, key: str, invert: bool = False) -> Column:
    """The last seven digits change; country and area stay."""
    d = digits(value)
    n = F.length(d)
    tail = permute_digits(F.substring(d, n - 6, F.lit(7)), key, "phone", invert)
    return put_digits(value, F.concat(F.substring(d, F.lit(1), n - 7), tail))


LETTERS = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
# a digest of 256 hexadecimal digits masks so many characters
MASKED = 42


def cycle(key: str, tag: str, n: int) -> list[int]:
    """A keyed permutation of 0 to n - 1 that is one cycle, so that no value stays."""
    order = sorted(range(n), key=lambda i: hashlib.sha256(f"{key}|{tag}|{n}|{i}".encode()).hexdigest())
    out = [0] * n
    for at, to in zip(order, order[1:] + order[:1]):
        out[at] = to
    return out


def moved_char(c: Column, by: Column, letters: str) -> Column:
    """A letter or digit moved ``by`` places in its alphabet; other characters stay."""
    lower, upper, digit = F.instr(F.lit(letters), c), F.instr(F.lit(letters.upper()), c), F.instr(F.lit(DIGITS), c)

    def turn(alphabet: str, where: Column) -> Column:
        return F.substring(F.lit(alphabet), F.pmod(where - 1 + by, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))

    return (
        F.when(c == "", c)
        .when(lower > 0, turn(letters, lower))
        .when(upper > 0, turn(letters.upper(), upper))
        .when(digit > 0, turn(DIGITS, digit))
        .otherwise(c)
    )


def place_of(c: Column, letters: str) -> Column:
    """0-based place of a letter or digit in its alphabet; null for other characters."""
    found = F.greatest(F.instr(F.lit(letters), F.lower(c)), F.instr(F.lit(DIGITS), c))
    return F.when((c != "") & (found > 0), found - 1)


def char_at(shape: Column, place: Column, letters: str) -> Column:
    """The letter (in the case of ``shape``) or digit at a place."""
    one = lambda alphabet: F.substring(F.lit(alphabet), place.cast("int") + 1, F.lit(1))
    return F.when(shape.rlike("[0-9]"), one(DIGITS)).when(shape.rlike("[A-Z]"), one(letters.upper())).otherwise(one(letters))


def permute_short(value: Column, key: str, invert: bool, letters: str) -> Column:
    """A word of one or two characters by a permutation of all words of its shape."""
    first, second = F.substring(value, F.lit(1), F.lit(1)), F.substring(value, F.lit(2), F.lit(1))

    def table(n: int) -> Column:
        to = cycle(key, "short", n)
        if invert:
            to = [x for _, x in sorted((y, x) for x, y in enumerate(to))]
        return F.expr(f"array({', '.join(map(str, to))})")

    def sized(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), F.lit(len(DIGITS))).otherwise(F.lit(len(letters)))

    one, two = place_of(first, letters), place_of(second, letters)
    both, width = one.isNotNull() & two.isNotNull(), sized(second)
    # characters that do not move count as one value
    number = F.when(both, one * width + two).otherwise(F.coalesce(one, two))
    total = F.when(both, sized(first) * width).otherwise(F.when(one.isNotNull(), sized(first)).otherwise(sized(second)))
    new = None
    for n in sorted({x * y for x in (len(letters), len(DIGITS)) for y in (1, len(letters), len(DIGITS))}):
        value_of = F.get(table(n), number)
        new = F.when(total == n, value_of) if new is None else new.when(total == n, value_of)

    def show(x: Column) -> Column:
        left = F.when(both, F.floor(x / width)).otherwise(x)
        right = F.when(both, F.pmod(x, width)).otherwise(x)
        return F.concat(
            F.when(one.isNotNull(), char_at(first, left, letters)).otherwise(first),
            F.when(two.isNotNull(), char_at(second, right, letters)).otherwise(second),
        )

    return F.coalesce(F.get(F.transform(F.array(new), show), F.lit(0)), value)


def permute_name(value: Column, key: str, invert: bool = False, letters: str = LETTERS) -> Column:
    """Letters and digits of a word, moved inside their alphabets; other characters stay.

    The word is cut in two halves that shift each other in turn, character by
    character under a mask of key, round, other half and place, so the whole is a
    bijection of words of one shape. In between, the first letter or digit takes one
    step. Words of one or two characters are permuted as a whole.
    """
    n = F.length(value)
    cut = F.floor(n / 2).cast("int")

    def shifted(part: Column, other: Column, i: int, sign: int) -> Column:
        mask = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit("name"), F.lit(f"{i}{half}"), other), 512) for half in "ab"])

        def move(c: Column, at: Column) -> Column:
            k = F.conv(F.substring(mask, F.pmod(at, F.lit(MASKED)) * 6 + 1, F.lit(6)), 16, 10).cast("long")
            return moved_char(c, F.lit(sign) * k, letters)

        return F.array_join(F.transform(F.split(part, ""), move), "")

    def one(i: int, sign: int) -> Callable[[Column], Column]:
        def run(s: Column) -> Column:
            if i % 2 == 0:
                return F.struct(shifted(s["l"], s["r"], i, sign).alias("l"), s["r"].alias("r"))
            return F.struct(s["l"].alias("l"), shifted(s["r"], s["l"], i, sign).alias("r"))

        return run

    def step(s: Column) -> Column:
        word = F.concat(s["l"], s["r"])
        before = F.regexp_extract(word, f"^[^{letters}{letters.upper()}0-9]*", 0)
        at = F.length(before) + 1
        moved = moved_char(F.substring(word, at, F.lit(1)), F.lit(-1 if invert else 1), letters)
        return F.concat(before, moved, F.substring(word, at + 1, F.length(word)))

    # classes of characters do not change, so the shape is the same on both ways
    state = F.array(F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, n - cut).alias("r")))
    for i in reversed(range(4)):
        state = F.transform(state, one(i, -1))
    stepped = F.transform(state, step)
    state = F.transform(stepped, lambda w: F.struct(F.substring(w, F.lit(1), cut).alias("l"), F.substring(w, cut + 1, n - cut).alias("r")))
    for i in range(4):
        state = F.transform(state, one(i, 1))
    long = F.get(F.transform(state, lambda s: F.concat(s["l"], s["r"])), F.lit(0))
    return F.when(n <= 2, permute_short(value, key, invert, letters)).otherwise(long)


def permute_email(value: Column, key: str, invert: bool = False) -> Column:
    """Another local part of the same shape; the domain stays."""
    return F.concat(permute_name(F.substring_index(value, "@", 1), key, invert), F.lit("@"), F.substring_index(value, "@", -1))


def permute_secret(value: Column, key: str, invert: bool = False) -> Column:
    """A long hexadecimal token as another one of the same shape."""
    return permute_name(value, key, invert, letters="abcdef")


# values that may follow a phone after a space and are no groups of it; an address never is one
ADDRESS = r"\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
FOLLOWER = (
    r"\d{4}-\d\d-\d\d(?!\d)|\d\d[./]\d\d[./]\d{4}(?!\d)|\d{3}-\d\d-\d{4}(?![\d-])"
    r"|(?:\d{4}[ -]){3}\d{1,7}(?![ -]?\d)|\d{13,19}(?!\d)|\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)"
)

# a place up to which a phone has 7 to 15 digits; look-behinds take no counted groups, so it is written out
DIGIT = r"[ ().-]{0,3}\d"
FULL = rf"(?<=\+{DIGIT * 7}{f'(?:{DIGIT}' * 8}{')?' * 8})"


def free_phone(not_next: str) -> str:
    """Groups after a country code, as many as have 7 to 15 digits in all and do not begin ``not_next`` after a space."""
    return (
        r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}"
        rf"(?:(?: (?!{not_next})|[.-]?)\d{{2,4}}){{1,3}}(?!\d){FULL}"
    )


# phones of fixed length (country code 1, or 3 and 4 digits after an area in brackets) end there;
# others are tried without a value that follows, then with it
PHONE = (
    r"(?<![\w+])\+(?:1[ .-]?(?:\(\d{3}\)|\d{3})|\d{1,3}[ .-]?\(\d{1,4}\))[ .-]?\d{3}[ .-]?\d{4}(?![.-]?\d)"
    rf"|{free_phone(f'{ADDRESS}|{FOLLOWER}')}|{free_phone(ADDRESS)}"
)

# candidate pieces of a text, longest kinds first; what fails its validation stays as it is
FIND = (
    r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    r"|(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])"
    r"|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
    r"|(?<!\d)\d{4}-\d\d-\d\d(?!\d)|(?<!\d)\d\d[./]\d\d[./]\d{4}(?!\d)"
    r"|(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"
    r"|(?<!\d)(?:\d{4}[ -]){3}\d{1,7}(?!\d)|(?<!\d)\d{13,19}(?!\d)"
    rf"|{PHONE}"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)"
)


def kind_of(piece: Column) -> Column:
    """The validated kind of a candidate piece; null if it is none."""
    return (
        F.when(F.contains(piece, F.lit("@")), "email")
        .when(piece.rlike("^[0-9a-fA-F]{32,64}$") & piece.rlike("[0-9]") & piece.rlike("[a-fA-F]"), "secret")
        .when(is_ip(piece), "ip")
        .when(date_of(piece).isNotNull(), "date")
        .when(is_ssn(piece), "ssn")
        .when(is_card(piece), "card")
        .when(~piece.rlike(r"^\d+$") & ~piece.rlike(r"^\d{4}-\d\d-\d\d$|^\d{3}-\d\d-\d{4}$|^\d\d[./]\d\d[./]|^\d+(\.\d+){3}$|^(\d{4}[ -]){3}") & is_phone(piece), "phone")
    )


PERMUTE = {
    "email": permute_email,
    "secret": permute_secret,
    "ip": permute_ip,
    "date": permute_date,
    "ssn": permute_ssn,
    "card": permute_card,
    "phone": permute_phone,
}


def pseudonym(piece: Column, key: str, invert: bool = False) -> Column:
    """The pseudonym of a validated piece; any other piece is returned unchanged."""
    kind = kind_of(piece)
    out = None
    for name, permute in PERMUTE.items():
        value = permute(piece, key, invert)
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out.otherwise(piece)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", invert: bool = False) -> DataFrame:
    """``docs`` with personal values of ``text`` replaced; plus ``n_found``, ``kinds`` and ``pieces``.

    A column of ``docs`` with one of these names is replaced. Ids are not used: rows
    without one, or with one id, are treated like any others.
    ``pieces`` lists (kind, value before, value after). Null texts stay null; texts
    without candidates are returned unchanged. With ``invert`` and the same key the
    text comes back. No shuffle: each text is cut at the candidates, the candidates
    are permuted, and the parts are joined again.
    """
    results = ("n_found", "kinds", "pieces")
    found, changed = free_name(docs, "__found"), free_name(docs, "__moved")
    cut = docs.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(FIND), F.lit(0)))
    moved = F.transform(found, lambda p: F.struct(kind_of(p).alias("kind"), p.alias("before"), pseudonym(p, key, invert).alias("after")))
    some = cut.withColumn(changed, F.when(F.size(found) > 0, moved))
    gaps = F.split(F.col(text), FIND, -1)
    joined = F.array_join(
        F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(F.col(changed), i)["after"], F.lit("")))), ""
    )
    good = F.filter(changed, lambda p: p["kind"].isNotNull())
    return some.select(
        *[
            F.when(F.size(found) > 0, joined).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`")
            for c in docs.columns
            if c.lower() not in results
        ],
        F.coalesce(F.size(good), F.lit(0)).cast("long").alias("n_found"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform(good, lambda p: p["kind"]))), F.array().cast("array<string>")).alias("kinds"),
        F.coalesce(good, F.array().cast("array<struct<kind:string,before:string,after:string>>")).alias("pieces"),
    )
