"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses, in DataFrame functions only.

Candidates are found by shape and then validated: card numbers by the Luhn digit, IBANs by their remainder, social security
numbers by their ranges, IPv4 addresses by their octets, dates by the calendar, phone numbers by their length. What
fails stays as it is. A valid value is permuted by a Feistel network under the key, within its format: the
pseudonym of a card number is a card number with a right Luhn digit and the same separators, that of a date a date in
the same notation. The same value gets the same pseudonym in every document, so links survive, and distinct
values of one format stay distinct. Nothing is looked up or shuffled, so nothing grows with the number of values.

Two networks, each of ``ROUNDS`` rounds with SHA-256 of key, kind, round and the other half:
text     halves of a string; a digit moves among the digits, a letter among the letters of its case, other signs stay
number   halves of a mixed-radix number, for formats whose valid values are not a plain product of characters

Defined results: null stays null, empty stays empty; texts of any length are treated whole in time linear in them;
repeated rows get equal results; ids play no part; other columns pass through, but ``n_replaced`` takes the place
of a column of that name; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
# Shapes; each starts where its run of signs starts, so that a long run is tried once.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![A-Za-z0-9])",
    "phone": (
        r"(?<![A-Za-z0-9+])\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?(?:[ -]?[0-9]{2,4}){2,3}(?![A-Za-z0-9])"
        r"|(?<![A-Za-z0-9)])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![A-Za-z0-9])"
        r"|(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![A-Za-z0-9-])"
    ),
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])",
    "date": (
        r"(?<![A-Za-z0-9])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![A-Za-z0-9])"
    ),
}
ANY = "|".join(f"(?:{shape})" for shape in SHAPES.values())
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 1900 to 2099 have 17 * 4297 days
DATE_FORMATS = (
    *(f"yyyy{s}MM{s}dd" for s in "-/."), "dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy", "dd-MM-yyyy", "MM-dd-yyyy"
)


def _hash(key: str, kind: str, number: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), other, F.lit(key)), 256)


def _shifted(sign: Column, by: Column) -> Column:
    code = F.ascii(sign)

    def among(first, size):
        return F.char((F.lit(first) + F.pmod(code - first + by, F.lit(size))).cast("int"))

    return (
        F.when(code.between(48, 57), among(48, 10)).when(code.between(97, 122), among(97, 26))
        .when(code.between(65, 90), among(65, 26)).otherwise(sign)
    )


def permuted_text(value: Column, key: str, kind: str) -> Column:
    half = F.floor(F.length(value) / 2).cast("int")

    def turn(state, number):
        digest = _hash(key, kind, number, state["b"])

        def moved(sign, i):
            return _shifted(sign, F.conv(F.substr(digest, (F.pmod(i, F.lit(16)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int"))

        # An odd and an even half change places, so each keeps its signs' places in the value.
        return F.struct(state["b"].alias("a"), F.array_join(F.transform(F.split(state["a"], ""), moved), "").alias("b"))

    start = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1).alias("b"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda s: F.concat(s["a"], s["b"]))


def permuted_number(high: Column, low: Column, radix: tuple[int, int], key: str, kind: str, result) -> Column:
    """``result(high, low)`` of the permuted halves, high below radix[0] and low below radix[1]."""

    def turn(state, number):
        def added(to, other, size):
            digest = _hash(key, kind, number, other.cast("string"))
            return F.pmod(to + F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long"), F.lit(size).cast("long"))

        odd = number % 2 == 1
        return F.struct(
            F.when(odd, added(state["a"], state["b"], radix[0])).otherwise(state["a"]).alias("a"),
            F.when(odd, state["b"]).otherwise(added(state["b"], state["a"], radix[1])).alias("b"),
        )

    start = F.struct(high.cast("long").alias("a"), low.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: result(s["a"], s["b"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; ``doubled`` is the parity of the doubled places, counted from the last digit."""
    def worth(sign, i):
        digit = F.ascii(sign) - 48
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(sign == "", 0).when(i % 2 == doubled, twice).otherwise(digit)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x)


def card(value: Column, key: str) -> Column:
    payload = permuted_text(F.substr(value, F.lit(1), F.length(value) - 1), key, "card")
    check = F.pmod(-_luhn_sum(_digits(payload), 0), F.lit(10))
    return F.when(_luhn_sum(_digits(value), 1) % 10 == 0, F.concat(payload, check.cast("string")))


def _remainder(signs: Column) -> Column:
    """The IBAN remainder by 97, letters counting from 10."""
    def step(total, sign):
        code = F.ascii(sign)
        return F.when(sign == "", total).when(code < 65, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(F.split(signs, ""), F.lit(0), step)


def iban(value: Column, key: str) -> Column:
    bare = F.regexp_replace(value, " ", "")
    country, own = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5))
    valid = _remainder(F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))) == 1
    moved = permuted_text(own, key, "iban")
    check = F.lit(98) - _remainder(F.concat(F.regexp_replace(moved, " ", ""), country, F.lit("00")))
    return F.when(valid, F.concat(country, F.lpad(check.cast("string"), 2, "0"), moved))


def phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^(\+[0-9]{1,3})?", 0)
    moved = F.concat(country, permuted_text(F.substr(value, F.length(country) + 1), key, "phone"))
    return F.when(F.length(_digits(value)).between(8, 15), moved)


def ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)

    def result(a, b):
        of = F.floor(a / 99)
        of = F.when(of >= 665, of + 2).otherwise(of + 1)
        return F.format_string("%03d-%02d-%04d", of.cast("long"), F.pmod(a, F.lit(99)) + 1, b + 1)

    return F.when(valid, permuted_number(place * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn", result))


def ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    half = [octets[0] * 256 + octets[1], octets[2] * 256 + octets[3]]

    def result(a, b):
        parts = [F.floor(a / 256), F.pmod(a, F.lit(256)), F.floor(b / 256), F.pmod(b, F.lit(256))]
        return F.concat_ws(".", *[p.cast("long").cast("string") for p in parts])

    return F.when(F.forall(octets, lambda o: o < 256), permuted_number(*half, (1 << 16, 1 << 16), key, "ip", result))


def date(value: Column, key: str) -> Column:
    """In the first notation that makes it a day of 1900 to 2099."""
    found = F.lit(None).cast("string")
    for form in reversed(DATE_FORMATS):
        day = F.datediff(F.try_to_date(value, form), F.lit(FIRST_DAY).cast("date"))

        def result(a, b, form=form):
            moved = F.date_add(F.lit(FIRST_DAY).cast("date"), (a * DAYS[1] + b).cast("int"))
            return F.date_format(moved, form)

        moved = permuted_number(F.floor(day / DAYS[1]), F.pmod(day, F.lit(DAYS[1])), DAYS, key, "date", result)
        found = F.when(day.between(0, DAYS[0] * DAYS[1] - 1), moved).otherwise(found)
    return found


def email(value: Column, key: str) -> Column:
    name = F.regexp_extract(value, "^[^@]+", 0)
    return F.concat(permuted_text(name, key, "email"), F.substr(value, F.length(name) + 1))


KINDS = {"email": email, "iban": iban, "card": card, "phone": phone, "ssn": ssn, "ip": ip, "date": date}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a matched value, or null if it is not valid as anything."""
    tries = [F.when(value.rlike(f"^(?:{SHAPES[kind]})$"), make(value, key)) for kind, make in KINDS.items()]
    return F.coalesce(*tries)


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and how many in ``n_replaced``."""
    body = F.col(f"`{text}`")
    found = F.transform(F.regexp_extract_all(body, F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    columns = [c for c in docs.columns if c.lower() not in ("n_replaced", "__found")]
    marked = docs.select(*[F.col(f"`{c}`") for c in columns], F.when(body.rlike(ANY), found).alias("__found"))
    values = F.concat(F.transform("__found", lambda f: F.coalesce(f["new"], f["old"])), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(body, ANY, -1), values, lambda gap, value: F.concat(gap, value)), "")
    number = F.size(F.filter("__found", lambda f: f["new"].isNotNull()))
    cleaned = F.when(F.col("__found").isNull(), body).otherwise(joined)
    return marked.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in columns],
        F.when(F.col("__found").isNull(), 0).otherwise(number).cast("long").alias("n_replaced"),
    )
