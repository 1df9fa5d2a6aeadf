import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from newsloom.llm import pseudonyms as P

KEY = "k"


def digest(kind, number, other):
    return hashlib.sha256(f"{KEY}|{kind}|{number}|{other}|{KEY}".encode()).hexdigest()


def plain_text(value, kind):
    a, b = value[: len(value) // 2], value[len(value) // 2 :]
    for number in range(1, 11):
        h, out = digest(kind, number, b), ""
        for i, c in enumerate(a):
            by = int(h[i % 16 * 4 :][:4], 16)
            for low, size in (("0", 10), ("a", 26), ("A", 26)):
                if ord(low) <= ord(c) < ord(low) + size:
                    c = chr(ord(low) + (ord(c) - ord(low) + by) % size)
                    break
            out += c
        a, b = b, out
    return a + b


def plain_number(a, b, radix, kind):
    for number in range(1, 11):
        if number % 2:
            a = (a + int(digest(kind, number, b)[:12], 16)) % radix[0]
        else:
            b = (b + int(digest(kind, number, a)[:12], 16)) % radix[1]
    return a, b


def luhn(digits):
    d = [int(c) for c in re.sub(r"\D", "", digits)][::-1]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def replaced(spark, texts):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, n_replaced string")
    return [(r["text"], r["n_replaced"]) for r in P.pseudonymize(frame, KEY).orderBy("doc_id").collect()]


def test_each_kind(spark):
    got = replaced(spark, [
        "pay 4111 1111 1111 1111, 4111111111111111!", "call +1 (017) 555-7713.", "at 97.51.17.173.", "born 1985-03-02", "02.03.1985",
        "03/02/1985 and 25/12/1999", "078-05-1120", "DE89 3704 0044 0532 0130 00", "und.34@mail7.example.com,",
        "4111111111111112 999.1.1.1 2023-02-30 666-12-3456 DE00370400440532013000 1.2.3.4.5 a4111111111111111", "", None,
        "7536784127813050 4845168114407329"])
    texts = [t for t, _ in got]
    spaced, bare = re.match(r"pay (.*), (.*)!", texts[0]).groups()
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", spaced) and luhn(spaced) % 10 == 0 and luhn(bare) % 10 == 0
    payload = plain_text("411111111111111", "card")
    assert bare == payload + str(-luhn(payload + "0") % 10)
    assert texts[1] == "call +1" + plain_text(" (017) 555-7713", "phone") + "."
    a, b = plain_number(97 * 256 + 51, 17 * 256 + 173, (65536, 65536), "ip")
    assert texts[2] == f"at {a // 256}.{a % 256}.{b // 256}.{b % 256}."
    n = (date(1985, 3, 2) - date(1900, 1, 1)).days
    a, b = plain_number(n // 4297, n % 4297, (17, 4297), "date")
    day = date(1900, 1, 1) + timedelta(a * 4297 + b)
    assert texts[3] == f"born {day}" and texts[4] == day.strftime("%d.%m.%Y") and texts[5].startswith(day.strftime("%m/%d/%Y"))
    assert re.fullmatch(r"\d\d\d-\d\d-\d\d\d\d", texts[6]) and texts[6] != "078-05-1120"
    code = texts[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1 and [len(x) for x in texts[7].split()] == [4, 4, 4, 4, 4, 2]
    assert texts[8] == plain_text("und.34", "email") + "@mail7.example.com,"
    assert got[9] == ("4111111111111112 999.1.1.1 2023-02-30 666-12-3456 DE00370400440532013000 1.2.3.4.5 a4111111111111111", 0)
    assert got[10:12] == [("", 0), (None, 0)]
    assert [n for _, n in got[:9]] == [2, 1, 1, 1, 1, 2, 1, 1, 1]


@pytest.mark.parametrize("kind,form", [("phone", "555-%04d"), ("date", "")])
def test_permutation(spark, kind, form):
    """A whole domain maps onto itself."""
    numbers = spark.range(10_000 if kind == "phone" else 73_049)
    if kind == "date":
        value = F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
        moved = P.date(value, KEY)
    else:
        value = F.format_string("%04d", "id")
        moved = P.permuted_text(value, KEY, "phone")
    found = numbers.select(value.alias("v"), moved.alias("m"))
    assert found.select("m").distinct().count() == numbers.count()
    assert found.join(found.select(F.col("v").alias("m")), "m").count() == numbers.count()


def test_long_texts_and_empty_table(spark):
    texts = ["a" * 300_000, "1" * 200_000, "1." * 100_000, "a." * 100_000 + "@", "4111111111111111 " * 3000, "+" * 100_000]
    got = replaced(spark, texts)
    assert [n for _, n in got] == [0, 0, 0, 0, 3000, 0] and [t for t, _ in got][:4] == texts[:4]
    assert P.pseudonymize(spark.createDataFrame([], "doc_id long, text string"), KEY).count() == 0
