import datetime as dt
import hashlib
import itertools
import re

import pytest
from llm_cases import documents, odd_texts
from pyspark.sql import functions as F

from meetmart.llm import pii

KEY = "test key"


# Brute force


def keyed(tweak, turn, value, modulus):
    digest = hashlib.sha256(f"{KEY}|{tweak}|{turn}|{value}".encode()).hexdigest()
    return int(digest[:15], 16) % modulus


def feistel(x, y, a, b, tweak):
    for turn in range(1, pii.ROUNDS + 1):
        if turn % 2:
            x = (x + keyed(tweak, turn, y, a)) % a
        else:
            y = (y + keyed(tweak, turn, x, b)) % b
    return x, y


def base36(n, width):
    out = ""
    while n:
        n, r = divmod(n, 36)
        out = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + out
    return out.rjust(width, "0")


def digits(text, radix, tweak):
    if not text:
        return ""
    half = len(text) // 2
    x, y = feistel(int(text[:half] or "0", radix), int(text[half:], radix), radix**half, radix ** (len(text) - half), tweak)
    show = (lambda n, w: str(n).rjust(w, "0")) if radix == 10 else base36
    return (show(x, half) if half else "") + show(y, len(text) - half)


def laid_out(shape, kept, letters):
    letters = iter(letters)
    return "".join(next(letters) if re.match(kept, c) else c for c in shape)


def luhn(text):
    total = 0
    for k, c in enumerate(reversed(text)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(m):
    d = re.sub(r"\D", "", m)
    if not luhn(d):
        return None
    body = d[0] + digits(d[1:-1], 10, "card")
    check = next(c for c in "0123456789" if luhn(body + c))
    return laid_out(m, r"\d", body + check)


def date(m):
    for form, shape in (("%Y-%m-%d", "-"), ("%d.%m.%Y", "."), ("%m/%d/%Y", "/"), ("%d/%m/%Y", "/")):
        if shape not in m:
            continue
        try:
            day = dt.datetime.strptime(m, form).date()
        except ValueError:
            continue
        since = (day - dt.date(1600, 1, 1)).days
        if since < 0:
            return None
        left = since % 146_097
        x, y = feistel(left // 773, left % 773, 189, 773, "date")
        day = dt.date(1600, 1, 1) + dt.timedelta(days=since - left + x * 773 + y)
        return {"-": f"{day:%Y-%m-%d}", ".": f"{day:%d.%m.%Y}", "/": day.strftime(form)}[shape]
    return None


def ip(m):
    o = list(map(int, m.split(".")))
    if max(o) > 255:
        return None
    x, y = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
    return f"{x >> 8}.{x & 255}.{y >> 8}.{y & 255}"


def mail(m):
    name, _, domain = m.rpartition("@")
    name = name.lower()
    letters = re.sub("[^a-z0-9]", "", name)
    made = "".join(digits(letters[22 * k : 22 * k + 22], 36, f"mail{k}") for k in range(3))
    return laid_out(name, "[a-z0-9]", made) + "@" + domain


VALUES = [
    ("card", "4111 1111 1111 1111"), ("card", "4111111111111111"), ("card", "378282246310005"), ("card", "5555-5555-5555-4444"),
    ("card", "4111111111111112"), ("date", "2024-02-29"), ("date", "2023-02-30"), ("date", "31.12.1999"), ("date", "12/31/1999"),
    ("date", "31/12/1999"), ("date", "1500-01-01"), ("date", "9999-12-31"), ("ip", "10.0.0.255"), ("ip", "256.1.1.1"),
    ("mail", "Jane.Doe+x@mail.example.com"), ("mail", "a@b.co"), ("mail", "abcdefghijklmnopqrstuvwxyz.0123456789@x.org"),
]
MAKE = {"card": card, "date": date, "ip": ip, "mail": mail}


def pseudonyms(spark, values):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "doc_id bigint, text string")
    rows = pii.pii_digest(frame, KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_values_agree_with_brute_force(spark):
    got = pseudonyms(spark, [v for _, v in VALUES])
    assert got == [MAKE[kind](v) or v for kind, v in VALUES]


def test_phones_and_social_security_numbers(spark):
    values = ["+1 (017) 555-7713", "212-555-1234", "(212) 555-1234", "+12125551234", "123-45-6789", "000-12-3456", "666-12-3456", "123-00-6789"]
    got = pseudonyms(spark, values)
    assert got[0] == laid_out(values[0], r"\d", "1" + digits("0175557713", 10, "phone"))
    national = digits("2125551234", 10, "phone")
    assert [re.sub(r"\D", "", g)[-10:] for g in got[1:4]] == [national] * 3
    assert got[3].startswith("+1") and re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", got[2])
    area, group, serial = map(int, got[4].split("-"))
    assert got[4] != values[4] and area not in (0, 666) and area < 900 and group and serial
    assert got[5:] == values[5:]


def test_the_network_is_a_permutation(spark):
    pairs = [(x, y) for x in range(7) for y in range(11)]
    frame = spark.createDataFrame(pairs, "x bigint, y bigint")
    a, b = F.lit(7).cast("bigint"), F.lit(11).cast("bigint")
    got = [tuple(r[0]) for r in frame.select(pii.feistel(F.col("x"), F.col("y"), a, b, KEY, "t")).collect()]
    assert sorted(got) == pairs and got == [feistel(x, y, 7, 11, "t") for x, y in pairs]


def test_all_social_security_areas_stay_apart(spark):
    values = [f"{a:03}-{g:02}-0001" for a, g in itertools.product([1, 2, 664, 665, 667, 668, 898, 899], range(1, 100, 7))]
    got = pseudonyms(spark, values)
    assert len(set(got)) == len(values)
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", g) for g in got)


@pytest.mark.parametrize("extra", [False, True])
def test_texts_around_values_stay(spark, extra):
    rows = odd_texts() + [
        (20, "a 4111111111111111, b 4111111111111111. 10.0.0.1"),
        (21, "version 1.2.3.4.5 id x4111111111111111 4111111111111112 2024-02-290 call 12-34"),
        (22, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'),
    ]
    docs = documents(spark, rows, extra)
    got = {r.doc_id: r for r in pii.pii_digest(docs, KEY).collect()}
    made = card("4111111111111111")
    assert got[20].text == f"a {made}, b {made}. {ip('10.0.0.1')}"
    assert [(f.kind, f.start, f.pseudonym) for f in got[20].found] == [("card", 2, made), ("card", 22, made), ("ip", 40, ip("10.0.0.1"))]
    assert (got[20].n_found, got[20].kinds) == (3, "card,ip")
    for i, t in rows:
        if i != 20:
            assert got[i].text == t and got[i].n_found == 0 and got[i].found == []
    whole = pii.pseudonymize(docs, KEY)
    assert whole.columns == docs.columns and whole.count() == len(rows)


def test_very_long_runs(spark):
    rows = [(1, "a@" + "b." * 20_000 + "com"), (2, "1" * 20_000), (3, "1-" * 20_000), (4, "x@" * 20_000), (5, "1.2." * 20_000)]
    got = {r.doc_id: r.text for r in pii.pii_digest(documents(spark, rows), KEY).collect()}
    assert all(len(got[i]) == len(t) for i, t in rows) and got[2] == rows[1][1]


def test_another_key_gives_other_pseudonyms(spark):
    frame = documents(spark, [(1, "4111111111111111")])
    assert len({pii.pii_digest(frame, k).first().text for k in ("a", "b", "c")}) == 3


def test_no_python_in_the_plan(spark):
    plan = pii.pii_digest(documents(spark, [(1, "x")]), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert pii.pii_digest(documents(spark, []), KEY).collect() == []


def test_cards_among_other_digits(spark):
    made = {c: card(c) for c in ("4111 1111 1111 1111", "4111-1111-1111-1111", "5555 5555 5555 4444", "3782 822463 10005")}
    a, b, c, d = made
    day, address = "2024-02-29", "10.0.0.1"
    texts = {
        f"{a} 123": f"{made[a]} 123",
        f"{a} 12/27": f"{made[a]} 12/27",
        f"item 7 {b}": f"item 7 {made[b]}",
        f"{a} {c} 7 {d}": f"{made[a]} {made[c]} 7 {made[d]}",
        f"{a} {day}": f"{made[a]} {date(day)}",
        f"{a} {address} {a}": f"{made[a]} {ip(address)} {made[a]}",
        f"{a} 2nd": f"{made[a]} 2nd",
        "1234 4111 1111 1111 1112": "1234 4111 1111 1111 1112",
    }
    frame = documents(spark, list(enumerate(texts)))
    rows = {r.doc_id: r for r in pii.pii_digest(frame, KEY).collect()}
    assert [rows[k].text for k in range(len(texts))] == list(texts.values())
    for r in rows.values():
        assert all(r.text[f.start :].startswith(f.pseudonym) for f in r.found)


def test_the_day_of_a_time_is_replaced(spark):
    day = date("1980-02-03")
    got = pseudonyms(spark, ["1980-02-03T00:00:00Z", "1980-02-03 00:00", "at 1980-02-03Z", "1980-02-03x"])
    assert got == [f"{day}T00:00:00Z", f"{day} 00:00", f"at {day}Z", "1980-02-03x"]


def test_phones_of_other_shapes(spark):
    values = ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+49 30 123456", "+4930123456", "020 7946 0958", "(0171) 1234567", "030/123456"]
    got = pseudonyms(spark, values)
    london, berlin = digits("2079460958", 10, "phone"), digits("30123456", 10, "phone")
    assert got[0] == laid_out(values[0], r"\d", "44" + london)
    assert got[1] == "+44" + london and got[2] == laid_out(values[2], r"\d", "440" + london)
    assert [re.sub(r"\D", "", g) for g in got[3:5]] == ["49" + berlin] * 2
    assert all(g != v and re.sub(r"\d", "0", g) == re.sub(r"\d", "0", v) for g, v in zip(got, values))


def test_further_spellings_of_a_day_share_its_pseudonym(spark):
    y, m, d = map(int, date("1985-03-14").split("-"))
    spellings = {
        "3/14/1985": f"{m}/{d}/{y}", "14.3.1985": f"{d}.{m}.{y}", "14-03-1985": f"{d:02}-{m:02}-{y}", "1985/03/14": f"{y}/{m:02}/{d:02}",
        "14/3/1985": f"{d}/{m}/{y}", "1985/3/14": f"{y}/{m}/{d}", "14.03.1985": f"{d:02}.{m:02}.{y}", "03-14-1985": f"{m:02}-{d:02}-{y}",
    }
    assert pseudonyms(spark, list(spellings)) == list(spellings.values())
    others = ["32.1.1985", "1.2.3", "3/14/85", "1985/13/14", "14-03/1985", "1-2-3-1985", "v1.14.3.1985"]
    assert pseudonyms(spark, others) == others


def test_phones_with_spaces_and_the_zero_before_an_area(spark):
    ten, london = digits("5551234567", 10, "phone"), digits("2079460958", 10, "phone")
    got = pseudonyms(spark, ["555 123 4567", "555-123-4567", "+1 555 123 4567", "020 7946 0958", "+44 20 7946 0958", "(0171) 1234567"])
    assert got[0] == f"{ten[:3]} {ten[3:6]} {ten[6:]}" and got[1] == got[0].replace(" ", "-")
    assert got[2] == "+1 " + got[0]
    assert got[3] == laid_out("020 7946 0958", r"\d", "0" + london) and got[4].endswith(got[3][1:])
    assert got[5].startswith("(0") and re.sub(r"\D", "", got[5])[1:] == digits("1711234567", 10, "phone")
    lists = ["12 555 123 4567", "555 123 4567 89", "1555 123 4567", "555 123 45678"]
    assert pseudonyms(spark, lists) == lists


def test_cards_with_dots(spark):
    made = card("4111111111111111")
    dotted = ".".join(made[k : k + 4] for k in range(0, 16, 4))
    got = pseudonyms(spark, ["4111.1111.1111.1111", "see 4111.1111.1111.1111.", "4111.1111.1111.1112", "4111.1111.1111.1111.5"])
    assert got == [dotted, f"see {dotted}.", "4111.1111.1111.1112", "4111.1111.1111.1111.5"]


def test_mail_names_with_other_letters_and_apostrophes(spark):
    names = ["josé@example.com", "JOSÉ@example.com", "jose@example.com", "иван.петров@example.org", "o'brien@x.org", "'bob@x.org'", "é@x.org"]
    got = pseudonyms(spark, names)
    assert got[0] == got[1] != got[2] and re.fullmatch(r"[a-z0-9]{4}@example\.com", got[0])
    assert re.fullmatch(r"[a-z0-9]{4}\.[a-z0-9]{6}@example\.org", got[3])
    assert got[4] == mail("o'brien@x.org") and got[5] == f"'{mail('bob@x.org')}'"
    assert re.fullmatch(r"[a-z0-9]@x\.org", got[6])
