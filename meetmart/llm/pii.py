"""Format-preserving pseudonyms for personal numbers, dates and mail names, in built-in functions only.

Each value that passes its check (calendar, Luhn, octets, ranges of social security numbers) is replaced by
another valid value of the same format, by a Feistel network keyed with a secret. The network permutes the
values of a format, so equal values have equal pseudonyms in all documents and different values stay apart.
Numbers that fail their check are left as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Days of 400 Gregorian years, as a product, and the first day of a cycle.
_CYCLE, _CYCLE_A, _CYCLE_B, _CYCLE_START = 146_097, 189, 773, "1600-01-01"
#: Letters and digits of a mail name that are permuted together; halves fit 64 bits in base 36.
_MAIL_CHUNK = 22

#: Country codes of one, two and three digits.
_COUNTRY = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_ISO_DAY_ENDS = r"(?:(?![0-9A-Za-z/-])|(?=[Tt][0-9]{2})|(?=Z(?![0-9A-Za-z])))"
#: Country code and ten digits, the last ten of which are the number.
_TEN_DIGITS = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
_TRUNK = r"(?:\(0[0-9]{1,4}\) ?|0[1-9][0-9]{1,3}[ /-])[0-9]{3,4}[ -]?[0-9]{3,4}"
_DATE = (
    r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}" + _ISO_DAY_ENDS
    + r"|(?:[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.|-[0-9]{1,2}-)[0-9]{4}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2})(?![0-9A-Za-z/-]))"
)
_LETTER = r"\p{L}\p{M}0-9"

#: Kind, pattern of its candidates (Java). Where several fit at a place, the first does.
PATTERNS = (
    ("mail", rf"(?<![{_LETTER}._%+-])[{_LETTER}][{_LETTER}._%+'’-]{{0,63}}" + r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,8}\.[A-Za-z]{2,}"),
    ("date", _DATE),
    ("ip", r"(?<![0-9A-Za-z])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])"),
    ("phone", r"(?<![0-9A-Za-z])" + _TEN_DIGITS + r"(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])(?=" + _COUNTRY + r")\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,5}\))?(?:(?:[.-]| (?!" + _DATE + r"))?[0-9]){5,13}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+,.-])(?<![0-9] )[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9A-Za-z-])(?![ .,][0-9])"),
    ("phone", r"(?<![0-9A-Za-z+,.-])(?<![0-9] )" + _TRUNK + r"(?![0-9A-Za-z-])(?! [0-9])"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
)
#: A card candidate is a whole run of 13 digits or more with single separators, up to where another kind begins;
#: `_cards` finds the cards in it.
_NEXT = r"(?:-| (?!" + "|".join(pattern for _, pattern in PATTERNS) + "))"
_RUN = (
    rf"(?<![0-9A-Za-z])(?=(?:[0-9](?![A-Za-z]){_NEXT}?){{12}}[0-9]++(?![A-Za-z]))"
    rf"[0-9]++(?:{_NEXT}[0-9]++(?![A-Za-z]))*+"
)
_DOTTED = r"(?<![0-9A-Za-z.-])[0-9]{4}\.(?:[0-9]{4}\.[0-9]{4}\.[0-9]{4}|[0-9]{6}\.[0-9]{5})(?![0-9A-Za-z-])(?!\.[0-9])"
PATTERNS += (("card", _DOTTED), ("card", _RUN))
_ANY = "|".join(pattern for _, pattern in PATTERNS)
#: Shortest and longest card, and the groups that cards are printed in.
_CARD_DIGITS = range(13, 20)
_PRINTED = r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -](?:[0-9]{1,4}|[0-9]{4}[ -][0-9]{1,3}|[0-9]{5})|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{5}|[0-9]{4}(?:[ -][0-9]{3}){3}|[0-9]{6}[ -][0-9]{13})$"


def _keyed(key: str, tweak: str, turn: Column, value: Column, modulus: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % modulus


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: str) -> Column:
    """struct(x, y): a keyed permutation of the pairs with 0 <= x < a and 0 <= y < b."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y")),
        lambda s, turn: F.when(
            turn % 2 == 1,
            F.struct(((s["x"] + _keyed(key, tweak, turn, s["y"], a)) % a).alias("x"), s["y"].alias("y")),
        ).otherwise(F.struct(s["x"].alias("x"), ((s["y"] + _keyed(key, tweak, turn, s["x"], b)) % b).alias("y"))),
    )


def _then(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permuted_digits(digits: Column, radix: int, key: str, tweak: str) -> Column:
    """A string of digits in radix 10 or 36, permuted among those of its length (22 at most)."""
    powers = F.array(*[F.lit(radix**k).cast("bigint") for k in range(12)])
    size = F.char_length(digits)
    half = F.shiftright(size, 1)

    def number(text: Column) -> Column:
        return F.when(text == "", F.lit(0)).otherwise(F.conv(text, radix, 10)).cast("bigint")

    def text(value: Column, width: Column) -> Column:
        return F.lower(F.lpad(F.conv(value.cast("string"), 10, radix), width, F.lit("0")))

    mixed = feistel(
        number(F.substr(digits, F.lit(1), half)),
        number(F.substr(digits, half + 1, size - half)),
        F.element_at(powers, half + 1),
        F.element_at(powers, size - half + 1),
        key,
        tweak,
    )
    return F.when(size == 0, "").otherwise(
        _then(mixed, lambda m: F.concat(F.when(half > 0, text(m["x"], half)).otherwise(""), text(m["y"], size - half)))
    )


def _laid_out(shape: Column, kept: str, letters: Column) -> Column:
    """`shape` with its characters of class `kept` replaced, one after the other, by those of `letters`."""
    filled = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike(kept),
            F.struct(F.concat(s["out"], F.substr(letters, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )
    return filled


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of the digits with every second doubled; `doubled_from_right` is 0 or 1, the first that is."""
    return F.aggregate(
        F.reverse(F.split(digits, "")),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at")),
        lambda s, c: F.struct(
            (
                s["sum"]
                + F.when(
                    s["at"] % 2 == doubled_from_right,
                    F.get(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int")),
                ).otherwise(c.cast("int"))
            ).alias("sum"),
            (s["at"] + 1).alias("at"),
        ),
        lambda s: s["sum"],
    )


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(m: Column, key: str) -> Column:
    """The pseudonym of a card number that passes its check."""

    def made(digits: Column) -> Column:
        n = F.char_length(digits)
        middle = _permuted_digits(F.substr(digits, F.lit(2), n - 2), 10, key, "card")
        body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), middle)
        with_check = _then(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")))
        return _laid_out(m, "[0-9]", with_check)

    return _then(_only_digits(m), made)


_SPANS = "array<struct<start: int, text: string>>"


def _cards(run: Column) -> Column:
    """Spans of a run between separators that pass the check, in order and without overlap.

    Where spans overlap, those in groups that cards are printed in go first, then the longest, then the first.
    """
    at = F.filter(
        F.sequence(F.lit(1), F.char_length(run)),
        lambda p: (p == 1) | F.substr(run, p - 1, F.lit(1)).isin(" ", "-", "."),
    )

    def begun(p: Column) -> Column:
        rest = F.substr(run, p, F.lit(2 * _CARD_DIGITS[-1]))
        texts = _then(
            rest,
            lambda r: F.array(
                *[F.regexp_extract(r, rf"^(?:[0-9][ .-]?){{{n - 1}}}[0-9](?![0-9])", 0) for n in _CARD_DIGITS]
            ),
        )
        valid = F.filter(texts, lambda t: (t != "") & (_luhn_sum(_only_digits(t), 1) % 10 == 0))
        return F.transform(
            valid,
            lambda t: F.struct(
                (~t.rlike(_PRINTED)).alias("odd"),
                (-F.char_length(_only_digits(t))).alias("less"),
                p.alias("start"),
                t.alias("text"),
            ),
        )

    def clash(a: Column, b: Column) -> Column:
        return (a["start"] < b["start"] + F.char_length(b["text"])) & (b["start"] < a["start"] + F.char_length(a["text"]))

    taken = F.aggregate(
        F.array_sort(F.flatten(F.transform(at, begun))),
        F.array().cast(_SPANS),
        lambda s, c: F.when(F.exists(s, lambda o: clash(o, c)), s).otherwise(
            F.concat(s, F.array(F.struct(c["start"].alias("start"), c["text"].alias("text"))).cast(_SPANS))
        ),
    )
    return F.array_sort(taken)


def _phone(m: Column, key: str) -> Column:
    national = F.regexp_extract(m, r"^(\+[0-9]{1,3}[ .-]?)?(.*)$", 2)
    # without a separator behind the country code, the last ten digits are the number
    ten = F.when(_only_digits(national) == F.right(_only_digits(m), F.lit(10)), national).otherwise(
        F.regexp_extract(m, r"((?:[^0-9]*[0-9]){10})$", 1)
    )
    # other lengths: what follows the country code and the bracketed zero that is not dialled behind it
    # or what follows the zero that stands for it within a country
    other = F.regexp_extract(m, rf"^(?:{_COUNTRY}(?:[ .-]?\(0\))?|\(?0)?(.*)$", 1)
    rest = F.when(m.rlike(rf"^(?:{_TEN_DIGITS}|(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}})$"), ten).otherwise(other)
    return _then(
        rest,
        lambda r: F.concat(
            F.substr(m, F.lit(1), F.char_length(m) - F.char_length(r)),
            _laid_out(r, "[0-9]", _permuted_digits(_only_digits(r), 10, key, "phone")),
        ),
    )


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))

    def made(o: Column) -> Column:
        side = F.lit(65_536).cast("bigint")
        mixed = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], side, side, key, "ip")
        parts = _then(
            mixed,
            lambda v: F.concat_ws(
                ".", *[(F.shiftright(v[c], s).bitwiseAND(F.lit(255))).cast("string") for c in "xy" for s in (8, 0)]
            ),
        )
        return F.when(F.array_max(o) <= 255, parts)

    return _then(octets, made)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)

    def text(v: Column) -> Column:
        index = F.floor(v["x"] / 99)
        area = index + 1 + F.when(index + 1 >= 666, 1).otherwise(0)
        return F.concat_ws(
            "-",
            F.lpad(area.cast("string"), 3, "0"),
            F.lpad((v["x"] % 99 + 1).cast("string"), 2, "0"),
            F.lpad((v["y"] + 1).cast("string"), 4, "0"),
        )

    sizes = F.lit(898 * 99).cast("bigint"), F.lit(9999).cast("bigint")
    return F.when(valid, _then(feistel(index * 99 + group - 1, serial - 1, *sizes, key, "ssn"), text))


def _date(m: Column, key: str) -> Column:
    """Days year first, or with dots day first, with slashes month first, with hyphens day first; where that is no
    day, the other way round. Equal days have equal pseudonyms; without leading zeros in the one, none in the other."""
    bare = m.rlike(r"(?<![0-9])[0-9](?![0-9])")

    def made(*parts: str) -> Column:
        """`parts`: the mark between the numbers, then their letters in order."""
        mark, *letters = parts
        short = mark.join("yyyy" if c == "y" else c for c in letters)
        full = mark.join("yyyy" if c == "y" else c * 2 for c in letters)
        day = F.try_to_timestamp(m, F.lit(short)).cast("date")
        since = F.datediff(day, F.lit(_CYCLE_START).cast("date")).cast("bigint")
        left = F.pmod(since, F.lit(_CYCLE))
        sizes = F.lit(_CYCLE_A).cast("bigint"), F.lit(_CYCLE_B).cast("bigint")
        mixed = feistel(F.floor(left / _CYCLE_B), left % _CYCLE_B, *sizes, key, "date")
        moved = _then(mixed, lambda v: (since - left + v["x"] * _CYCLE_B + v["y"]).cast("int"))
        new = F.date_add(F.lit(_CYCLE_START).cast("date"), moved)
        return F.when(since >= 0, F.when(bare, F.date_format(new, short)).otherwise(F.date_format(new, full)))

    return (
        F.when(m.rlike("^[0-9]{4}-"), made("-", "y", "M", "d"))
        .when(m.rlike("^[0-9]{4}/"), made("/", "y", "M", "d"))
        .when(m.contains("-"), F.coalesce(made("-", "d", "M", "y"), made("-", "M", "d", "y")))
        .when(m.contains("."), made(".", "d", "M", "y"))
        .otherwise(F.coalesce(made("/", "M", "d", "y"), made("/", "d", "M", "y")))
    )


def _mail(m: Column, key: str) -> Column:
    """A name in ASCII is permuted. One with other letters gets ASCII ones from a keyed hash, as many as it has."""
    name = F.lower(F.substring_index(m, "@", 1))
    letters = F.regexp_replace(name, "[^a-z0-9]", "")
    chunks = [
        _permuted_digits(F.substr(letters, F.lit(k * _MAIL_CHUNK + 1), F.lit(_MAIL_CHUNK)), 36, key, f"mail{k}")
        for k in range(3)
    ]
    hashed = [
        F.right(F.lpad(F.lower(F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"name{k}"), name), 256), 1, 14), 16, 36)), 11, "0"), F.lit(10))
        for k in range(7)
    ]
    plain = F.concat(_laid_out(name, "[a-z0-9]", F.concat(*chunks)))
    other = _laid_out(name, rf"[{_LETTER}]", F.concat(*hashed))
    new = F.when(name.rlike(r"[^\x00-\x7F’]"), other).otherwise(plain)
    return F.concat(new, F.lit("@"), F.substring_index(m, "@", -1))


def _kind(m: Column) -> Column:
    return (
        F.when(m.contains("@"), "mail")
        .when(m.rlike(r"^(?:[0-9]{4}([/-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\2[0-9]{4})$"), "date")
        .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
        .when(m.rlike(r"^\+|^\(|^[0-9]{3}([ .-])[0-9]{3}[.-][0-9]{4}$|^[0-9]{3} [0-9]{3} [0-9]{4}$"), "phone")
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(m.rlike(rf"^{_TRUNK}$"), "phone")
        .otherwise("card")
    )


_PIECES = "array<struct<kind: string, new: string, shown: string>>"


def _piece(kind: Column, new: Column, old: Column) -> Column:
    return F.array(F.struct(kind.alias("kind"), new.alias("new"), F.coalesce(new, old).alias("shown"))).cast(_PIECES)


def _kept(text: Column) -> Column:
    none = F.lit(None).cast("string")
    return _piece(none, none, text)


def _pieces(match: Column, key: str) -> Column:
    """A match as array of struct(kind, new, shown); `new` is null for what fails its check or lies between cards."""

    def made(kind: Column) -> Column:
        value = F.when(kind == "mail", _mail(match, key))
        for name, make in (("date", _date), ("ip", _ip), ("phone", _phone), ("ssn", _ssn)):
            value = value.when(kind == name, make(match, key))
        return F.when(kind == "card", cards).otherwise(_then(value, lambda v: _piece(kind, v, match)))

    cards = F.aggregate(
        _cards(match),
        F.struct(F.lit(1).alias("at"), F.array().cast(_PIECES).alias("out")),
        lambda s, c: F.struct(
            (c["start"] + F.char_length(c["text"])).alias("at"),
            F.concat(
                s["out"],
                _kept(F.substr(match, s["at"], c["start"] - s["at"])),
                _then(_card(c["text"], key), lambda v: _piece(F.lit("card"), v, c["text"])),
            ).alias("out"),
        ),
        lambda s: F.concat(s["out"], _kept(F.substr(match, s["at"]))),
    )
    return _then(_kind(match), made)


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """`docs` with pseudonyms in `text_col`; all other columns and rows stay as they are.

    `found_col` adds the replaced places: array of kind, start (characters, from 0, in the new text) and
    pseudonym; never the value itself. Null texts stay null, with no places.
    """
    other = uuid.uuid4().hex  # names that no column of `docs` has
    raw, made = f"_matches_{other}", f"_made_{other}"
    text = F.col(text_col)
    matches = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))).otherwise(F.array())
    with_matches = docs.withColumn(raw, F.coalesce(matches, F.array().cast("array<string>")))
    values = with_matches.withColumn(made, F.transform(raw, lambda m: _pieces(m, key)))
    parts = F.flatten(
        F.zip_with(
            F.split(text, _ANY, -1), made, lambda gap, p: F.concat(_kept(gap), F.coalesce(p, F.array().cast(_PIECES)))
        )
    )
    hit = F.exists(F.flatten(made), lambda p: p["new"].isNotNull())
    out = values.withColumn(raw, F.when(hit, parts))
    if found_col:
        places = F.aggregate(
            F.coalesce(F.col(raw), F.array().cast(_PIECES)),
            F.struct(
                F.lit(0).cast("bigint").alias("at"),
                F.array().cast("array<struct<kind:string,start:bigint,pseudonym:string>>").alias("found"),
            ),
            lambda s, p: F.struct(
                (s["at"] + F.char_length(p["shown"])).alias("at"),
                F.when(p["new"].isNull(), s["found"])
                .otherwise(
                    F.concat(
                        s["found"],
                        F.array(F.struct(p["kind"].alias("kind"), s["at"].alias("start"), p["new"].alias("pseudonym"))),
                    )
                )
                .alias("found"),
            ),
            lambda s: s["found"],
        )
        out = out.withColumn(found_col, places)
    joined = F.concat_ws("", F.transform(raw, lambda p: p["shown"]))
    return out.withColumn(text_col, F.when(F.col(raw).isNull(), text).otherwise(joined)).drop(raw, made)


def pii_digest(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_found, kinds, found) per row of `docs`; null texts stay null with nothing found.

    Repeated rows give repeated results. Other columns of `docs` are not read.
    """
    found = pseudonymize(docs.select("doc_id", F.col("text").cast("string").alias("text")), key, found_col="found")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["kind"]))), ",")
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), kinds.alias("kinds"), "found")
