"""Format-preserving pseudonyms for personal data.

Validated numbers and dates are permuted by a keyed Feistel network over the
values of their own format, so a pseudonym is valid in the same format, equal
values get equal pseudonyms in every document, and different values stay
different. E-mail addresses, which are no numbers, get a keyed name.

Kinds: payment cards (Luhn), IBANs (mod 97), social security numbers, phone numbers
in the North American form with any digits, IPv4 addresses, dates in ISO and in day or month first
form, and e-mail addresses. What has the shape but fails the check is tried again in
its shorter forms, as the other kinds, and from each later start within it; what fails
all of that stays. The leftmost valid match wins, then the order of the kinds.

A number is split as (a, b) over radices A and B, and each round adds a keyed
hash of one half to the other modulo its radix. That is a permutation of all
A * B values for any A and B.

Defined results: a null text stays null; a text without personal data is
unchanged; a text of any length is searched whole, in time linear in it; repeated rows get the same result; an empty table stays empty. Other
columns pass through, and ``n_chars`` is brought up to date where it exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import let

ROUNDS = 8
# The session's own key, without which anyone who has this code can undo the pseudonyms:
# the default is for tests and trials.
KEY_SETTING = "spark.paystrata.pii.key"
DEFAULT_KEY = "paystrata"

# One pattern per kind, tried in this order where several fit.
# An address takes its whole run of characters before the at sign; from a start within a run it
# takes at most 64, or a long run would be searched again from every start. Its domain has at
# most 127 labels of at most 63.
LOCAL = "[A-Za-z0-9._%+-]"
RUN_START = f"(?<!{LOCAL})"
DOMAIN = r"@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,63}"
EMAIL = f"(?:{RUN_START}{LOCAL}++|{LOCAL}{{1,64}}+){DOMAIN}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD_FORMS = (
    r"[0-9]{4}(?:[\x20-]?[0-9]{4}){3}[\x20-]?[0-9]{1,3}",
    r"[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,4}",
    r"[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5}",
)
CARDS = tuple(rf"(?<![0-9])(?<![0-9]\.){form}(?![0-9])" for form in CARD_FORMS)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (
    r"(?<![0-9])(?:\+?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])"
    r"[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
)
IPV4 = r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
SLASH_DATE = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])"
DOT_DATE = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])"
# An address may start where its run of characters does, or after another match.
EMAIL_START = (
    rf"(?:{RUN_START}{LOCAL}++|(?:(?<=[A-Za-z])(?![A-Za-z])|(?<=[0-9])(?![0-9])){LOCAL}{{1,64}}+)"
    + DOMAIN
)
ANY = "|".join(
    (EMAIL_START, IBAN, *CARDS, SSN, PHONE, IPV4, ISO_DATE, SLASH_DATE, DOT_DATE)
)
# Characters seen before a start and from it on; only an address is longer.
BEFORE, AHEAD, LONGEST = 2, 64, 64 + 1 + 255
CHUNK = 256  # pieces of a text that are put together at a time
# Days are counted from here. Per era, its first day and two radices whose
# product is its days: from 0001-01-01, from 1900-01-01, and 2101-01-27 to 9999-12-31.
FIRST_DAY = "1900-01-01"
ERAS = ((-693595, 745, 931), (0, 271, 271), (73441, 937, 3079))
# The length of an IBAN by country, as registered.
IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (
        pair.split(":") for pair in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
            "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
            "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR "
            "27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA "
            "30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}


def keyed(key: str, *parts: Column) -> Column:
    """A keyed hash as a number from 0 to 2^60 - 1."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def power_of_ten(exponent: Column) -> Column:
    """10 to a small power, exactly."""
    return F.rpad(F.lit("1"), exponent + 1, F.lit("0")).cast("long")


def feistel(value: Column, a: int | Column, b: int | Column, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. a*b - 1; ``kind`` keeps formats apart."""
    def as_column(radix: int | Column) -> Column:
        return radix if isinstance(radix, Column) else F.lit(radix).cast("long")

    def turn(s: Column, number: int) -> Column:
        left, right = s["l"], s["r"]
        if number % 2 == 0:
            left = (left + keyed(key, F.lit(f"{kind}{number}"), s["a"], right) % s["a"]) % s["a"]
        else:
            right = (right + keyed(key, F.lit(f"{kind}{number}"), s["b"], left) % s["b"]) % s["b"]
        return F.struct(left.alias("l"), right.alias("r"), s["a"].alias("a"), s["b"].alias("b"))

    def rounds(state: Column, number: int) -> Column:
        if number == ROUNDS:
            return state["l"] * state["b"] + state["r"]
        return let(turn(state, number), lambda s: rounds(s, number + 1))

    start = F.struct(value.alias("v"), as_column(a).alias("a"), as_column(b).alias("b"))
    return let(
        start,
        lambda s: let(
            F.struct(
                F.call_function("div", s["v"], s["b"]).alias("l"), (s["v"] % s["b"]).alias("r"),
                s["a"].alias("a"), s["b"].alias("b"),
            ),
            lambda t: rounds(t, 0),
        ),
    )


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Up to 18 digits permuted among the numbers of their width."""
    width = F.length(digits)
    low = F.call_function("div", width, F.lit(2)).cast("int")
    value = feistel(number_of(digits), power_of_ten(low), power_of_ten(width - low), key, kind)
    return padded(value, width)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def number_of(text: Column) -> Column:
    """The digits as a number, 0 where there are none."""
    return F.coalesce(text.try_cast("long"), F.lit(0).cast("long"))


def padded(number: Column, width: int | Column) -> Column:
    return F.lpad(number.cast("string"), F.lit(width) if isinstance(width, int) else width, F.lit("0"))


def refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order by ``digits``."""
    empty = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        number = c.between("0", "9")
        return F.struct(
            F.concat(
                acc["s"], F.when(number, F.substring(digits, acc["k"] + 1, F.lit(1))).otherwise(c)
            ).alias("s"),
            (acc["k"] + number.cast("int")).alias("k"),
        )

    return F.aggregate(F.split(form, ""), empty, step, lambda acc: acc["s"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a number whose last digit is the check digit."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: let(
            F.coalesce(c.try_cast("int"), F.lit(0)) * (1 + i % 2),
            lambda d: F.when(d > 9, d - 9).otherwise(d),
        ),
    )
    return F.aggregate(places, F.lit(0), lambda acc, d: acc + d)


def mod97(text: Column) -> Column:
    """An IBAN's remainder: country and check digits moved last, letters as 10 to 35."""
    compact = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.when(digit, (acc * 10 + F.ascii(c) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97
        )

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def valid_card(found: Column) -> Column:
    return let(
        digits_of(found),
        lambda digits: F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0),
    )


def valid_iban(found: Column) -> Column:
    """The country's length, 15 to 34 where none is registered, and the remainder."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    length = F.length(F.replace(found, F.lit(" "), F.lit("")))
    registered = F.try_element_at(lengths, F.substring(found, 1, 2))
    fits = F.coalesce(length == registered, length.between(15, 34))
    return F.when(fits, mod97(found) == 1).otherwise(False)


def leading_words(found: Column) -> Column:
    """A candidate, then without its last word, and so on."""
    return let(
        F.split(found, r"\x20"),
        lambda parts: F.transform(
            F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
            lambda n: F.array_join(F.slice(parts, 1, n), " "),
        ),
    )


def card(found: Column, key: str) -> Column:
    """First digit kept, the rest permuted, the check digit computed anew."""
    def new(digits: Column) -> Column:
        payload = permuted_digits(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card")
        full = let(
            F.concat(F.substring(digits, 1, 1), payload),
            lambda t: F.concat(
                t, ((10 - luhn_sum(F.concat(t, F.lit("0"))) % 10) % 10).cast("string")
            ),
        )
        return refill(found, full)

    return let(digits_of(found), new)


def iban(found: Column, key: str) -> Column:
    """The last digits, 18 at most, permuted; the check digits computed anew."""
    def new(tail: Column) -> Column:
        def body(digits: Column) -> Column:
            kept = F.greatest(F.length(digits) - 18, F.lit(0))
            fresh = permuted_digits(F.substr(digits, kept + 1), key, "iban")
            return F.when(
                F.length(digits) > 0,
                refill(tail, F.concat(F.substr(digits, F.lit(1), kept), fresh)),
            ).otherwise(tail)

        def checked(t: Column) -> Column:
            country = F.substring(found, 1, 2)
            check = 98 - mod97(F.concat(country, F.lit("00"), t))
            return F.concat(country, padded(check, 2), t)

        return let(let(digits_of(tail), body), checked)

    return let(F.substr(found, F.lit(5)), new)


def ssn(found: Column, key: str) -> Column:
    """Permuted over the 898 issued areas, 99 groups and 9999 serials."""
    def new(digits: Column) -> Column:
        area = number_of(F.substring(digits, 1, 3))
        group, serial = number_of(F.substring(digits, 4, 2)), number_of(F.substring(digits, 6, 4))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        index = F.when(area > 666, area - 2).otherwise(area - 1)
        value = (index * 99 + group - 1) * 9999 + serial - 1

        def written(v: Column) -> Column:
            high = F.floor(v / 9999).cast("long")
            place = F.floor(high / 99).cast("long")
            area_out = F.when(place >= 665, place + 2).otherwise(place + 1)
            return F.concat_ws(
                "-", padded(area_out, 3), padded(high % 99 + 1, 2), padded(v % 9999 + 1, 4)
            )

        return F.when(valid, let(feistel(value, 898 * 99, 9999, key, "ssn"), written))

    return let(digits_of(found), new)


def phone(found: Column, key: str) -> Column:
    """The ten national digits permuted; area and exchange each begin with 0 or 1, or with
    2 to 9, as they did."""
    def new(digits: Column) -> Column:
        national = F.substring(digits, -10, 10)
        area = number_of(F.substring(national, 1, 3))
        exchange = number_of(F.substring(national, 4, 3))
        line = number_of(F.substring(national, 7, 4))

        def least(part: Column) -> Column:
            return F.when(part < 200, 0).otherwise(200).cast("long")

        def size(part: Column) -> Column:
            return F.when(part < 200, 200).otherwise(800).cast("long")

        value = ((area - least(area)) * size(exchange) + exchange - least(exchange)) * 10000 + line

        def written(v: Column) -> Column:
            high = F.call_function("div", v, F.lit(10000))
            fresh = F.concat(
                padded(F.call_function("div", high, size(exchange)) + least(area), 3),
                padded(high % size(exchange) + least(exchange), 3), padded(v % 10000, 4),
            )
            return refill(found, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), fresh))

        return let(feistel(value, size(area) * 100, size(exchange) * 100, key, "phone"), written)

    return let(digits_of(found), new)


def ipv4(found: Column, key: str) -> Column:
    """The address permuted as a number of 32 bits."""
    def new(parts: Column) -> Column:
        octet = [number_of(F.get(parts, i)) for i in range(4)]
        valid = octet[0].between(0, 255)
        for part in octet[1:]:
            valid = valid & part.between(0, 255)
        value = ((octet[0] * 256 + octet[1]) * 256 + octet[2]) * 256 + octet[3]

        def written(v: Column) -> Column:
            shown = [(F.shiftright(v, 8 * i) % 256).cast("string") for i in (3, 2, 1, 0)]
            return F.concat_ws(".", *shown)

        return F.when(valid, let(feistel(value, 65536, 65536, key, "ipv4"), written))

    return let(F.split(found, r"\."), new)


def date(found: Column, key: str, forms: tuple[str, ...]) -> Column:
    """The day permuted among the days of its era, in the first form that reads it."""
    first_day = F.lit(FIRST_DAY).cast("date")

    def written(form: str) -> Column:
        def new(offset: Column) -> Column:
            def era(place: int) -> Column:
                value = F.lit(None)
                for values in ERAS:
                    value = F.when(offset >= values[0], values[place]).otherwise(value)
                return value.cast("long")

            def shown(e: Column) -> Column:
                fresh = feistel(offset - e["f"], e["a"], e["b"], key, "date") + e["f"]
                return F.date_format(F.date_add(first_day, fresh.cast("int")), form)

            parts = F.struct(era(0).alias("f"), era(1).alias("a"), era(2).alias("b"))
            return F.when(offset >= ERAS[0][0], let(parts, shown))

        day = F.try_to_timestamp(found, F.lit(form)).cast("date")
        return let(F.datediff(day, first_day).cast("long"), new)

    return F.coalesce(*[written(form) for form in forms])


def email(found: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(found)), 256), 1, 20)
    return F.concat(F.lit("u"), name, F.lit("@example.invalid"))


def pseudonym(window: Column, key: str) -> Column:
    """``found`` and ``fresh`` of the match that starts ``BEFORE`` characters into
    ``window``, null where none is valid."""
    def taken(pattern: str) -> Column:
        return F.regexp_extract(window, f"(?s)^.{{{BEFORE}}}({pattern})", 1)

    def kind(found: Column, new: Callable[[Column], Column]) -> Column:
        def both(f: Column) -> Column:
            return let(
                F.when(f != "", new(f)),
                lambda fresh: F.when(
                    fresh.isNotNull(), F.struct(f.alias("found"), fresh.alias("fresh"))
                ),
            )

        return let(found, both)

    ibans = F.filter(leading_words(taken(IBAN)), valid_iban)
    cards = F.filter(F.array(*[taken(form) for form in CARDS]), valid_card)
    return F.coalesce(
        kind(taken(EMAIL), lambda f: email(f, key)),
        kind(F.get(ibans, 0), lambda f: iban(f, key)),
        kind(F.get(cards, 0), lambda f: card(f, key)),
        kind(taken(SSN), lambda f: ssn(f, key)),
        kind(taken(PHONE), lambda f: phone(f, key)),
        kind(taken(IPV4), lambda f: ipv4(f, key)),
        kind(taken(ISO_DATE), lambda f: date(f, key, ("yyyy-MM-dd",))),
        kind(taken(SLASH_DATE), lambda f: date(f, key, ("MM/dd/yyyy", "dd/MM/yyyy"))),
        kind(taken(DOT_DATE), lambda f: date(f, key, ("dd.MM.yyyy",))),
    )


def pseudonymised(text: Column, key: str = DEFAULT_KEY) -> Column:
    """A struct of ``text`` after replacement and ``n``, the matches that changed.

    The text is split where a match may start, also within another candidate. From left
    to right, a start that a match before it covers is passed over. Some hundred pieces at
    a time see the text around them and give one new piece, so the work grows with the
    text and not with its square.
    """
    def state(out: Column, at: Column, skip: Column, n: Column) -> Column:
        return F.struct(out.alias("text"), at.alias("at"), skip.alias("skip"), n.alias("n"))

    def window(near: Column, at: Column) -> Column:
        """What is seen from a start: ``near`` begins ``BEFORE`` characters before place 0."""
        def seen(ahead: Column) -> Column:
            return F.substr(near, at + 1, F.lit(BEFORE) + ahead)

        run = rf"[A-Za-z0-9._%+@-]{{{AHEAD - BEFORE},}}$"
        return let(
            seen(F.lit(AHEAD)),
            lambda short: F.when(~short.rlike(f"(?s)^.{{{BEFORE}}}{run}"), short)
            .when(short.rlike(f"(?s)^.{{{BEFORE}}}{RUN_START}{run}"), seen(F.length(near)))
            .otherwise(seen(F.lit(LONGEST))),
        )

    def step(acc: Column, piece: Column, near: Column) -> Column:
        size = F.length(piece)
        end = acc["at"] + size

        def after(covered: Column, fresh: Column, n: Column) -> Column:
            rest = F.substr(piece, covered + 1)
            left = F.greatest(covered - size, F.lit(0))
            return state(F.concat(acc["text"], fresh, rest), end, left, acc["n"] + n)

        def matched(m: Column) -> Column:
            changed = (m["found"] != m["fresh"]).cast("int")
            return F.when(m.isNull(), after(F.lit(0), F.lit(""), F.lit(0))).otherwise(
                after(F.length(m["found"]), m["fresh"], changed)
            )

        return F.when(acc["skip"] > 0, after(acc["skip"], F.lit(""), F.lit(0))).otherwise(
            let(let(window(near, acc["at"]), lambda w: pseudonym(w, key)), matched)
        )

    def chunk(acc: Column, first: Column, pieces: Column) -> Column:
        """The pieces from ``first`` on, seen with the text before them and far enough ahead."""
        begin = F.greatest(first - BEFORE, F.lit(1))
        before = F.array_join(F.slice(pieces, begin, first - begin), "")
        own = F.slice(pieces, first, F.lit(CHUNK))
        near = F.concat(
            F.lpad(F.right(before, F.lit(BEFORE)), F.lit(BEFORE), F.lit(" ")),
            F.array_join(F.slice(pieces, first, F.lit(CHUNK + LONGEST)), ""),
        )
        start = state(F.lit(""), F.lit(0), acc["skip"], acc["n"])
        return let(near, lambda seen: let(
            F.aggregate(own, start, lambda s, piece: step(s, piece, seen)),
            lambda s: state(F.concat(acc["text"], s["text"]), F.lit(0), s["skip"], s["n"]),
        ))

    def all_of(pieces: Column) -> Column:
        empty = state(F.lit(""), F.lit(0), F.lit(0), F.lit(0))
        return F.aggregate(
            F.sequence(F.lit(1), F.size(pieces), F.lit(CHUNK)), empty,
            lambda acc, first: chunk(acc, first, pieces),
            lambda acc: F.struct(acc["text"].alias("text"), acc["n"].alias("n")),
        )

    return F.when(
        text.isNotNull(), let(F.split(text, f"(?={ANY})", -1), all_of)
    ).otherwise(F.struct(text.alias("text"), F.lit(0).alias("n")))


def session_key(documents: DataFrame) -> str:
    return documents.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY)


def pseudonymise(documents: DataFrame, key: str | None = None) -> DataFrame:
    """``documents`` with their texts pseudonymised under ``key``, or the session's key."""
    text = pseudonymised(F.col("text"), key or session_key(documents))["text"]
    result = documents.withColumn("text", text)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.length("text").cast(kind))
    return result


def digest(documents: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, the text after replacement, and the number of replacements."""
    text = pseudonymised(F.col("text"), key or session_key(documents))
    done = documents.select("doc_id", text.alias("_p"))
    return done.select(
        "doc_id", F.col("_p.text").alias("text"),
        F.coalesce("_p.n", F.lit(0)).cast("long").alias("n_replaced"),
    )
