"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

Numbers, dates, addresses and keys are found by shape, validated (check digits, ranges, calendar), and replaced by a value
of the same format that is valid too. The replacement is a keyed permutation: a Feistel network whose halves are moved
by a keyed digest of each other. Equal values therefore get equal pseudonyms in every document and spelling, different
ones get different ones, and without the key nothing leads back.

* :func:`permute_text` moves every digit within the digits and every letter within the letters of its case.
* :func:`permute_pair` moves a pair of numbers within any two ranges; it serves values whose format is not "any digits":
  subscriber numbers, social security numbers, addresses of machines, days of the calendar.

What looks alike but does not validate (a long number without a right check digit, a 31 February) stays as it is, and so
does all other text. The texts are never shuffled and no row depends on another one.

Card numbers are looked for inside whole runs of digit groups, whatever digits stand next to them: every stretch of 13 to 19
digits between two separators with a right check digit counts if it is the whole run, has the first digits of a card network,
or is grouped as cards are printed (else most tables of small numbers would have some). Of stretches that overlap those that
cover the most digits are taken, the usual ones first. An account number ends where its country's do.

Defined cases: a null text stays null, an empty one empty; columns besides ``text`` are returned as they are; rows that
repeat get the same pseudonyms. Of very short values a few are their own pseudonym, as in any permutation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.rows import free_name

ROUNDS = 8

#: Characters of an account number by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|CV|GW|LY|MZ|PT|ST", 26: "DZ|IR|IS|TR", 27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE",
    31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban_shape() -> str:
    """The country's length where that fits, any other one else."""
    fixed = (
        rf"(?:{names})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, names in IBAN_LENGTHS.items()
    )
    other = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    return rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(fixed)}|{other})(?![\p{{L}}\p{{N}}])"


#: Values that begin with a digit: a run of digit groups ends before them.
_OTHERS = (
    r"[\p{L}\p{N}._%+-]{1,64}@|\d{3}-\d{2}-\d{4}(?![\p{N}-])|\d{4}-\d{2}-\d{2}(?![\p{N}-])"
    r"|\d{2}(?:\.\d{2}\.|/\d{2}/)\d{4}(?!\p{N})|(?:\d{1,3}\.){3}\d{1,3}(?!\p{N}|\.\p{N})"
)
#: The shapes that are looked at, in the order in which they are tried.
SHAPES = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"(?i:token|secret|key|password|passwd)[^\p{L}\p{N}]{0,6}[=:][^\p{L}\p{N}]{0,6}(?:[0-9a-f]{16,64}|[0-9A-F]{16,64})(?![0-9A-Za-z])",
    "phone": r"(?<![\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\p{N})",
    "iban": _iban_shape(),
    "ssn": r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    "iso_date": r"(?<![\p{N}-])\d{4}-\d{2}-\d{2}(?![\p{N}-])",
    "day_date": r"(?<![\p{N}./])\d{2}([./])\d{2}\1\d{4}(?!\p{N})",
    "ip": r"(?<![\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?!\p{N}|\.\p{N})",
    "card": rf"(?<!\p{{N}})(?=\d(?:[ -]?\d){{12}})\d++(?!\p{{N}})(?:(?:-| (?!{_OTHERS}))\d++(?!\p{{N}}))*+",
}
#: Java counts groups over the whole pattern; the date's own group is the only one.
ANY = "|".join(f"(?:{shape})" for shape in SHAPES.values())

#: Lengths of card numbers, and the usual ones: networks by their first digits, groups as they are printed.
CARD_DIGITS = (13, 19)
USUAL_CARD = (
    r"^(?:4\d{12}(?:\d{3})?(?:\d{3})?|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3[0689]\d{12,17}|35\d{14,17}|6\d{15,18}|5[06-9]\d{14,17})$"
)
USUAL_GROUPS = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1(?:\d{4}(?:\1\d{1,3})?|\d{1,7})|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{6}[ -]\d{7,13})$"

#: 400 Gregorian years are 146097 = 27 * 5411 days; the calendar repeats after them.
CALENDAR_START, CALENDAR = "1800-01-01", (27, 5411)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often the expression mentions it."""
    return F.transform(F.array(value), use)[0]


def digest(key: Column, kind: str, turn: Column, text: Column) -> Column:
    """128 hexadecimal digits that depend on everything given."""
    seed = F.concat_ws("|", key, F.lit(kind), turn.cast("string"), text)
    return F.concat(F.sha2(F.concat(F.lit("0|"), seed, F.lit("|"), key), 256), F.sha2(F.concat(F.lit("1|"), seed, F.lit("|"), key), 256))


def number_at(hexes: Column, place: Column, digits: int = 4) -> Column:
    return F.conv(F.substring(hexes, place, F.lit(digits)), 16, 10).cast("long")


def moved(char: Column, by: Column, hexadecimal: bool) -> Column:
    """``char`` moved within its class."""
    code = F.ascii(char)

    def within(first: str, n: int) -> Column:
        return F.char((code - ord(first) + by) % n + ord(first))

    if hexadecimal:
        return F.lower(F.hex((F.conv(char, 16, 10).cast("long") + by) % 16))
    return (
        F.when(char.between("0", "9"), within("0", 10)).when(char.between("a", "z"), within("a", 26))
        .when(char.between("A", "Z"), within("A", 26)).otherwise(char)
    )


def permute_text(key: Column, kind: str, text: Column, hexadecimal: bool = False) -> Column:
    """A keyed permutation of the texts with the same classes of characters; halves of at most 32 characters."""

    def shifted(half: Column, hexes: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda j: j < F.length(half))
        return F.array_join(let(hexes, lambda h: F.transform(
            places, lambda j: moved(F.substring(half, j + 1, F.lit(1)), number_at(h, j * 4 + 1), hexadecimal)
        )), "")

    def turn(state: Column, i: Column) -> Column:
        left, right = state["left"], state["right"]
        return F.when(
            i % 2 == 1, F.struct(shifted(left, digest(key, kind, i, right)).alias("left"), right.alias("right"))
        ).otherwise(F.struct(left.alias("left"), shifted(right, digest(key, kind, i, left)).alias("right")))

    def network(t: Column) -> Column:
        middle = F.floor(F.length(t) / 2).cast("int")
        start = F.struct(F.substring(t, F.lit(1), middle).alias("left"), F.substring(t, middle + 1, F.length(t)).alias("right"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["left"], s["right"]))

    return let(text, network)


def permute_pair(
    key: Column, kind: str, left: Column, right: Column, sizes: tuple[int | Column, int | Column],
) -> Column:
    """A keyed permutation of the pairs in ``range(sizes[0]) x range(sizes[1])`` as a struct of ``left`` and ``right``."""

    def step(value: Column, other: Column, i: Column, size: int | Column) -> Column:
        return ((value + number_at(digest(key, kind, i, other.cast("string")), F.lit(1), 12) % size) % size).cast("long")

    def turn(state: Column, i: Column) -> Column:
        left, right = state["left"], state["right"]
        return F.when(i % 2 == 1, F.struct(step(left, right, i, sizes[0]).alias("left"), right.alias("right"))).otherwise(
            F.struct(left.alias("left"), step(right, left, i, sizes[1]).alias("right"))
        )

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def part(text: Column, first: int | Column, n: int) -> Column:
    return F.substring(text, F.lit(first) if isinstance(first, int) else first, F.lit(n)).cast("long")


def padded(number: Column, n: int) -> Column:
    return F.lpad(number.cast("string"), n, "0")


def refilled(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in turn; the number of digits is the same."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def fill(new: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            char = F.substring(text, i, F.lit(1))
            return F.when(
                char.between("0", "9"),
                F.struct(F.concat(s["out"], F.substring(new, s["next"], F.lit(1))).alias("out"), (s["next"] + 1).alias("next")),
            ).otherwise(F.struct(F.concat(s["out"], char).alias("out"), s["next"].alias("next")))

        return F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step, lambda s: s["out"])

    return let(digits, fill)


def luhn_sum(digits: Column) -> Column:
    """Sum with every second digit from the right doubled, starting left of the last one."""

    def weighed(d: Column, i: Column) -> Column:
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    def total(text: Column) -> Column:
        weights = F.transform(
            F.sequence(F.lit(0), F.length(text) - 1), lambda i: weighed(F.substring(text, -i - 1, F.lit(1)).cast("int"), i)
        )
        return F.aggregate(weights, F.lit(0), lambda a, b: a + b)

    return let(digits, total)


def mod97(text: Column) -> Column:
    """The remainder of an account number with letters as 10 to 35."""

    def rest(whole: Column) -> Column:
        def step(rest: Column, i: Column) -> Column:
            value = F.conv(F.substring(whole, i, F.lit(1)), 36, 10).cast("int")
            return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(whole)), F.lit(0), step)

    return let(text, rest)


def card(key: Column, hit: Column) -> Column:
    """First digit and length stay; the last digit is the right check digit again."""

    def changed(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), permute_text(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
        return let(body, lambda x: F.concat(x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))

    return let(digits_of(hit), lambda d: F.when(luhn_sum(d) % 10 == 0, refilled(hit, changed(d))))


def best_cards(groups: Column) -> Column:
    """The card numbers among digit groups with their separators behind them: ``at, n, text`` from left to right.

    From the last group to the first, the best choice from each group on is kept for the ``CARD_DIGITS[1]`` groups behind it.
    """
    choice = "struct<score:bigint,cards:array<struct<at:int,n:int,text:string>>>"
    least, most = CARD_DIGITS

    def numbers(i: Column) -> Column:
        here = F.slice(groups, i, F.least(F.lit(most), F.size(groups) - i + 1))
        fits = F.filter(
            F.transform(here, lambda _, k: F.struct(
                i.alias("at"), (k + 1).alias("n"),
                F.regexp_replace(F.array_join(F.slice(here, F.lit(1), k + 1), ""), "[ -]$", "").alias("text"),
            )),
            lambda c: F.length(digits_of(c["text"])).between(least, most),
        )
        meant = F.filter(fits, lambda c: (c["n"] == F.size(groups)) | (usual(c) > 0))
        return F.filter(meant, lambda c: luhn_sum(digits_of(c["text"])) % 10 == 0)

    def usual(c: Column) -> Column:
        return digits_of(c["text"]).rlike(USUAL_CARD).cast("long") + c["text"].rlike(USUAL_GROUPS).cast("long")

    def score(c: Column) -> Column:
        return F.length(digits_of(c["text"])).cast("long") + usual(c) * most

    def step(state: Column, i: Column) -> Column:
        options = F.transform(numbers(i), lambda c: F.struct(
            (score(c) + F.coalesce(F.get(state, c["n"] - 1)["score"], F.lit(0))).alias("score"), c.alias("card"),
        ))

        def chosen(best: Column) -> Column:
            behind = F.coalesce(F.get(state, best["card"]["n"] - 1)["cards"], F.array().cast("array<struct<at:int,n:int,text:string>>"))
            new = F.struct(best["score"].alias("score"), F.concat(F.array(best["card"]), behind).alias("cards")).cast(choice)
            return F.when(best["score"] > state[0]["score"], new).otherwise(state[0])

        best = let(F.array_max(options), lambda b: F.when(b.isNull(), state[0]).otherwise(chosen(b)))
        return F.slice(F.concat(F.array(best), state), 1, most)

    start = F.array(F.struct(F.lit(0).alias("score"), F.array().alias("cards")).cast(choice))
    places = F.sequence(F.size(groups), F.lit(1), F.lit(-1))
    return F.aggregate(places, start, step, lambda s: s[0]["cards"])


def cards(key: Column, hit: Column) -> Column:
    """The card numbers in a run of digit groups: ``kinds``, one for each number, and ``new``, the whole run."""

    def rebuilt(groups: Column) -> Column:
        def joined(first: Column, end: Column) -> Column:
            return F.array_join(F.slice(groups, first, end - first), "")

        def written(found: Column) -> Column:
            parts = F.transform(found, lambda c, j: F.concat(
                joined(F.coalesce(F.get(found, j - 1)["at"] + F.get(found, j - 1)["n"], F.lit(1)), c["at"]),
                card(key, c["text"]),
                F.regexp_extract(F.element_at(groups, c["at"] + c["n"] - 1), "[ -]?$", 0),
            ))
            last = F.element_at(found, -1)
            new = F.concat(F.array_join(parts, ""), joined(last["at"] + last["n"], F.size(groups) + 1))
            return F.when(F.size(found) > 0, F.struct(F.transform(found, lambda _: F.lit("card")).alias("kinds"), new.alias("new")))

        return let(best_cards(groups), written)

    return let(F.regexp_extract_all(hit, F.lit(r"\d+[ -]?"), F.lit(0)), rebuilt)


def phone(key: Column, hit: Column) -> Column:
    """The country code stays; a North American number stays one (no area or exchange below 200)."""

    def changed(d: Column) -> Column:
        area, exchange, line = part(d, 2, 3), part(d, 5, 3), part(d, 8, 4)
        pair = permute_pair(
            key, "phone", (area - 200) * 100 + F.floor(line / 100), (exchange - 200) * 100 + line % 100, (80_000, 80_000)
        )
        american = let(pair, lambda p: F.concat(
            F.lit("1"), padded(F.floor(p["left"] / 100) + 200, 3), padded(F.floor(p["right"] / 100) + 200, 3),
            padded(p["left"] % 100, 2), padded(p["right"] % 100, 2),
        ))
        code = F.least(F.length(F.regexp_extract(hit, r"^\+(\d{1,3})", 1)), F.lit(2))
        other = F.concat(F.substring(d, F.lit(1), code), permute_text(key, "phone", F.substring(d, code + 1, F.length(d))))
        ours = (F.length(d) == 11) & d.startswith("1") & (area >= 200) & (exchange >= 200)
        return F.when(F.length(d) <= 15, refilled(hit, F.when(ours, american).otherwise(other)))

    return let(digits_of(hit), changed)


def ssn(key: Column, hit: Column) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    d = digits_of(hit)
    area, group, serial = part(d, 1, 3), part(d, 4, 2), part(d, 6, 4)
    index = area - F.when(area > 666, 2).otherwise(1)
    pair = permute_pair(key, "ssn", index * 99 + group - 1, serial - 1, (898 * 99, 9999))

    def written(p: Column) -> Column:
        new = F.floor(p["left"] / 99) + 1
        return F.concat(padded(new + F.when(new > 665, 1).otherwise(0), 3), padded(p["left"] % 99 + 1, 2), padded(p["right"] + 1, 4))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, refilled(hit, let(pair, written)))


def ip(key: Column, hit: Column) -> Column:
    """Each octet keeps its number of digits; one with a zero in front is no address."""
    texts = F.split(hit, r"\.")
    text = [F.get(texts, k) for k in range(4)]
    octets = [t.cast("long") for t in text]
    low = [F.element_at(F.array(F.lit(0), F.lit(10), F.lit(100)), F.length(t)) for t in text]
    size = [F.element_at(F.array(F.lit(10), F.lit(90), F.lit(156)), F.length(t)).cast("long") for t in text]
    left, right = ((octets[k] - low[k]) * size[k + 1] + octets[k + 1] - low[k + 1] for k in (0, 2))
    pair = permute_pair(key, "ip", left, right, (size[0] * size[1], size[2] * size[3]))
    new = let(pair, lambda p: F.concat_ws(".", *(
        x.cast("string") for k, side in ((0, "left"), (2, "right"))
        for x in (F.floor(p[side] / size[k + 1]) + low[k], p[side] % size[k + 1] + low[k + 1])
    )))
    valid = hit.rlike(r"^(0|[1-9]\d{0,2})(\.(0|[1-9]\d{0,2})){3}$") & (F.greatest(*octets) < 256)
    return F.when(valid, new)


def moved_day(key: Column, day: Column) -> Column:
    """A day of the 400 years from ``CALENDAR_START``; null for others."""
    start = F.lit(CALENDAR_START).cast("date")
    n = F.datediff(day, start)
    pair = permute_pair(key, "date", F.floor(n / CALENDAR[1]), n % CALENDAR[1], CALENDAR)
    new = let(pair, lambda p: F.date_add(start, (p["left"] * CALENDAR[1] + p["right"]).cast("int")))
    return F.when(n.between(0, CALENDAR[0] * CALENDAR[1] - 1), new)


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """The day, or null where the calendar has none."""
    return F.call_function("try_to_date", F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd"))


def iso_date(key: Column, hit: Column) -> Column:
    day = calendar_day(F.substring(hit, 1, 4), F.substring(hit, 6, 2), F.substring(hit, 9, 2))
    return F.date_format(moved_day(key, day), "yyyy-MM-dd")


def day_date(key: Column, hit: Column) -> Column:
    """Day first where that is a day of the calendar, else month first."""
    first, second, year, sep = F.substring(hit, 1, 2), F.substring(hit, 4, 2), F.substring(hit, 7, 4), F.substring(hit, 3, 1)
    european, american = calendar_day(year, second, first), calendar_day(year, first, second)

    def written(new: Column) -> Column:
        d, m, y = (F.date_format(new, x) for x in ("dd", "MM", "yyyy"))
        return F.when(european.isNotNull(), F.concat(d, sep, m, sep, y)).when(american.isNotNull(), F.concat(m, sep, d, sep, y))

    return let(moved_day(key, F.coalesce(european, american)), written)


def iban(key: Column, hit: Column) -> Column:
    """The country and the places of letters stay; the check digits are right again."""

    def spaced(whole: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))
        return F.aggregate(F.sequence(F.lit(1), F.length(hit)), start, lambda s, i: F.when(
            F.substring(hit, i, F.lit(1)) == " ", F.struct(F.concat(s["out"], F.lit(" ")).alias("out"), s["next"].alias("next"))
        ).otherwise(
            F.struct(F.concat(s["out"], F.substring(whole, s["next"], F.lit(1))).alias("out"), (s["next"] + 1).alias("next"))
        ), lambda s: s["out"])

    def changed(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
        valid = F.length(plain).between(15, 34) & (mod97(F.concat(account, F.substring(plain, 1, 4))) == 1)
        whole = let(permute_text(key, "iban", account), lambda new: F.concat(
            country, padded(98 - mod97(F.concat(new, country, F.lit("00"))), 2), new
        ))
        return F.when(valid, let(whole, spaced))

    return let(F.regexp_replace(hit, " ", ""), changed)


def email(key: Column, hit: Column) -> Column:
    """The domain stays."""
    at = F.instr(hit, "@")
    return F.concat(
        permute_text(key, "email", F.substring(hit, F.lit(1), at - 1)), F.substring(hit, at, F.length(hit))
    )


def secret(key: Column, hit: Column) -> Column:
    """The name in front stays; the hexadecimal digits stay in their case."""

    def changed(value: Column) -> Column:
        new = permute_text(key, "secret", F.lower(value), hexadecimal=True)
        front = F.substring(hit, F.lit(1), F.length(hit) - F.length(value))
        return F.concat(front, let(new, lambda x: F.when(value.rlike("[A-F]"), F.upper(x)).otherwise(x)))

    return let(F.regexp_extract(hit, r"[0-9A-Fa-f]{16,}$", 0), changed)


_KINDS = {
    "secret": (lambda h: h.rlike("[=:]"), secret),
    "email": (lambda h: h.contains("@"), email),
    "phone": (lambda h: h.startswith("+"), phone),
    "ssn": (lambda h: h.rlike(r"^\d{3}-\d{2}-\d{4}$"), ssn),
    "iso_date": (lambda h: h.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso_date),
    "day_date": (lambda h: h.rlike(r"^\d{2}[./]\d{2}[./]\d{4}$"), day_date),
    "ip": (lambda h: h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), ip),
    "iban": (lambda h: h.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]*$"), iban),
}


def replaced(key: Column, hit: Column) -> Column:
    """A struct of the kinds of the values in ``hit`` and its pseudonym, which is null if it is not a valid value."""
    names = {"iso_date": "date", "day_date": "date"}
    out = None
    for kind, (test, function) in _KINDS.items():
        value = F.struct(F.array(F.lit(names.get(kind, kind))).alias("kinds"), function(key, hit).alias("new"))
        out = F.when(test(hit), value) if out is None else out.when(test(hit), value)
    # no other shape has thirteen digits parted by nothing else
    return out.when(hit.rlike(r"^\d"), cards(key, hit))


def pseudonymised(documents: DataFrame, key: str, text_col: str = "text", found: str | None = None) -> DataFrame:
    """``documents`` with pseudonyms in ``text_col``; ``found``, if given, is a column for the kinds that were replaced."""
    if found is not None and found.lower() in {c.lower() for c in documents.columns}:
        raise ValueError(f"documents has a column {found}; choose another name")
    # hits and their pseudonyms are columns for a moment, so that each is computed once
    hits, news = (free_name(name, found or "", *documents.columns) for name in ("hits", "news"))
    text = F.col(text_col)
    looked = documents.withColumn(hits, F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    changed = looked.withColumn(news, F.transform(hits, lambda h: replaced(F.lit(key), h)))
    rebuilt = F.array_join(
        F.transform(
            F.split(text, ANY, -1),
            lambda x, i: F.concat(x, F.coalesce(F.get(news, i)["new"], F.get(hits, i), F.lit(""))),
        ),
        "",
    )
    kinds = F.flatten(F.transform(F.filter(news, lambda x: x["new"].isNotNull()), lambda x: x["kinds"]))
    out = changed.withColumn(text_col, F.when(F.size(hits) > 0, rebuilt).otherwise(text))
    if found is not None:
        out = out.withColumn(found, F.coalesce(F.array_sort(kinds), F.array().cast("array<string>")))
    return out.drop(hits, news)


def report(documents: DataFrame, key: str) -> DataFrame:
    """Per document row its text with pseudonyms, how many values were replaced, and their kinds."""
    done = pseudonymised(documents.select("doc_id", F.col("text").cast("string").alias("text")), key, found="kinds")
    return done.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))
