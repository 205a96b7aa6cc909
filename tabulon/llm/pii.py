"""Personal data under format-preserving Feistel pseudonyms, in DataFrame functions only.

Numbers, dates, addresses and secrets are found by pattern and validated (check digits, octets, calendar dates).
A value is a list of digits with a modulus each: decimal digits and letters of its characters, the octets of
an IP address, the parts of a day number. A keyed Feistel network over the two halves of the list permutes all values of a
format, so the pseudonym has the same format and passes the same validation, different values stay
different, and equal values get equal pseudonyms in every document without any shared table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Area, exchange and line of three, three and four digits; with a country code the separators may be left out.
_AREA = r"\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"
#: A national number with its trunk 0: 9 to 11 digits in groups, the first group set off. No d-m-y date, no 3-2-4 number, no part of a longer list.
_TRUNK = (
    r"(?<![\d+])(?<!\d[ .,/-])(?!\d\d[ .-]\d\d[ .-]\d{4}(?!\d))(?!\d{3}-\d\d-\d{4}(?!\d))(?=\(?(?:\d\)?[ ./-]?){8,10}\d(?![ .-]?\d))"
    r"\(?0[1-9]\d{0,3}(?:\)[ -]?|[ -]|(?<=\d{3})/)(?:\d{5,8}|\d{2,8}(?:[ -]\d{2,8}){1,3})(?!\d)|(?<![\d+])(?<!\d[ .,/-])0[1-9](?:\.\d\d){4}(?!\.?\d)"
)
_EMAIL = r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)"
#: What a secret cannot hold, and the marks that end a sentence or a bracket and not a secret.
_BREAK = r"\s\u00a0\u2000-\u200a\u2028\u2029\u202f\u3000\"',;<>"
_CLOSE = r".:!?)\]}"
#: A name, a mark of assignment and eight characters or more of any kind up to a break; web, mail and IP addresses are none.
_SECRET = (
    r"(?<![A-Za-z0-9])(?i:password|passwd|passphrase|pwd|pw|token|secret|api[_-]?key|access[_-]?key)[\"']?\s?[=:]\s?[\"']?"
    rf"(?!(?i:https?|ftp)://|(?:{_EMAIL}|{_IP})[{_CLOSE}]*(?![^{_BREAK}]))[^{_BREAK}]{{7,}}[^{_BREAK}{_CLOSE}][\"']?"
)
#: Kinds in the order in which they are tried at a place of the text.
PATTERNS = {
    "email": _EMAIL,
    "secret": _SECRET,
    "access_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": _IP,
    "date": r"(?<![\d./-])(?:(?:1[89]|2[01])\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])\.(?:0[1-9]|1[0-2])\.(?:1[89]|2[01])\d\d|(?:(?:0[1-9]|1[0-2])/(?:0[1-9]|[12]\d|3[01])|(?:1[3-9]|2\d|3[01])/(?:0[1-9]|1[0-2]))/(?:1[89]|2[01])\d\d)(?![\d/-])",
    "social": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])",
    "phone": rf"(?<![\d+])\+\d{{1,3}}[ .-]?{_AREA}(?!\d)|(?<![\w+])\+(?!\d+\.\d+(?!\d|[ .()-]{{1,2}}\d))[1-9](?:[ .()-]{{0,2}}\d){{6,14}}(?!\d)"
    rf"|(?<![\d+])(?:\(\d{{3}}\)[ .-]?|\(?\d{{3}}\)?[ .-])\d{{3}}[ .-]\d{{4}}(?!\d)|{_TRUNK}",
    "card": r"(?<![\d+-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A place where one of the patterns can begin to match has one of these characters.
HINT = r"[0-9@=:]|A[KS]IA"

DAYS = 146097  # of the 400 years from 1800, = 27 * 5411
DATE_MODULI = (27, 5411)
FIRST_DAY = "1800-01-01"
#: Those of the days after the 12th of a month: 13/01 to 31/12 can only be day first. = 9 * 9833
LATE_DAYS = 88497
LATE_MODULI = (9, 9833)
#: Area (001 to 899 without 666), group (01 to 99) and serial (0001 to 9999) of a social security number.
SOCIAL_MODULI = (898, 99, 9999)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(digits: Column, moduli: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the lists with these moduli. Each round shifts one half by a keyed hash of the other."""

    def shifted(half: Column, sizes: Column, other: Column, i: Column, tweak: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), i.cast("string"), tweak, F.array_join(F.transform(other, lambda v: v.cast("string")), ",")).cast("binary"), 256)
        return _let(seed, lambda s: F.transform(half, lambda v, j: F.pmod(v + F.pmod(F.xxhash64(s, j), F.get(sizes, j)), F.get(sizes, j))))

    def run(state: Column) -> Column:
        tweak = F.array_join(F.transform(F.concat(state["ml"], state["mr"]), lambda m: m.cast("string")), ",")

        def step(s: Column, i: Column) -> Column:
            even = F.struct(shifted(s["l"], s["ml"], s["r"], i, tweak).alias("l"), s["r"].alias("r"), s["ml"].alias("ml"), s["mr"].alias("mr"))
            odd = F.struct(s["l"].alias("l"), shifted(s["r"], s["mr"], s["l"], i, tweak).alias("r"), s["ml"].alias("ml"), s["mr"].alias("mr"))
            return F.when(i % 2 == 0, even).otherwise(odd)

        return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), state, step, lambda s: F.concat(s["l"], s["r"]))

    half = F.floor(F.size(digits) / 2).cast("int")
    rest = F.size(digits) - half
    state = F.struct(
        F.slice(digits, F.lit(1), half).alias("l"), F.slice(digits, half + 1, rest).alias("r"),
        F.slice(moduli, F.lit(1), half).alias("ml"), F.slice(moduli, half + 1, rest).alias("mr"),
    )
    return _let(state, run)


def _check_digit_sum(digits: Column) -> Column:
    """Sum of the check-digit rule over a list of decimal digits, the last one undoubled."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when(F.pmod(n - 1 - i, F.lit(2)) == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda s, d: s + d)


def _digits(value: Column) -> Column:
    return F.transform(F.filter(F.split(value, ""), lambda c: c.rlike("^[0-9]$")), lambda c: c.cast("long"))


def _by_characters(value: Column, key: str, keep_head: Column, keep_tail: Column, narrow: Column) -> Column:
    """Permutes digits and letters in their classes; the first ``keep_head`` and last ``keep_tail`` characters stay.
    At the positions in ``narrow`` a digit of 2 to 9 stays one, and so does a 0 or 1; at those in it as -1 - position, one of 1 to 9."""
    n = F.length(value)

    def cell(c: Column, i: Column) -> Column:
        fixed = (i < keep_head) | (i >= n - keep_tail)
        low = F.array_contains(narrow, i) & c.rlike("^[01]$")
        base = F.when(F.array_contains(narrow, i) & ~low, 50).when(F.array_contains(narrow, -1 - i), 49).when(c.rlike("^[0-9]$"), 48)
        base = base.when(c.rlike("^[a-z]$"), 97).when(c.rlike("^[A-Z]$"), 65)
        base = F.when(fixed, None).otherwise(base)
        size = F.when(low, 2).when(base == 50, 8).when(base == 49, 9).when(base == 48, 10).otherwise(26)
        return F.struct(
            c.alias("c"), base.alias("base"), F.when(base.isNull(), 1).otherwise(size).cast("long").alias("m"), F.when(base.isNull(), 0).otherwise(F.ascii(c) - base).cast("long").alias("d")
        )

    def spell(cells: Column) -> Column:
        moved = feistel(F.transform(cells, lambda x: x["d"]), F.transform(cells, lambda x: x["m"]), key)
        return F.array_join(F.zip_with(cells, moved, lambda x, d: F.when(x["base"].isNull(), x["c"]).otherwise(F.chr(x["base"] + d))), "")

    return _let(F.transform(F.split(value, ""), cell), spell)


def _card(value: Column, key: str) -> Column:
    """A number whose check digit holds: all but that digit permuted, the digit made to hold again."""

    def last(moved: Column) -> Column:
        check = F.pmod(-_check_digit_sum(F.concat(_digits(F.substring(moved, F.lit(1), F.length(moved) - 1)), F.array(F.lit(0).cast("long")))), F.lit(10))
        return F.concat(F.substring(moved, F.lit(1), F.length(moved) - 1), check.cast("string"))

    new = _let(_by_characters(value, f"{key}|card", F.lit(0), F.lit(1), F.array().cast("array<int>")), last)
    return F.when(F.pmod(_check_digit_sum(_digits(value)), F.lit(10)) == 0, new)


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    return F.array_join(feistel(octets, F.array(*[F.lit(256).cast("long")] * 4), f"{key}|ip"), ".")


def _social(value: Column, key: str) -> Column:
    area, group, serial = [F.get(F.split(value, "-"), F.lit(i)).cast("long") for i in range(3)]
    parts = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)

    def spell(p: Column) -> Column:
        area = F.get(p, F.lit(0)) + F.when(F.get(p, F.lit(0)) >= 665, 2).otherwise(1)
        return F.concat_ws("-", *[F.lpad(n.cast("string"), w, "0") for n, w in ((area, 3), (F.get(p, F.lit(1)) + 1, 2), (F.get(p, F.lit(2)) + 1, 4))])

    return _let(feistel(parts, F.array(*[F.lit(m).cast("long") for m in SOCIAL_MODULI]), f"{key}|social"), spell)


def _moved(number: Column, moduli: tuple[int, int], key: str) -> Column:
    """The number's place under a permutation of 0 to the product of the moduli."""
    size = F.lit(moduli[1]).cast("long")
    parts = F.array(F.floor(number / size).cast("long"), F.pmod(number, size))
    moved = feistel(parts, F.array(*[F.lit(m).cast("long") for m in moduli]), key)
    return _let(moved, lambda p: F.get(p, F.lit(0)) * size + F.get(p, F.lit(1)))


def _moved_day(form: str, key: str) -> Callable[[Column], Column]:
    first = F.lit(FIRST_DAY).cast("date")

    def move(day: Column) -> Column:
        to = F.date_add(first, _moved(day, DATE_MODULI, f"{key}|date").cast("int"))
        return F.when(day.between(0, DAYS - 1), F.date_format(to, form))

    return move


def _moved_late_day(form: str, key: str) -> Callable[[Column], Column]:
    """As ``_moved_day`` among the days after the 12th, so the day can be told from the month before and after."""
    first = F.lit(FIRST_DAY).cast("date")

    def before(month: Column) -> Column:
        """Days after the 12th in the months before ``month``, counted from the first one."""
        return F.datediff(F.add_months(first, month), first) - 12 * month

    def day_of(at: Column) -> Column:
        guess = F.floor(at * 4800 / LATE_DAYS).cast("int")  # off by one month at most
        month = F.when(before(guess + 1) <= at, guess + 1).when(before(guess) <= at, guess).otherwise(guess - 1)
        return _let(month, lambda m: F.date_add(first, (at + 12 * (m + 1)).cast("int")))

    def move(day: Column) -> Column:
        date = F.date_add(first, day.cast("int"))
        month = (F.year(date) - 1800) * 12 + F.month(date) - 1
        to = _let(_moved(day - 12 * (month + 1), LATE_MODULI, f"{key}|date"), day_of)
        return F.when(day.between(0, DAYS - 1) & (F.dayofmonth(date) > 12), F.date_format(to, form))

    return move


def _date(value: Column, key: str) -> Column:
    """A calendar date of the years 1800 to 2199, in the notation it has. With slashes the month is first where it can be."""
    forms = (("-", "yyyy-MM-dd", _moved_day), (".", "dd.MM.yyyy", _moved_day), ("/", "MM/dd/yyyy", _moved_day), ("/", "dd/MM/yyyy", _moved_late_day))
    written = []
    for mark, form, moved in forms:
        day = F.datediff(F.call_function("try_to_date", value, F.lit(form)), F.lit(FIRST_DAY).cast("date")).cast("long")
        written.append(F.when(F.instr(value, mark) > 0, _let(day, moved(form, key))))
    return F.coalesce(*written)


def _phone(value: Column, key: str) -> Column:
    """Country code and trunk 0 stay, the other digits are permuted."""
    none = F.array().cast("array<int>")
    code = F.length(F.regexp_extract(value, rf"^(\+\d{{1,3}}?[ .-]?)(?={_AREA}$)", 1))
    other = F.length(F.regexp_extract(value, r"^(\+(?:\d{1,3}(?=[ .()-])|[17]|\d\d))", 1))
    trunk = F.length(F.regexp_extract(value, r"^(\(?0)", 1))
    area = value.rlike(rf"^(?:\+\d{{1,3}}[ .-]?)?{_AREA}$")
    head = F.when(area, code).when(value.startswith("+"), other).otherwise(trunk)
    narrow = F.when(area, _first_digits(value, code)).when(value.startswith("+"), none).otherwise(F.array(-1 - trunk))
    return _by_characters(value, f"{key}|phone", head, F.lit(0), narrow)


def _first_digits(value: Column, skip: Column) -> Column:
    """Positions of the first and the fourth digit after the first ``skip`` characters."""
    spots = F.filter(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("^[0-9]$") & (i >= skip), i)), lambda i: i.isNotNull())
    return _let(spots, lambda s: F.array(F.get(s, F.lit(0)), F.get(s, F.lit(3))))


def kind_of(value: Column) -> Column:
    """The first kind whose whole pattern the value has."""
    out = None
    for name, pattern in PATTERNS.items():
        fits = value.rlike(f"^(?:{pattern})$")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; null if it does not pass its kind's validation."""
    none = F.array().cast("array<int>")
    head = F.length(F.regexp_extract(value, r"^([\w-]+?[\"']?\s?[=:]\s?[\"']?)", 1))
    tail = F.length(F.regexp_extract(value, r"(\.[A-Za-z]+)$", 1))
    zero = F.lit(0)
    kind = kind_of(value)
    return (
        F.when(kind == "email", _by_characters(value, f"{key}|email", zero, tail, none))
        .when(kind == "secret", _by_characters(value, f"{key}|secret", head, zero, none))
        .when(kind == "access_key", _by_characters(value, f"{key}|access_key", F.lit(4), zero, none))
        .when(kind == "ip", _ip(value, key))
        .when(kind == "date", _date(value, key))
        .when(kind == "social", _social(value, key))
        .when(kind == "phone", _phone(value, key))
        .when(kind == "card", _card(value, key))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs`` with ``text`` pseudonymised, and found: array of (kind, value, pseudonym) in the order of the text.

    Values that fail validation stay and are not in ``found``. Null texts stay null, with an empty ``found``. The work is one
    pass over each text, no rows move. An existing column ``found`` is replaced.
    """
    docs = docs.drop("found")
    text = F.col("text")
    hint = text.rlike(HINT)
    rows = docs.withColumn("_values", F.when(hint, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_values", F.coalesce("_values", F.array().cast("array<string>")))
    made = F.transform("_values", lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value"), pseudonym(v, key).alias("pseudonym")))
    rows = rows.withColumn("_made", F.when(F.size("_values") > 0, made))
    # the gaps between the values and the values, in turn; splitting and finding use one pattern, so they agree
    gaps = F.split(text, ANY, -1)
    pieces = F.zip_with(gaps, F.col("_made"), lambda g, m: F.concat(g, F.coalesce(m["pseudonym"], m["value"], F.lit(""))))
    rows = rows.withColumn("text", F.when(F.size("_values") > 0, F.array_join(pieces, "")).otherwise(text))
    found = F.coalesce(F.filter("_made", lambda m: m["pseudonym"].isNotNull()), F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>"))
    return rows.withColumn("found", found).drop("_values", "_made")
