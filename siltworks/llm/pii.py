"""Personal data replaced by format-preserving Feistel pseudonyms, in Spark expressions only.

One pattern finds candidates; each is validated by kind and mapped inside its own
format by a keyed Feistel permutation, so equal values get equal pseudonyms in every
document and different values of a kind stay different:

* card numbers (13 to 19 digits, Luhn): all digits but the last are permuted, the
  check digit is made anew; separators stay; they are found among the groups of a
  longer run of digits too, as before an expiry date or behind a reference;
* IBANs (mod 97): the digits of the account part are permuted, the check digits are
  made anew; country and letters stay;
* telephone numbers: North American numbers stay in the numbering plan, others keep
  the plus sign and two leading digits;
* social security numbers (AAA-GG-SSSS, valid areas, groups and serials);
* dates from 1700-01-01 to 2099-12-31 (ISO, slashed, dotted): another day of the same
  four hundred years in the same notation and order; a date that only month first can be
  read stays one, as the permutation is repeated until its day exceeds 12;
* IPv4 addresses (four octets, not behind a word such as "section" or "version"): another address.

A permutation of a x b values keeps a value as two residues and adds, in turn, a
keyed SHA-256 of the one to the other; it is a bijection for any a and b.  E-mail
addresses and secrets (access keys; what stands behind a word such as "password" or
"token" and a sign or in quotes, if it has eight letters or digits, or fewer but a digit
among them, or for passwords follows "=" at once) have no format worth keeping and become
keyed tags.  Candidates that fail validation stay as they are.

Defined results: null stays null, empty stays empty; every other column passes
through; the noncharacters U+FDD0 and U+FDD1 are lost where they enclose a card number.

The key is a parameter.  It is a literal of the plan, so plans and event logs are as
secret as the key.  The queries take it from ``spark.siltworks.pii.key``; where that is
unset they use a public key that is good for tests only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_SETTING, TEST_KEY = "spark.siltworks.pii.key", "siltworks-test-key"
ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
#: Signs that enclose a card once it is found; no value of a secret reaches into one.
OPEN, CLOSE = "\ufdd0", "\ufdd1"
_PASSWORD, _TOKEN, _VALUE = r"(?i:\b(?:password|passwd|pwd)\b)[\"']?", r"(?i:\b(?:secret|token|api_?key)\b)[\"']?", rf"[^\s\"'<>,;{OPEN}{CLOSE}]"
_HAS = lambda kind: rf"(?={_VALUE}{{0,64}}{kind})"
_NO_RUN = r"(?!\d[\d -]{11})"
_END = r"(?<![.!?:)])[\"']?"
#: After its word and a sign: eight letters, digits or base-64 signs; or shorter, where digits or the word say more.
SECRET = "|".join(
    [
        rf"(?:{_PASSWORD}|{_TOKEN})\s{{0,3}}[=:]\s{{0,3}}[\"']?[A-Za-z0-9+/_\-]{{8,}}[\"']?",
        rf"{_PASSWORD}\s{{0,3}}[=:]\s{{0,3}}[\"']?{_NO_RUN}{_HAS('[0-9]')}{_VALUE}{{3,}}{_END}",
        rf"{_PASSWORD}(?:=[\"']?|:[\"']){_NO_RUN}{_VALUE}{{3,}}{_END}",
        rf"{_TOKEN}\s{{0,3}}[=:]\s{{0,3}}[\"']?{_HAS('[0-9]')}{_HAS('[A-Za-z]')}{_VALUE}{{6,}}{_END}",
        rf"(?:{_PASSWORD}|{_TOKEN})\s{{1,3}}[\"']{_HAS('[0-9]')}{_HAS('[A-Za-z]')}{_VALUE}{{6,}}[\"']",
    ]
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE = r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d/-])"
#: Four numbers behind such a word are a section or version, no address.
_NUMBERED = r"(?<!\b(?i:sections?|sec|chapters?|clauses?|articles?|appendix|paragraphs?|versions?|ver|v|releases?)[.:]?\s{0,2})(?<!\u00a7\s{0,2})"
IP = rf"(?<![\d.])(?=\d{{1,3}}\.\d){_NUMBERED}\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
NANP = r"(?<![\d+])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\d)"
CARD = r"\d(?:[ -]?\d){12,18}"
#: Digit groups that may hold cards; no repeated group, so that a long run needs no deep stack.
RUN = r"(?<![\d+])\d[\d -]{11,}\d"
USUAL_CARD = r"\d{13,19}|\d{4}([ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5}"
MARKED = rf"{OPEN}\d[\d -]++{CLOSE}"
PHONE = r"\+\d(?:[ .()-]{0,2}\d){7,14}(?!\d)"
PATTERN = "|".join([MARKED, EMAIL, ACCESS_KEY, SECRET, IBAN, DATE, IP, SSN, NANP, PHONE])
#: What every candidate has: a digit, an at sign, or the word or prefix that its pattern begins with.
SIGN = r"[0-9@]|A[KS]IA|(?i:passw|pwd|secret|token|api_?key)"
RUNS = "|".join([EMAIL, ACCESS_KEY, SECRET, IBAN, DATE, IP, SSN, NANP, RUN, PHONE])
KINDS = ("email", "secret", "iban", "date", "ip", "ssn", "card", "phone")


def _digest(*parts: Column) -> Column:
    """60 bits of a keyed SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def permuted(x: Column, y: Column, a: Column | int, b: Column | int, kind: str, key: Column) -> Column:
    """The pair (x in [0, a), y in [0, b)) mapped to another, one to one; a struct (x, y)."""
    a, b = (v.cast("bigint") if isinstance(v, Column) else F.lit(v).cast("bigint") for v in (a, b))
    tag = F.lit(kind)

    def turn(s: Column, i: Column) -> Column:
        first = F.pmod(s["x"] + F.pmod(_digest(key, tag, a.cast("string"), b.cast("string"), i.cast("string"), s["y"].cast("string")), a), a)
        second = F.pmod(s["y"] + F.pmod(_digest(key, tag, a.cast("string"), b.cast("string"), i.cast("string"), s["x"].cast("string")), b), b)
        return F.when(i % 2 == 0, F.struct(first.alias("x"), s["y"].alias("y"))).otherwise(F.struct(s["x"].alias("x"), second.alias("y")))

    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def digits_permuted(d: Column, kind: str, key: Column) -> Column:
    """A string of 2 to 36 digits mapped to another of the same length, one to one."""
    n = F.length(d)
    u = F.floor(n / 2).cast("int")
    v = n - u
    power = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("bigint")
    both = permuted(F.substr(d, F.lit(1), u).cast("bigint"), F.substr(d, u + 1, v).cast("bigint"), power(u), power(v), kind, key)
    return F.transform(F.array(both), lambda s: F.concat(F.lpad(s["x"].cast("string"), u, "0"), F.lpad(s["y"].cast("string"), v, "0")))[0]


def luhn(d: Column) -> Column:
    """The check digit that completes the digits ``d``."""
    n = F.length(d)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc + F.transform(F.array(F.substr(d, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)), lambda v: F.when(v > 9, v - 9).otherwise(v))[0],
    )
    return ((10 - total % 10) % 10).cast("string")


def mod97(text: Column) -> Column:
    """Remainder of an IBAN's rearranged characters, letters counting 10 to 35."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(text)),
        F.lit(0).cast("bigint"),
        lambda acc, i: F.transform(
            F.array(F.substr(text, i, F.lit(1))),
            lambda c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
        )[0],
    )


def refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""
    pieces = F.split(shape, r"\d", -1)
    return F.concat(pieces[0], F.array_join(F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.concat(F.substr(digits, i, F.lit(1)), F.get(pieces, i))), ""))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _luhn_ok(d: Column) -> Column:
    return _let(F.substr(d, F.lit(1), F.length(d) - 1), luhn) == F.right(d, F.lit(1))


def _cards_marked(m: Column) -> Column:
    """A run of digit groups with its card numbers enclosed.

    From left to right, a group starts its valid card of usual form or else its longest;
    one of unusual form gives way to a usual one that starts inside it.
    """

    def of(g: Column) -> Column:
        def best(i: Column) -> Column:
            """(n, odd): the card that starts at group i, counted from 0, has n groups; n is 0 without one."""
            text = lambda n: F.ltrim(F.translate(F.array_join(F.slice(g, i + 1, n), ""), "-", " "))
            each = F.transform(F.sequence(F.lit(1), F.least(F.lit(19), F.size(g) - i)), lambda n: F.struct(n.alias("n"), text(n).alias("t")))
            cards = F.filter(each, lambda w: w["t"].rlike(f"^(?:{CARD})$") & _let(_only_digits(w["t"]), _luhn_ok))
            ordered = F.array_sort(F.transform(cards, lambda w: F.struct((~w["t"].rlike(f"^(?:{USUAL_CARD})$")).alias("odd"), (-w["n"]).alias("n"))))
            return _let(F.get(ordered, F.lit(0)), lambda w: F.struct(F.coalesce(-w["n"], F.lit(0)).alias("n"), F.coalesce(w["odd"], F.lit(True)).alias("odd")))

        def taken(c: Column) -> Column:
            """[first, last, first, last ...] of the cards taken."""

            def step(kept: Column, i: Column) -> Column:
                n, odd = c[i]["n"], c[i]["odd"]
                free = (n > 0) & (F.coalesce(F.element_at(kept, -1), F.lit(-1)) < i)
                gives_way = odd & F.exists(F.slice(c, i + 2, F.greatest(n - 1, F.lit(0))), lambda w: ~w["odd"])
                return F.when(free & ~gives_way, F.concat(kept, F.array(i, i + n - 1))).otherwise(kept)

            start = F.array(F.lit(-1), F.lit(-1))
            return F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), start, step)

        def joined(kept: Column) -> Column:
            ends = lambda k: F.filter(kept, lambda _, i: i % 2 == k)
            mark = lambda of, i, sign: F.when(F.array_contains(of, i), sign).otherwise("")
            put = lambda e: F.array_join(F.transform(g, lambda x, i: F.concat(F.regexp_extract(x, r"^\D*", 0), mark(e["a"], i, OPEN), _only_digits(x), mark(e["b"], i, CLOSE))), "")
            return _let(F.struct(ends(0).alias("a"), ends(1).alias("b")), put)

        return _let(_let(F.transform(F.sequence(F.lit(0), F.size(g) - 1), best), taken), joined)

    return F.when(m.rlike(f"^{RUN}$"), _let(F.regexp_extract_all(m, F.lit(r"[ -]*\d+"), F.lit(0)), of)).otherwise(m)


def _between(text: Column, pattern: str, values: Column) -> Column:
    """``text`` with the matches of ``pattern`` replaced, in order, by ``values``."""
    return F.array_join(F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("p"), values.alias("v")), lambda s: F.concat(s["p"], F.coalesce(s["v"], F.lit("")))), "")


def _card(m: Column, key: Column) -> Column:
    def of(d: Column) -> Column:
        head = F.substr(d, F.lit(1), F.length(d) - 1)
        return F.when(_luhn_ok(d), _let(digits_permuted(head, "card", key), lambda h: refilled(m, F.concat(h, luhn(h)))))

    return F.when((F.length(_only_digits(m)).between(13, 19)) & m.rlike(r"^\d[\d -]+$"), _let(_only_digits(m), of))


def _iban(m: Column, key: Column) -> Column:
    def of(c: Column) -> Column:
        turned = lambda body, check: F.concat(body, F.substr(c, F.lit(1), F.lit(2)), check)
        body = F.substr(c, F.lit(5), F.length(c) - 4)
        valid = mod97(turned(body, F.substr(c, F.lit(3), F.lit(2)))) == 1
        fresh = _let(digits_permuted(_only_digits(body), "iban", key), lambda d: refilled(body, d))
        new = _let(fresh, lambda x: F.concat(F.lpad((98 - mod97(turned(x, F.lit("00")))).cast("string"), 2, "0"), _only_digits(x)))
        return F.when(valid & (F.length(_only_digits(body)) >= 2), _let(new, lambda d: refilled(m, d)))

    return F.when(m.rlike("^[A-Z]{2}\\d{2}[A-Z0-9 ]+$") & F.regexp_replace(m, " ", "").rlike("^.{15,34}$"), _let(F.regexp_replace(m, " ", ""), of))


def _phone(m: Column, key: Column) -> Column:
    digits = _only_digits(m)

    def american(d: Column) -> Column:
        ten = F.right(d, F.lit(10))
        area = (F.substr(ten, F.lit(1), F.lit(3)).cast("bigint") - 200) * 800 + F.substr(ten, F.lit(4), F.lit(3)).cast("bigint") - 200
        new = permuted(area, F.substr(ten, F.lit(7), F.lit(4)).cast("bigint"), 640_000, 10_000, "nanp", key)
        lead = F.substr(d, F.lit(1), F.length(d) - 10)
        return _let(new, lambda s: refilled(m, F.concat(lead, F.lpad((F.floor(s["x"] / 800) + 200).cast("string"), 3, "0"), F.lpad((s["x"] % 800 + 200).cast("string"), 3, "0"), F.lpad(s["y"].cast("string"), 4, "0"))))

    def other(d: Column) -> Column:
        return refilled(m, F.concat(F.substr(d, F.lit(1), F.lit(2)), digits_permuted(F.substr(d, F.lit(3), F.length(d) - 2), "phone", key)))

    return F.when(m.rlike(f"^(?:{NANP})$"), _let(digits, american)).when(m.rlike(f"^(?:{PHONE})$"), _let(digits, other))


def _ip(m: Column, key: Column) -> Column:
    def of(o: Column) -> Column:
        part = lambda i: F.get(o, F.lit(i)).cast("bigint")
        new = permuted(part(0) * 256 + part(1), part(2) * 256 + part(3), 65_536, 65_536, "ip", key)
        return F.when(~F.exists(o, lambda x: x.cast("int") > 255), _let(new, lambda s: F.concat_ws(".", *[(F.floor(s[h] / d) % 256).cast("string") for h in "xy" for d in (256, 1)])))

    return F.when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), _let(F.split(m, r"\."), of))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (F.substr(m, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - (area > 666).cast("bigint")
    new = permuted(index * 99 + group - 1, serial - 1, 898 * 99, 9_999, "ssn", key)

    def text(s: Column) -> Column:
        i = F.floor(s["x"] / 99) + 1
        return F.concat_ws("-", F.lpad((i + (i > 665).cast("bigint")).cast("string"), 3, "0"), F.lpad((s["x"] % 99 + 1).cast("string"), 2, "0"), F.lpad((s["y"] + 1).cast("string"), 4, "0"))

    return F.when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(valid, _let(new, text)))


def _date(m: Column, key: Column) -> Column:
    """Day, month and year keep their order, separator and padding; day first where both fit."""
    sep = F.regexp_extract(m, r"^\d+(\D)", 1)
    parts = F.split(m, r"\D")

    def of(p: Column) -> Column:
        iso = F.length(F.get(p, F.lit(0))) == 4
        a, b, c = (F.get(p, F.lit(i)) for i in range(3))
        month_first = ~iso & (b.cast("int") > 12)
        year, month, day = F.when(iso, a).otherwise(c), F.when(iso, b).when(month_first, a).otherwise(b), F.when(iso, c).when(month_first, b).otherwise(a)
        date = F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
        # The 146,097 days of four hundred years are 189 x 773.
        n = F.datediff(date, F.lit("1700-01-01").cast("date"))
        turned = lambda s: permuted(s["x"], s["y"], 189, 773, "date", key)
        day_of = lambda s: F.date_add(F.lit("1700-01-01").cast("date"), (s["x"] * 773 + s["y"]).cast("int"))
        new = turned(F.struct(F.floor(n / 773).alias("x"), (n % 773).alias("y")))
        # Three in five days exceed 12: the chance that 64 turns find none is below 1e-26.
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), new, lambda s, _: F.when(F.day(day_of(s)) > 12, s).otherwise(turned(s)))

        def text(s: Column) -> Column:
            d = day_of(s)
            same = lambda old, v, k: F.when(F.length(old) == 2, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
            y, mo, da = F.lpad(F.year(d).cast("string"), 4, "0"), same(month, F.month(d), 2), same(day, F.day(d), 2)
            return F.when(iso, F.concat_ws("-", y, mo, da)).when(month_first, F.concat_ws("-", mo, da, y)).otherwise(F.concat_ws("-", da, mo, y))

        return F.when(n.between(0, 146_096), _let(F.when(month_first, walked).otherwise(new), lambda s: F.replace(text(s), F.lit("-"), sep)))

    return F.when(m.rlike(r"^\d{1,4}([-/.])\d{1,2}\1\d{1,4}$"), _let(parts, of))


def _tagged(m: Column, name: str, key: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", key, F.lit(name), m).cast("binary"), 256), 1, 12)


def pseudonym(m: Column, key: Column) -> Column:
    """struct(kind, value) of a candidate; kind is null where it fails validation."""
    tag = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    chain = F.when(m.rlike(f"^(?:{ACCESS_KEY})$"), tag("secret", F.concat(F.lit("[key-"), _tagged(m, "key", key), F.lit("]"))))
    chain = chain.when(m.rlike(f"^(?:{SECRET})$"), tag("secret", F.concat(F.lit("[secret-"), _tagged(m, "secret", key), F.lit("]"))))
    chain = chain.when(m.contains("@"), tag("email", F.concat(F.lit("user-"), _tagged(F.lower(m), "email", key), F.lit("@example.invalid"))))
    rest = F.coalesce(*[F.when(v.isNotNull(), tag(kind, v)) for kind, v in (("iban", _iban(m, key)), ("date", _date(m, key)), ("ip", _ip(m, key)), ("ssn", _ssn(m, key)), ("card", _card(m, key)), ("phone", _phone(m, key)))])
    return F.coalesce(chain, rest, F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))


def key_of(spark) -> str:
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with its text pseudonymised; with ``counts``, n_<kind> columns and n_pii follow."""
    # Rows travel as one struct, so that no column of theirs can clash with the steps' own.
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, secret = F.col(f"row.`{text_col}`"), F.lit(key)
    runs = F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))
    work = work.withColumn("marked", F.when(text.rlike(RUN), _between(text, RUNS, F.transform(runs, _cards_marked))).otherwise(text))
    work = work.withColumn("found", F.when(text.rlike(SIGN), F.regexp_extract_all("marked", F.lit(PATTERN), F.lit(0))))
    bare = lambda m: F.translate(m, OPEN + CLOSE, "")
    work = work.withColumn("new", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(bare(m), secret))))
    work = work.withColumn("text", F.when(F.size("new") > 0, _between(F.col("marked"), PATTERN, F.col("new.value"))).otherwise(text))
    extra = []
    if counts:
        number = lambda test: F.when(F.col("new").isNull(), 0).otherwise(F.size(F.filter("new.kind", test))).cast("bigint")
        extra = [number(_is(kind)).alias(f"n_{kind}") for kind in KINDS] + [number(lambda k: k.isNotNull()).alias("n_pii")]
    return work.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns], *extra)


def _is(kind: str):
    return lambda k: k == kind


def op5_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, key=key_of(spark), counts=True)
