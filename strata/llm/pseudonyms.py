"""PII: format-preserving Feistel pseudonyms.

Personal numbers and dates are found by one pattern, validated (check digits,
ranges, calendar), and replaced by a keyed permutation of the set of valid
values of the same form, so a pseudonym is again a valid value with the same
separators, equal values get equal pseudonyms in every document, and whoever
holds the key can undo it.  Kinds:

  card   13-19 digits with a valid Luhn digit: first digit kept, the others
         permuted, check digit recomputed
  iban   valid mod-97: country kept, digits and capitals permuted, check
         digits recomputed
  phone  North American numbers (area and exchange 2-9): permuted within
         that set; other numbers after "+": digits after the first two
  ssn    valid social security numbers, permuted within that set
  ip     IPv4 addresses, as 32-bit numbers
  date   y-m-d, d.m.y, d/m/y (m/d/y where only that is a date) with two-digit
         months and days in the years 1800-2199: permuted within those years
  email  letters and digits of the local part
  token  32-64 lower-case hexadecimal digits

Whatever fails validation stays as it is.  Cards and IBANs may stand beside
other numbers or capitals: from every place where one can begin, each length
that ends with a group is validated and the longest valid one taken; the rest
is searched on.  A permutation is a Feistel network
of ``ROUNDS`` rounds with SHA-2 of key, kind, round and half as the round
function; numbers use two residues (l mod a, r mod b), strings add to every
character within its class.  The whole is one expression per row: no shuffle,
no Python.

Null texts stay null (no values found); empty ones stay empty.  Repeated rows
are handled alike.  The key is a parameter (``spark.strata.pii.key`` in the
session, else ``KEY``); it must be kept secret in production.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "strata-example-key"
ROUNDS = 8  # even, so halves end where they began

PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++(?=\.)){0,126}\.[A-Za-z]{2,}+",
    "token": r"(?<![A-Za-z0-9])(?=[0-9a-f]{32})(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,64}+(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9])(?:\+1[ .-]?|1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
             r"|\+[2-9][0-9](?:[ .-]?[0-9]){6,12}(?![0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
KINDS = tuple(PATTERNS)
# Kinds whose values are validated first, at every length, and what may not
# stand on either side of a value.
VALUED = {"iban": "[A-Za-z0-9]", "card": "[0-9]"}

DIGITS, SMALL, CAPITAL, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _hash(key: Column, kind: str, i: Column, half: Column) -> Column:
    """128 hexadecimal digits: the round function before reduction."""
    return F.sha2(F.concat_ws("|", key, F.lit(kind), i.cast("string"), half.cast("string")), 512)


def _number(hexdigits: Column) -> Column:
    return F.conv(hexdigits, 16, 10).cast("long")


def permute_pair(key: Column, kind: str, left: Column, right: Column, a: int, b: int) -> Column:
    """Permutation of pairs (left < a, right < b), as struct(l, r)."""

    def step(acc: Column, i: Column) -> Column:
        shift = lambda half: _number(F.substring(_hash(key, kind, i, half), 1, 15))
        return F.when(i % 2 == 0, F.struct(F.pmod(acc["l"] + shift(acc["r"]), F.lit(a)).alias("l"), acc["r"].alias("r"))).otherwise(
            F.struct(acc["l"].alias("l"), F.pmod(acc["r"] + shift(acc["l"]), F.lit(b)).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permute_text(key: Column, kind: str, text: Column, alphabets: tuple[str, ...]) -> Column:
    """Permutation of strings: every character of an alphabet becomes one of
    the same alphabet, others stay.  At most 64 characters."""

    def add(half: Column, noise: Column) -> Column:
        def one(j: Column) -> Column:
            c, v = F.substr(half, j, F.lit(1)), _number(F.substr(noise, j * 4 - 3, F.lit(4)))
            out = c
            for alphabet in reversed(alphabets):
                at = F.position(c, F.lit(alphabet))
                out = F.when(at > 0, F.substr(F.lit(alphabet), F.pmod(at - 1 + v, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))).otherwise(out)
            return out

        return F.when(F.length(half) == 0, F.lit("")).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(half), F.lit(1))), one), ""))

    def step(acc: Column, i: Column) -> Column:
        return F.struct(acc["r"].alias("l"), add(acc["l"], _hash(key, kind, i, acc["r"])).alias("r"))

    n = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), n).alias("l"), F.substr(text, n + 1, F.length(text)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda x: F.concat(x["l"], x["r"]))


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def fill(form: Column, symbols: Column, kind: str = "[0-9]") -> Column:
    """``form`` with its characters of a kind replaced by ``symbols`` in turn."""
    one = lambda j: F.when(
        F.substr(form, j, F.lit(1)).rlike(kind),
        F.substr(symbols, F.length(F.regexp_replace(F.substr(form, F.lit(1), j), kind.replace("[", "[^"), "")), F.lit(1))
    ).otherwise(F.substr(form, j, F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def luhn(number: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""

    def step(total: Column, j: Column) -> Column:
        d = F.substr(number, F.length(number) - j, F.lit(1)).cast("int")
        return total + F.when(j % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step)


def mod97(text: Column) -> Column:
    """Remainder of digits and capitals (A = 10 ... Z = 35) modulo 97."""

    def step(rest: Column, j: Column) -> Column:
        c = F.substr(text, j, F.lit(1))
        letter = F.position(c, F.lit(CAPITAL))
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + c.try_cast("int")) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def is_card(m: Column) -> Column:
    return let(digits(m), lambda d: F.length(d).between(13, 19) & (luhn(d) % 10 == 0))


def is_iban(m: Column) -> Column:
    return let(F.replace(m, F.lit(" "), F.lit("")), lambda flat: F.length(flat).between(15, 34) & (
        mod97(F.concat(F.substr(flat, F.lit(5), F.length(flat)), F.substr(flat, F.lit(1), F.lit(4)))) == 1))


def valid_values(text: Column, kind: str) -> Column:
    """The longest valid value from every place where one of a kind of
    ``VALUED`` can begin, as distinct strings, longest first."""
    valid, least = {"iban": (is_iban, 15), "card": (is_card, 13)}[kind]
    before, rest = PATTERNS[kind].split(")", 1)  # the lookahead leaves the rest to be searched
    windows = F.regexp_extract_all(text, F.lit(f"{before})(?=({rest}))"), F.lit(1))

    def longest(w: Column) -> Column:
        ends = F.filter(F.sequence(F.length(w), F.lit(least), F.lit(-1)), lambda n: ~F.substr(w, n, F.lit(1)).isin(" ", "-")
                        & F.substr(w, n + 1, F.lit(1)).isin("", " ", "-"))
        return F.get(F.filter(F.transform(ends, lambda n: F.substr(w, F.lit(1), n)), valid), F.lit(0))

    found = F.array_distinct(F.array_compact(F.transform(F.array_distinct(windows), longest)))
    order = F.array_sort(F.transform(found, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    return F.transform(order, lambda x: x["v"])


def places(text: Column) -> Column:
    """The pattern of all places in a text: its valid cards and IBANs as they
    stand, other kinds by their patterns."""
    parts = []
    for k in KINDS:
        if k in VALUED:
            side = VALUED[k]
            alternatives = F.array_join(valid_values(text, k), "|")
            parts.append(let(alternatives, lambda v, side=side: F.when(v != "", F.concat(F.lit(f"(?<!{side})(?:"), v, F.lit(f")(?!{side})")))))
        else:
            parts.append(F.lit(f"(?:{PATTERNS[k]})"))
    return F.concat_ws("|", *parts)


def card(m: Column, key: Column) -> Column:
    def new(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_text(key, "card", F.substr(d, F.lit(2), F.length(d) - 2), (DIGITS,)))
        whole = let(body, lambda x: F.concat(x, F.pmod(10 - luhn(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when(luhn(d) % 10 == 0, let(whole, lambda x: fill(m, x)))

    return let(digits(m), new)


def iban(m: Column, key: Column) -> Column:
    def new(flat: Column) -> Column:
        country, rest = F.substr(flat, F.lit(1), F.lit(2)), F.substr(flat, F.lit(5), F.length(flat))
        valid = F.length(flat).between(15, 34) & (mod97(F.concat(rest, F.substr(flat, F.lit(1), F.lit(4)))) == 1)
        check = lambda body: F.lpad((98 - mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        whole = let(permute_text(key, "iban", rest, (DIGITS, CAPITAL)), lambda body: F.concat(country, check(body), body))
        return F.when(valid, let(whole, lambda x: fill(m, x, "[A-Z0-9]")))

    return let(F.replace(m, F.lit(" "), F.lit("")), new)


def phone(m: Column, key: Column) -> Column:
    def ten_digits(d: Column) -> Column:
        part = lambda a, n: F.substr(d, F.length(d) - 10 + a, F.lit(n)).try_cast("long")
        index = (part(1, 3) - 200) * 8_000_000 + (part(4, 3) - 200) * 10_000 + part(7, 4)
        pair = let(index, lambda i: permute_pair(key, "phone", F.floor(i / 80_000), i % 80_000, 80_000, 80_000))
        return let(let(pair, lambda x: x["l"] * 80_000 + x["r"]), lambda new: F.concat(
            F.substr(d, F.lit(1), F.length(d) - 10), (F.floor(new / 8_000_000) + 200).cast("string"),
            (F.floor(new / 10_000) % 800 + 200).cast("string"), F.lpad((new % 10_000).cast("string"), 4, "0")))

    other = lambda d: F.concat(F.substr(d, F.lit(1), F.lit(2)), permute_text(key, "phone+", F.substr(d, F.lit(3), F.length(d)), (DIGITS,)))
    new = let(digits(m), lambda d: F.when(m.rlike(r"^\+[2-9]"), other(d)).otherwise(ten_digits(d)))
    return let(new, lambda x: fill(m, x))


def ssn(m: Column, key: Column) -> Column:
    def new(d: Column) -> Column:
        part = lambda a, n: F.substr(d, F.lit(a), F.lit(n)).try_cast("long")
        area, group, serial = part(1, 3), part(4, 2), part(6, 4)
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1
        pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
        whole = lambda x, a: F.concat(pad(a + F.when(a >= 666, 1).otherwise(0), 3), pad(x["l"] % 99 + 1, 2), pad(x["r"] + 1, 4))
        text = let(permute_pair(key, "ssn", index, serial - 1, 898 * 99, 9999), lambda x: let(F.floor(x["l"] / 99) + 1, lambda a: whole(x, a)))
        return F.when(valid, let(text, lambda x: fill(m, x)))

    return let(digits(m), new)


def ip(m: Column, key: Column) -> Column:
    def new(part: Column) -> Column:
        one = lambda i: F.get(part, F.lit(i)).try_cast("long")
        pair = permute_pair(key, "ip", one(0) * 256 + one(1), one(2) * 256 + one(3), 1 << 16, 1 << 16)
        text = lambda x: F.concat_ws(".", *[c.cast("string") for c in (
            F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)])
        return F.when(F.forall(part, lambda x: x.try_cast("long") < 256), let(pair, text))

    return let(F.split(m, r"\."), new)


def date(m: Column, key: Column) -> Column:
    day_first = F.try_to_date(F.translate(m, ".", "/"), "dd/MM/yyyy")
    month_first = F.when(m.contains("/"), F.try_to_date(m, "MM/dd/yyyy"))
    found = F.coalesce(F.when(m.contains("-"), F.try_to_date(m, "yyyy-MM-dd")), day_first, month_first)

    def form(new: Column) -> Column:
        y, mo, d = (F.lpad(f(new).cast("string"), n, "0") for f, n in ((F.year, 4), (F.month, 2), (F.day, 2)))
        return F.when(m.contains("-"), F.concat_ws("-", y, mo, d)).when(m.contains("."), F.concat_ws(".", d, mo, y)).when(
            day_first.isNotNull(), F.concat_ws("/", d, mo, y)).otherwise(F.concat_ws("/", mo, d, y))

    def new(index: Column) -> Column:
        pair = permute_pair(key, "date", F.floor(index / 773), index % 773, 189, 773)
        day = let(pair, lambda x: F.date_add(F.lit("1800-01-01").cast("date"), (x["l"] * 773 + x["r"]).cast("int")))
        return F.when((index >= 0) & (index < 189 * 773), let(day, form))

    return let(F.date_diff(found, F.lit("1800-01-01").cast("date")), new)


def email(m: Column, key: Column) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permute_text(key, "email", local, (DIGITS, SMALL, CAPITAL)), F.substr(m, F.length(local) + 1, F.length(m)))


def token(m: Column, key: Column) -> Column:
    return permute_text(key, "token", m, (HEX,))


REPLACE = {"email": email, "token": token, "iban": iban, "ip": ip, "phone": phone, "date": date, "ssn": ssn, "card": card}


def pseudonymize(docs: DataFrame, key: str | None = None, found: str = "found") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and, in a further column (replacing
    one of that name), the kinds replaced, in order of place.  All other
    columns stay."""
    key_col = F.lit(key or docs.sparkSession.conf.get("spark.strata.pii.key", KEY))

    def replaced(m: Column) -> Column:
        kind = F.lit(None).cast("string")
        value = F.lit(None).cast("string")
        for k in reversed(KINDS):
            is_k = m.rlike(f"^(?:{PATTERNS[k]})$")
            kind, value = F.when(is_k, F.lit(k)).otherwise(kind), F.when(is_k, REPLACE[k](m, key_col)).otherwise(value)
        return let(F.struct(kind.alias("kind"), value.alias("value")), lambda x: F.struct(
            F.when(x["value"].isNotNull(), x["kind"]).alias("kind"), F.coalesce(x["value"], m).alias("value")))

    text = F.col("text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.when(text.rlike("[0-9@]"), let(places(text), lambda pattern: F.struct(
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), replaced).alias("seen"), F.split(text, pattern, -1).alias("between")))).alias("cut"))
    rows = rows.select("row", F.coalesce("cut.seen", F.array().cast("array<struct<kind:string,value:string>>")).alias("seen"), "cut.between")
    text, between = F.col("row.text"), F.col("between")
    joined = F.concat(F.get(between, F.lit(0)), F.array_join(F.transform(
        "seen", lambda x, i: F.concat(x["value"], F.get(between, i + 1))), ""))
    new = F.when(F.size("seen") > 0, joined).otherwise(text)
    kinds = F.transform(F.filter("seen", lambda x: x["kind"].isNotNull()), lambda x: x["kind"])
    kept = [new.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != found]
    return rows.select(*kept, F.coalesce(kinds, F.array().cast("array<string>")).alias(found))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: the text with pseudonyms, how many values were
    replaced and of which kinds."""
    rows = pseudonymize(docs.select("doc_id", "text"))
    return rows.select("doc_id", "text", F.size("found").cast("long").alias("n_found"),
                       F.concat_ws(",", F.array_sort(F.array_distinct("found"))).alias("kinds"))
