"""Format-preserving pseudonyms for personal numbers, dates and addresses, by a keyed Feistel network.

Everything is a column expression: candidates come from one regular expression, are validated, and
permuted by higher-order functions.  No Python runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import packed, quoted, without

ROUNDS = 8
#: Days of 400 years from FIRST_DAY, a whole Gregorian cycle: 189 * 773.
FIRST_DAY, DAY_CELLS = "1800-01-01", (189, 773)

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Letters by country; an IBAN of these has this length, whatever stands behind it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
}
IBAN = "(?:" + "|".join(
    rf"(?<![A-Za-z0-9])(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
    + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])"
    for n, names in IBAN_LENGTHS.items()
) + "|" + IBAN + ")"
#: No digit, nor digits behind a point, before or after.
FREE, END = r"(?<![0-9A-Za-z])(?<![0-9][.-])", r"(?![0-9A-Za-z])(?![.-][0-9])"
IP = FREE + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + END
DATE_ISO = FREE + r"[0-9]{4}([-/.])[0-9]{2}\{g}[0-9]{2}(?:" + END + "|(?=T[0-9]{2}))"
DATE_DAY = FREE + r"[0-9]{2}([/.])[0-9]{2}\{g}[0-9]{4}" + END
SSN = FREE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END
CARD = FREE + r"[0-9](?:[ -]?[0-9]){12,18}" + END
#: Groups of digits in which a card may stand beside other numbers, and the groupings it is printed in.
RUN = FREE + r"[0-9](?:[ -]?[0-9]){12}(?:[0-9 -]*[0-9])?" + END
PRINTED = (
    "^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,4}"
    "|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
)
NANP = r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-][0-9]{4}" + END
PHONE = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}" + END

#: Alternatives in this order: the first that matches at a place is the candidate there.
SINGLE = "|".join(
    (EMAIL, IBAN, IP, DATE_ISO.replace(r"\{g}", r"\1"), DATE_DAY.replace(r"\{g}", r"\2"), SSN, CARD, NANP, PHONE)
)
#: The same, but runs of digit groups come whole.
CANDIDATE = SINGLE.replace(CARD, RUN)
KINDS = {
    "email": EMAIL,
    "iban": IBAN,
    "ip": IP,
    "date_iso": DATE_ISO.replace(r"\{g}", r"\1"),
    "date_day": DATE_DAY.replace(r"\{g}", r"\1"),
    "ssn": SSN,
    "card": CARD,
    "nanp": NANP,
    "phone": PHONE,
}


def _text(value: str) -> str:
    """A SQL literal; raw, so that backslashes stay."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def permuted(cells: str, sizes: str, key: str, tweak: str) -> str:
    """SQL for a keyed permutation of the integer array ``cells``; cell i stays below ``sizes[i]``.

    Feistel rounds: the even cells move by a keyed hash of the odd ones, then the odd by the even;
    each move is an addition modulo the cell's size, so every round can be undone and the whole is
    one to one.  ``tweak`` and the sizes go into the hash.
    """
    fixed = "array_join(transform(filter(v, (x, i) -> i % 2 = r % 2), x -> cast(x as string)), ',')"
    digest = f"sha2(concat({_text(key)}, '|{tweak}|', cast(r as string), '|', z, '|', {fixed}), 256)"
    shift = "cast(conv(substring(h, 1 + 4 * cast(i % 16 as int), 4), 16, 10) as int)"
    moved = f"transform(v, (x, i) -> if(i % 2 = r % 2, x, (x + {shift}) % n[i]))"
    rounds = f"aggregate(sequence(1, {ROUNDS}), {cells}, (v, r) -> {_let(digest, 'h', moved)})"
    joined = "array_join(transform(n, x -> cast(x as string)), ',')"
    return _let(sizes, "n", _let(joined, "z", rounds))


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def _kept(text: str) -> str:
    """Letters and digits of an ASCII text."""
    return f"regexp_replace({text}, '[^0-9A-Za-z]', '')"


def _base(c: str) -> str:
    return f"(case when {c} between '0' and '9' then 48 when {c} between 'a' and 'z' then 97 when {c} between 'A' and 'Z' then 65 else ascii({c}) end)"


def _size(c: str) -> str:
    return f"(case when {c} between '0' and '9' then 10 when {c} between 'a' and 'z' then 26 when {c} between 'A' and 'Z' then 26 else 1 end)"


def _letters(text: str, key: str, tweak: str, size: str = "", base: str = "") -> str:
    """Characters permuted within digits, small and capital letters; others stay.

    ``size`` and ``base`` may give other bounds for the character ``c`` at place ``k``.
    """
    size, base = size or _size("c"), base or _base("c")
    cells = f"transform(a, (c, k) -> cast(ascii(c) - {base} as int))"
    moved = permuted(cells, f"transform(a, (c, k) -> cast({size} as int))", key, tweak)
    out = f"array_join(zip_with(transform(a, (c, k) -> {base}), {moved}, (b, x) -> chr(b + x)), '')"
    return _let(_chars(text), "a", f"if(size(a) < 2, {text}, {out})")


def _laid(form: str, value: str) -> str:
    """The characters of ``value`` in the places of letters and digits of ``form``."""
    step = (
        "(s, c) -> if(c rlike '[0-9A-Za-z]', struct(concat(s.t, substring(u, s.k + 1, 1)) as t, s.k + 1 as k),"
        " struct(concat(s.t, c) as t, s.k as k))"
    )
    return _let(value, "u", f"aggregate({_chars(form)}, struct('' as t, 0 as k), {step}).t")


def _luhn(digits: str) -> str:
    """Sum of Luhn over a text of digits, whose last is the check digit."""
    doubled = "if(x > 4, 2 * x - 9, 2 * x)"
    return (
        f"aggregate(transform(reverse(filter(split({digits}, ''), c -> c <> '')), (c, i) -> "
        f"{_let('cast(c as int)', 'x', f'if(i % 2 = 1, {doubled}, x)')}), 0, (s, x) -> s + x)"
    )


def _mod97(text: str) -> str:
    """A text of digits and capitals (A is 10) as a number, modulo 97."""
    return (
        f"aggregate({_chars(text)}, 0, (s, c) -> if(c between '0' and '9', (s * 10 + ascii(c) - 48) % 97,"
        " (s * 100 + ascii(c) - 55) % 97))"
    )


def _pseudonym(kind: str, m: str, key: str) -> str:
    """SQL: the pseudonym of the candidate ``m``, or null if it isn't valid."""
    if kind == "email":
        return f"concat({_letters(f'substring_index({m}, \'@\', 1)', key, kind)}, '@', substring_index({m}, '@', -1))"
    if kind == "iban":
        turned = "concat(substring(v, 5), substring(v, 1, 4))"
        body = _letters("substring(v, 5)", key, kind)
        check = f"lpad(cast(98 - {_mod97('concat(w, substring(v, 1, 2), \'00\')')} as string), 2, '0')"
        made = _let(body, "w", f"concat(substring(v, 1, 2), {check}, w)")
        return _let(_kept(m), "v", f"if({_mod97(turned)} = 1, {_laid(m, made)}, null)")
    if kind == "ip":
        # two pairs of octets are the two halves of an address
        parts = f"transform(split({m}, '[.]'), c -> cast(c as int))"
        moved = permuted("v", "array(256, 256, 256, 256)", key, kind)
        return _let(parts, "v", f"if(forall(v, x -> x < 256), array_join(transform({moved}, x -> cast(x as string)), '.'), null)")
    if kind in ("date_iso", "date_day"):
        digits = _kept(m)
        day = digits if kind == "date_iso" else (
            f"if(contains({m}, '/'), concat(substring({digits}, 5, 4), substring({digits}, 1, 4)),"
            f" concat(substring({digits}, 5, 4), substring({digits}, 3, 2), substring({digits}, 1, 2)))"
        )
        number = f"datediff(try_to_timestamp({day}, 'yyyyMMdd'), date'{FIRST_DAY}')"
        a, b = DAY_CELLS
        moved = permuted(f"array(cast(floor(d / {b}) as int), cast(d % {b} as int))", f"array({a}, {b})", key, "date")
        back = f"date_add(date'{FIRST_DAY}', y[0] * {b} + y[1])"
        form = "'yyyyMMdd'" if kind == "date_iso" else f"if(contains({m}, '/'), 'MMddyyyy', 'ddMMyyyy')"
        made = _let(moved, "y", f"date_format({back}, {form})")
        return _let(number, "d", f"if(d >= 0 and d < {a * b}, {_laid(m, made)}, null)")
    if kind == "ssn":
        parts = f"transform(split({m}, '-'), c -> cast(c as int))"
        cells = "array(if(v[0] > 666, v[0] - 2, v[0] - 1), v[1] - 1, v[2] - 1)"
        moved = permuted(cells, "array(898, 99, 9999)", key, kind)
        shown = (
            "concat(lpad(cast(if(y[0] >= 665, y[0] + 2, y[0] + 1) as string), 3, '0'), '-',"
            " lpad(cast(y[1] + 1 as string), 2, '0'), '-', lpad(cast(y[2] + 1 as string), 4, '0'))"
        )
        valid = "v[0] > 0 and v[0] <> 666 and v[0] < 900 and v[1] > 0 and v[2] > 0"
        return _let(parts, "v", f"if({valid}, {_let(moved, 'y', shown)}, null)")
    if kind == "card":
        # the first digit stays, the last is the check digit of the rest
        body = _letters("substring(v, 1, length(v) - 1)", key, kind, "if(k = 0, 1, 10)", "if(k = 0, ascii(c), 48)")
        check = f"cast((10 - {_luhn('concat(w, \'0\')')} % 10) % 10 as string)"
        made = _let(body, "w", f"concat(w, {check})")
        return _let(_kept(m), "v", f"if({_luhn('v')} % 10 = 0 and v rlike '[1-9]', {_laid(m, made)}, null)")
    if kind == "nanp":
        # country code is left out so that one number with and without it stays linked
        digits = f"right({_kept(m)}, 10)"
        body = _letters(digits, key, kind, "if(k in (0, 3), 8, 10)", "if(k in (0, 3), 50, 48)")
        return _laid(m, f"concat(if(length({_kept(m)}) = 11, '1', ''), {body})")
    body = _letters("v", key, kind, "if(k < 2, 1, 10)", "if(k < 2, ascii(c), 48)")
    return _let(_kept(m), "v", f"if(length(v) between 8 and 15, {_laid(m, body)}, null)")


def _replaced(key: str) -> str:
    """SQL for the pseudonym of a candidate ``m``, null if it isn't valid by the first kind it has."""
    cases = " ".join(
        f"when m rlike {_text('^(?:' + pattern + ')$')} then {_pseudonym(kind, 'm', key)}"
        for kind, pattern in KINDS.items()
    )
    return f"case {cases} end"


def _scanned(text: str, key: str) -> str:
    """SQL: ``struct(t, n)``, a short text with its candidates replaced one by one, and their number."""
    found = f"transform(regexp_extract_all({text}, {_text(SINGLE)}, 0), m -> struct(m as m, {_replaced(key)} as p))"
    joined = f"array_join(zip_with(split({text}, {_text(SINGLE)}, -1), f, (s, x) -> concat(s, coalesce(x.p, x.m, ''))), '')"
    return _let(found, "f", f"struct({joined} as t, size(filter(f, x -> x.p is not null)) as n)")


def _run(key: str) -> str:
    """SQL: ``struct(t, n)`` of a run ``m`` of digit groups.

    Cards in printed groupings come first, from left to right; what is left between them is scanned
    like any text.
    """
    part = "regexp_replace(array_join(zip_with(slice(b, i + 1, k), slice(g, i + 1, k), (x, y) -> concat(x, y)), ''), '^[ -]+', '')"
    read = _let(part, "q", f"struct(k as k, if(q rlike {_text(PRINTED)}, {_pseudonym('card', 'q', key)}, null) as p)")
    tried = f"filter(transform(filter(array(1, 4, 5, 3), k -> i + k <= size(g)), k -> {read}), x -> x.p is not null)"
    card = "struct(concat(r.t, b[i], '|', c[0].p, '|') as t, i + c[0].k as i)"
    plain = "struct(concat(r.t, b[i], g[i]) as t, i + 1 as i)"
    step = f"if(i < r.i, r, {_let(tried, 'c', f'if(size(c) > 0, {card}, {plain})')})"
    swept = f"aggregate(sequence(0, size(g) - 1), struct('' as t, 0 as i), (r, i) -> {step}).t"
    swept = _let("split(m, '[ -]+', -1)", "g", _let("split(m, '[0-9]+', -1)", "b", swept))
    pieces = f"transform(split({swept}, '[|]', -1), (o, j) -> if(j % 2 = 1, struct(o as t, 1 as n), {_scanned('o', key)}))"
    return _let(pieces, "z", "struct(array_join(transform(z, x -> x.t), '') as t, aggregate(z, 0, (a, x) -> a + x.n) as n)")


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and their number in ``n_pseudonyms``.

    E-mail addresses (the part before @), IBANs (mod 97), IPv4 addresses, dates from 1800 to 2199
    (year first; day first with points; month first with slashes), US social security numbers,
    payment card numbers (Luhn) and phone numbers change into others of the same format that are
    valid by the same rules.  Equal values get equal pseudonyms in all documents, however they are
    separated; different values get different ones.  Candidates that aren't valid stay.  Cards next
    to other digits are found in the groupings they are printed in, IBANs by their country's length.

    A null text stays null with none, an empty one stays empty.  Repeated rows get the same
    result.  Other columns stay; an ``n_pseudonyms`` of the input gives way.  An empty table gives
    an empty table.  ``key`` shows in query plans: keep logs of plans as safe as the key.
    """
    names = without(docs, ["n_pseudonyms"]).columns
    pattern = _text(CANDIDATE)
    rows = docs.select(packed(docs, ["n_pseudonyms"]), quoted(text_col).cast("string").alias("_t"))
    one = _let(_replaced(key), "p", "struct(m as m, p as p, if(p is null, 0, 1) as n)")
    run = _let(_run(key), "p", "struct(m as m, if(p.n > 0, p.t, null) as p, p.n as n)")
    each = f"if(m rlike {_text('^(?:' + RUN + ')$')}, {run}, {one})"
    found = rows.withColumn(
        "_m", F.expr(f"if(_t rlike '[0-9@]', transform(regexp_extract_all(_t, {pattern}, 0), m -> {each}), array())")
    )
    pieces = f"split(_t, {pattern}, -1)"
    text = F.expr(
        f"if(exists(_m, x -> x.p is not null), array_join(zip_with({pieces}, _m, (s, x) -> concat(s, coalesce(x.p, x.m, ''))), ''), _t)"
    )
    number = F.expr("coalesce(aggregate(_m, 0, (a, x) -> a + x.n), 0)").cast("long")
    shown = [text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in names]
    return found.select(*shown, number.alias("n_pseudonyms"))
