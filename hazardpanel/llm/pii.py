"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

Candidates are found by pattern, validated (Luhn sum, mod-97 sum, octets,
calendar, numbering plan), mapped to a number of the set of all valid values of
their format, permuted there by a keyed Feistel network, and written back in the
very format they had.  The permutation depends on the key and the kind only, so
equal values get equal pseudonyms in every document, different values different
ones, and a pseudonym passes the same validation.  Text around them, and
candidates that fail validation, stay as they are.

Every set has a product form a x b (halves of the digits; days of a 400-year
calendar cycle; area x line ...), so the alternating network of Black and
Rogaway permutes it exactly, without cycle walking.  Addresses have no number to
permute: an e-mail's local part becomes a keyed code, its domain a reserved one.

Columns other than the text are kept (a column that already has the name of the
count is replaced).  A null text stays null with count 0, an empty text stays
empty; repeated rows change alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: First day and number of days of the calendar cycle that dates are permuted in (1700-01-01 .. 2099-12-31).
CYCLE_START, CYCLE_DAYS = -98615, (189, 773)

# The formats.
_DIGITS = {
    "date": r"\d{4}-\d{2}-\d{2}(?![\d-])|\d{2}\.\d{2}\.\d{4}(?!\d)|\d{2}/\d{2}/\d{4}(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "card": r"\d{13,19}(?!\d)|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?(?!\d)|\d{4}([ -])\d{6}\2\d{5}(?!\d)",
    "phone": r"(?:\+1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\d)",
    "line": r"\+[1-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)",
    "iban": r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![\p{L}\p{N}])|[A-Z]{2}\d{2} [A-Z0-9]{4}(?: (?=[A-Z]*\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
}
NUMBERS = r"(?<![\p{L}\p{N}])(?<!\d\.)(?:" + "|".join(_DIGITS.values()) + ")"
#: A name has at most 127 labels; the bound keeps the matcher's recursion (one step a label) short on any text.
ADDRESS = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.){1,127}\p{L}{2,}+"


def _call(sql: str, **parts: str) -> str:
    for name, part in parts.items():
        sql = sql.replace(f"<{name}>", part)
    return sql


def feistel(value: str, kind: str, a: str, b: str, key: str) -> str:
    """SQL for the permuted ``value`` (bigint in [0, a x b)); a, b: SQL bigints."""
    f = _call("cast(conv(substr(sha2(concat_ws('|', <key>, <kind>, r, <half>), 256), 1, 15), 16, 10) as bigint)", key=_text(key), kind=_text(kind))
    return _call(
        "aggregate(sequence(1, <rounds>), named_struct('l', (<v>) div (<b>), 'r', (<v>) % (<b>)),"
        " (s, r) -> if(r % 2 = 1, named_struct('l', (s.l + <fr>) % (<a>), 'r', s.r), named_struct('l', s.l, 'r', (s.r + <fl>) % (<b>))),"
        " s -> s.l * (<b>) + s.r)",
        rounds=str(ROUNDS), fr=_call(f, half="s.r"), fl=_call(f, half="s.l"), v=value, a=a, b=b)


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, body: str) -> str:
    """SQL ``body`` with ``x`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), x -> {body})[0]"


def _like(kind: str) -> str:
    return f"rlike(m, {_text('^(?:' + _DIGITS[kind] + ')$')})"


def _bare(s: str = "m") -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def _refill(digits: str) -> str:
    """``m`` with its digits replaced, in order, by those of ``digits``."""
    return _call(
        "aggregate(split(m, ''), named_struct('t', '', 'i', 1), (s, c) -> if(c rlike '^[0-9]$',"
        " named_struct('t', concat(s.t, substr(<d>, s.i, 1)), 'i', s.i + 1), named_struct('t', concat(s.t, c), 'i', s.i)), s -> s.t)", d=digits)


def _luhn(digits: str) -> str:
    """Luhn sum of a digit string, the last digit counting once."""
    return _call(
        "aggregate(sequence(1, length(<d>)), 0, (s, i) -> s + if((length(<d>) - i) % 2 = 0, cast(substr(<d>, i, 1) as int),"
        " cast(substr(<d>, i, 1) as int) * 2 - if(cast(substr(<d>, i, 1) as int) > 4, 9, 0)))", d=digits)


def _mod97(chars: str) -> str:
    """A string of digits and capitals (A = 10 .. Z = 35) modulo 97."""
    return _call("aggregate(split(<c>, ''), 0, (s, c) -> if(c = '', s, if(c rlike '[0-9]', s * 10 + cast(c as int), s * 100 + ascii(c) - 55) % 97))", c=chars)


def _power(n: str) -> str:
    return f"cast(pow(10, {n}) as bigint)"


def _permuted_digits(digits: str, kind: str, key: str) -> str:
    """A digit string permuted among all strings of its length."""
    n = f"length({digits})"
    return f"lpad(cast({feistel(f'cast({digits} as bigint)', kind, _power(f'({n} + 1) div 2'), _power(f'{n} div 2'), key)} as string), {n}, '0')"


def _card(key: str) -> str:
    body = _permuted_digits("substr(x, 2, length(x) - 2)", "card", key)
    made = f"concat(substr(x, 1, 1), {body})"
    checked = _let(made, f"concat(x, (10 - {_luhn('concat(x, 0)')} % 10) % 10)")
    return _let(_bare(), f"if(length(x) between 13 and 19 and substr(x, 1, 1) between '2' and '6' and {_luhn('x')} % 10 = 0, {_let(checked, _refill('x'))}, m)")


def _date(key: str) -> str:
    def form(pick: str, put: str) -> str:
        """pick: the ISO date of m; put: the format to write date y in."""
        number = f"unix_date(y) - ({CYCLE_START})"
        days = CYCLE_DAYS[0] * CYCLE_DAYS[1]
        new = f"date_from_unix_date(cast({feistel(f'cast({number} as bigint)', 'date', f'{CYCLE_DAYS[0]}L', f'{CYCLE_DAYS[1]}L', key)} + ({CYCLE_START}) as int))"
        return f"transform(array(try_cast({pick} as date)), y -> if(y is not null and {number} >= 0 and {number} < {days}, date_format({new}, '{put}'), null))[0]"
    iso = form("m", "yyyy-MM-dd")
    dotted = form("concat_ws('-', substr(m, 7, 4), substr(m, 4, 2), substr(m, 1, 2))", "dd.MM.yyyy")
    month_first = form("concat_ws('-', substr(m, 7, 4), substr(m, 1, 2), substr(m, 4, 2))", "MM/dd/yyyy")
    day_first = form("concat_ws('-', substr(m, 7, 4), substr(m, 4, 2), substr(m, 1, 2))", "dd/MM/yyyy")
    return f"coalesce(case when m like '____-__-__' then {iso} when m like '%.%' then {dotted} else coalesce({month_first}, {day_first}) end, m)"


def _ssn(key: str) -> str:
    # area 001-899 but 666 (898 values) x group 01-99, serial 0001-9999
    area, group, serial = (f"cast(substr(m, {a}, {n}) as bigint)" for a, n in ((1, 3), (5, 2), (8, 4)))
    number = f"((({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1) * 9999 + {serial} - 1)"
    new = feistel(number, "ssn", "88902L", "9999L", key)
    made = f"transform(array(x div 9999 div 99), a -> concat_ws('-', lpad(cast(a + if(a >= 665, 2, 1) as string), 3, '0'), lpad(cast(x div 9999 % 99 + 1 as string), 2, '0'), lpad(cast(x % 9999 + 1 as string), 4, '0')))[0]"
    return f"if({area} not in (0, 666) and {area} < 900 and {group} > 0 and {serial} > 0, {_let(new, made)}, m)"


def _ip(key: str) -> str:
    octets = "transform(split(m, '[.]'), o -> cast(o as bigint))"
    new = feistel("((x[0] * 256 + x[1]) * 256 + x[2]) * 256 + x[3]", "ip", "65536L", "65536L", key)
    made = f"transform(array({new}), n -> concat_ws('.', n div 16777216, n div 65536 % 256, n div 256 % 256, n % 256))[0]"
    return _let(octets, f"if(array_max(x) < 256, {made}, m)")


def _phone(key: str) -> str:
    # area 200-999 x exchange 200-999 x line 0000-9999
    number = "(((cast(substr(x, -10, 3) as bigint) - 200) * 800 + cast(substr(x, -7, 3) as bigint) - 200) * 10000 + cast(substr(x, -4, 4) as bigint))"
    new = feistel(number, "phone", "80000L", "80000L", key)
    made = f"transform(array({new}), n -> concat(substr(x, 1, length(x) - 10), n div 8000000 + 200, n div 10000 % 800 + 200, lpad(cast(n % 10000 as string), 4, '0')))[0]"
    return _let(_bare(), _let(made, _refill("x")))


def _line(key: str) -> str:
    """International numbers: the country code (its own group, else two digits) stays."""
    code = "length(regexp_extract(m, '^\\\\+([0-9]{1,3})[^0-9]', 1))"
    head = f"if({code} > 0, {code}, 2)"
    made = f"concat(substr(x, 1, {head}), {_permuted_digits(f'substr(x, {head} + 1)', 'line', key)})"
    return _let(_bare(), f"if(length(x) between 8 and 15, {_let(made, _refill('x'))}, m)")


def _iban(key: str) -> str:
    """Country and letters stay, the account's digits are permuted, the check digits recomputed."""
    plain = "replace(m, ' ', '')"
    # the digits of the account, permuted in halves of at most 17 digits so that each fits a long
    digits = "regexp_replace(substr(x, 5), '[^0-9]', '')"
    first, rest = f"substr({digits}, 1, 15)", f"substr({digits}, 16)"
    mixed = f"concat({_permuted_digits(first, 'iban', key)}, if(length({rest}) > 0, {_permuted_digits(f'coalesce(nullif({rest}, {_text('')}), {_text('0')})', 'iban rest', key)}, ''))"
    filled = ("transform(array(<mixed>), d -> aggregate(split(substr(x, 5), ''), named_struct('t', '', 'i', 1), (s, c) -> if(c rlike '^[0-9]$',"
              " named_struct('t', concat(s.t, substr(d, s.i, 1)), 'i', s.i + 1), named_struct('t', concat(s.t, c), 'i', s.i)), s -> s.t))[0]").replace("<mixed>", mixed)
    checked = f"transform(array({filled}), b -> concat(substr(x, 1, 2), lpad(cast(98 - {_mod97('concat(b, substr(x, 1, 2), 0, 0)')} as string), 2, '0'), b))[0]"
    spaced = ("aggregate(split(m, ''), named_struct('t', '', 'i', 1), (s, c) -> if(c = ' ', named_struct('t', concat(s.t, c), 'i', s.i),"
              " named_struct('t', concat(s.t, substr(x, s.i, 1)), 'i', s.i + 1)), s -> s.t)")
    return _let(plain, f"if(length(x) between 15 and 34 and length({digits}) > 0 and {_mod97('concat(substr(x, 5), substr(x, 1, 4))')} = 1, {_let(checked, spaced)}, m)")


def pseudonym(key: str) -> str:
    """SQL for the pseudonym of a candidate ``m``; ``m`` itself if it isn't valid."""
    made = {"date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card, "iban": _iban, "line": _line}
    return "case " + " ".join(f"when {_like(kind)} then {make(key)}" for kind, make in made.items()) + " else m end"


def address(key: str) -> str:
    return f"concat('u', substr(sha2(concat_ws('|', {_text(key)}, 'address', lower(m)), 256), 1, 16), '@example.invalid')"


def _replace(text: str, pattern: str, made: str, when: str) -> str:
    """SQL struct(t, n): ``text`` with each match m replaced by ``made``, and how many changed."""
    p = _text(pattern)
    whole = _call(
        "transform(array(transform(regexp_extract_all(<t>, <p>, 0), m -> named_struct('o', m, 'p', <made>))), f -> named_struct("
        "'t', array_join(flatten(zip_with(split(<t>, <p>, -1), f, (a, b) -> array(a, coalesce(b.p, '')))), ''),"
        " 'n', size(filter(f, e -> e.o != e.p))))[0]", t=text, p=p, made=made)
    return f"if({when}, {whole}, named_struct('t', {text}, 'n', 0))"


def pseudonymise(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_private", *, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; ``count_col`` (unless None)
    holds how many values were replaced.  ``key`` is the secret that links equal
    values: keep it apart from the output, and the same for all of a corpus."""
    t = "`_text`"
    rest = [c for c in docs.columns if c not in (text_col, count_col)]
    held = docs.select(F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest") if rest else F.lit(None).alias("_rest"))
    mails = held.withColumn("_mail", F.expr(_replace(t, ADDRESS, address(key), f"coalesce(contains({t}, '@'), false)")))
    numbers = mails.withColumn("_number", F.expr(_replace("`_mail`.t", NUMBERS, pseudonym(key), f"coalesce(rlike(`_mail`.t, {_text(NUMBERS)}), false)")))
    columns: list[Column] = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("_number.t").alias(c))
        elif c != count_col:
            columns.append(F.col("_rest").getField(c).alias(c))
    if count_col:
        columns.append((F.col("_mail.n") + F.col("_number.n")).alias(count_col))
    return numbers.select(*columns)
