"""Format-preserving pseudonyms: personal numbers, dates and addresses permuted under a key, in SQL functions only.

Every value that passes its format's check is permuted within that format by an alternating Feistel network over
two residues, so a pseudonym is valid again, equal values get equal pseudonyms in every document, and different
values different ones. The network's round function is SHA-256 of the key, the format, the round and the other half.

==========  =================================================  ==========================================
format      check                                              what is permuted
==========  =================================================  ==========================================
email       name of up to 64 @ domain, top level                   letters and digits of the name, by class
ip          four numbers up to 255                             the 32-bit address
phone       + and 8 to 15 digits                               the digits after the country code
ssn         3-2-4 digits, no reserved area or zero part        the index among valid numbers
card        13 to 19 digits with a right check digit,          all between the first and the check digit
            also next to other groups of digits
date        a day of the calendar, 1830 to 2129                the day within its hundred years
==========  =================================================  ==========================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Repetitions at most until a permuted day is beyond the 12th; each fails two times in five.
WALK = 100
#: What a value must look like; the first alternative that matches wins.
#: Names have at most 64 characters and hosts 127 labels; the bounds also keep the matcher's stack and work small.
_MAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}"
_ADDRESS = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_DAY = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9-])"
_NUMBER = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
#: Usual groups of a card; they go before all others inside a run of digits.
LAYOUTS = (
    "[0-9]{13,19}",
    "[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}",
    "[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
    "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4}",
)
#: What ends a run of digits at a blank, as it is a value of its own.
_OTHER = "|".join((_MAIL, _ADDRESS, _DAY, _NUMBER))
_CARDS = "(?:" + "|".join(LAYOUTS) + ")(?![0-9])"
_NEXT = rf"(?:\)?(?:[.-]| (?!{_OTHER}|{_CARDS}))?\(?[0-9])"
_GROUPED = rf"(?:[0-9]|(?:\)?(?:[.-]| (?!{_OTHER}|{_CARDS}))\(?|[()])[0-9](?=[0-9]))"
EMAIL = rf"(?<![A-Za-z0-9._%+-]){_MAIL}"
IP = rf"(?<![0-9.]){_ADDRESS}"
#: Countries whose numbers have one length take that many digits; others the most groups of up to 15 digits.
PHONE = (
    rf"\+(?:(?:[17]|44|91){_NEXT}{{10}}|(?:31|33|34|41|48|61){_NEXT}{{9}}|(?:45|47|65){_NEXT}{{8}})(?![0-9])"
    r"|\+(?=[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{2})"
    rf"[0-9]{_GROUPED}{{7,14}}(?![0-9])"
)
DATE = rf"(?<![0-9.-]){_DAY}"
SSN = rf"(?<![0-9-]){_NUMBER}"
#: The whole run of digit groups; the cards are looked for inside.
CARD = rf"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?:(?: (?!{_OTHER})|-)[0-9]++)*+"
ANY = "|".join((EMAIL, IP, PHONE, DATE, SSN, CARD))
KINDS = ("email", "ip", "phone", "date", "ssn", "card")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(kind: str, left: str, right: str, a: str, b: str) -> str:
    """SQL of ``struct<l, r>``: l in 0..a-1 and r in 0..b-1 permuted. ``key`` is a column of the query."""
    draw = (
        f"cast(conv(substring(sha2(concat_ws('|', llm_key, '{kind}', {{m}}, i, {{x}}), 256), 1, 15), 16, 10) as bigint)"
    )
    odd = draw.format(m="s.a", x="s.r")
    even = draw.format(m="s.b", x="s.l")
    return f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint), 'a', cast({a} as bigint), 'b', cast({b} as bigint)),
        (s, i) -> if(i % 2 = 1,
            named_struct('l', (s.l + {odd}) % s.a, 'r', s.r, 'a', s.a, 'b', s.b),
            named_struct('l', s.l, 'r', (s.r + {even}) % s.b, 'a', s.a, 'b', s.b)))"""


def _let(name: str, value: str, body: str) -> str:
    """SQL that binds ``value`` to ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digits_into(shape: str, digits: str) -> str:
    """SQL of ``shape`` with its digits replaced by ``digits`` one after the other."""
    count = f"length(regexp_replace(substring({shape}, 1, p + 1), '[^0-9]', ''))"
    return (
        f"array_join(transform(split({shape}, ''), (c, p) -> "
        f"if(c >= '0' and c <= '9', substring({digits}, {count}, 1), c)), '')"
    )


def _permuted_digits(kind: str, digits: str) -> str:
    """SQL of a string of up to 36 digits permuted among the strings of its length."""
    halves = "cast(length(d) div 2 as int)"
    power = "cast(concat('1', repeat('0', {})) as bigint)"
    right = f"length(d) - {halves}"
    left_value = f"cast(concat('0', substring(d, 1, {halves})) as bigint)"
    right_value = f"cast(concat('0', substring(d, {halves} + 1)) as bigint)"
    run = _feistel(kind, left_value, right_value, power.format(halves), power.format(right))
    joined = (
        f"concat(if({halves} > 0, lpad(cast(f.l as string), {halves}, '0'), ''), lpad(cast(f.r as string), {right}, '0'))"
    )
    return _let("d", digits, _let("f", run, joined))


def _email() -> str:
    """Name characters shifted within their class, half by half, by digests of the other half."""
    shift = (
        "cast(conv(substring(sha2(concat_ws('|', llm_key, 'email', i, p div 16, {other}), 256), 1 + 4 * (p % 16), 4), 16, 10) as int)"
    )

    def moved(own: str, other: str) -> str:
        k = shift.format(other=other)
        return f"""array_join(transform(split({own}, ''), (c, p) -> case
            when c >= '0' and c <= '9' then chr(48 + (ascii(c) - 48 + {k}) % 10)
            when c >= 'a' and c <= 'z' then chr(97 + (ascii(c) - 97 + {k}) % 26)
            when c >= 'A' and c <= 'Z' then chr(65 + (ascii(c) - 65 + {k}) % 26)
            else c end), '')"""

    run = f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('l', substring(n, 1, cast(length(n) div 2 as int)), 'r', substring(n, cast(length(n) div 2 as int) + 1)),
        (s, i) -> if(i % 2 = 1,
            named_struct('l', if(s.l = '', '', {moved('s.l', 's.r')}), 'r', s.r),
            named_struct('l', s.l, 'r', {moved('s.r', 's.l')})),
        s -> concat(s.l, s.r))"""
    return f"concat({_let('n', 'substring_index(m, chr(64), 1)', run)}, '@', substring_index(m, chr(64), -1))"


def _ip() -> str:
    part = lambda k: f"cast(split(m, '[.]')[{k}] as int)"
    run = _feistel("ip", f"{part(0)} * 256 + {part(1)}", f"{part(2)} * 256 + {part(3)}", "65536", "65536")
    return _let("f", run, "concat_ws('.', f.l div 256, f.l % 256, f.r div 256, f.r % 256)")


def _phone() -> str:
    """The country code is the first group, or one digit where no separator follows."""
    head = r"if(m rlike '^\\+[0-9]{1,3}[ .(-]', regexp_extract(m, '^\\+[0-9]{1,3}', 0), substring(m, 1, 2))"
    rest = "substring(m, length(h) + 1)"
    return _let("h", head, f"concat(h, {_let('x', rest, _digits_into('x', '(' + _permuted_digits('phone', _digits('x')) + ')'))})")


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _check_sum(digits: str, first: int) -> str:
    """SQL of the Luhn sum of ``digits`` read from the right; ``first`` is 1 where the last digit is doubled."""
    return f"""aggregate(transform(split(reverse({digits}), ''), (c, p) ->
        if((p + {first}) % 2 = 1, if(cast(c as int) > 4, cast(c as int) * 2 - 9, cast(c as int) * 2), cast(c as int))), 0, (t, x) -> t + x)"""


def _cards_in() -> str:
    """SQL of the cards in the run of digit groups ``m``: all with usual groups, or else the longest prefix or suffix."""
    valid = lambda found: f"filter({found}, v -> v <> '' and {_check_sum(_digits('v'), 0)} % 10 = 0)"
    each = ", ".join(f"regexp_extract_all(m, '(?<![0-9])(?=({x})(?![0-9]))', 1)" for x in LAYOUTS)
    run = "'[0-9](?:[ -]?[0-9]){', n, '}'"
    prefix = f"regexp_extract(m, concat('^', {run}, '(?![0-9])'), 0)"
    suffix = f"regexp_extract(m, concat('(?<![0-9])', {run}, '$'), 0)"
    ends = valid(f"flatten(array({', '.join(f'transform(sequence(18, 12, -1), n -> {x})' for x in (prefix, suffix))}))")
    return f"""if(length(m) >= 13 and m rlike '^[0-9 -]+$',
        {_let('u', valid(f"flatten(array({each}))"), f"if(size(u) > 0, u, slice({ends}, 1, 1))")},
        cast(array() as array<string>))"""


def _cards() -> str:
    """The run ``m`` with its cards, the values ``w``, replaced. They hold digits, blanks and dashes only."""
    hits = f"transform(regexp_extract_all(m, e, 0), m -> {_card()})"
    whole = f"array_join(zip_with(split(m, e, -1), {hits}, (gap, hit) -> concat(gap, coalesce(hit, ''))), '')"
    return _let("e", _one_of_cards(), whole)


def _one_of_cards() -> str:
    return "concat('(?<![0-9])(?:', array_join(w, '|'), ')(?![0-9])')"


def _card() -> str:
    middle = _permuted_digits("card", "substring(o, 2, length(o) - 2)")
    body = _let("y", f"concat(substring(o, 1, 1), {middle})", f"concat(y, cast((10 - {_check_sum('y', 1)} % 10) % 10 as string))")
    return _let("o", _digits("m"), _let("z", body, _digits_into("m", "z")))


def _ssn() -> str:
    area = "cast(substring(m, 1, 3) as int)"
    left = f"({area} - if({area} > 666, 2, 1)) * 99 + cast(substring(m, 5, 2) as int) - 1"
    run = _feistel("ssn", left, "cast(substring(m, 8, 4) as int) - 1", "88902", "9999")
    number = "f.l div 99 + if(f.l div 99 >= 665, 2, 1)"
    return _let(
        "f",
        run,
        f"concat(lpad(cast({number} as string), 3, '0'), '-', lpad(cast(f.l % 99 + 1 as string), 2, '0'), '-', "
        "lpad(cast(f.r + 1 as string), 4, '0'))",
    )


def _slashed(day_first: bool) -> str:
    """SQL of the date of ``m`` with slashes, or null."""
    parts = "split(m, '/')"
    month, day = (1, 0) if day_first else (0, 1)
    return f"try_to_date(concat_ws('-', {parts}[2], {parts}[{month}], {parts}[{day}]), 'yyyy-MM-dd')"


DAY_FIRST = f"(m rlike '/' and {_slashed(False)} is null)"


def _iso() -> str:
    """SQL of the date: year first with dashes, day first with dots, month first with slashes unless it can't be.

    Null if the calendar has no such day.
    """
    parts = "split(m, '[.]')"
    return f"""case when m rlike '-' then try_to_date(m, 'yyyy-MM-dd')
        when m rlike '[.]' then try_to_date(concat_ws('-', {parts}[2], {parts}[1], {parts}[0]), 'yyyy-MM-dd')
        else coalesce({_slashed(False)}, {_slashed(True)}) end"""


def _date() -> str:
    """The day's index within its hundred years from 1830, 1930 or 2030, a product of two residues.

    A day first with slashes is read so only beyond the 12th, so the permutation is repeated until it gives such
    a day: still a permutation, and no pseudonym reads as another date's.
    """
    first = "make_date(cast(1830 + 100 * ((year(v) - 1830) div 100) as int), 1, 1)"
    # Blocks that hold 1900 or 2100 have 24 leap years: 36,524 = 92 * 397 days; the other 25: 36,525 = 75 * 487.
    a = "if(year(v) between 1930 and 2029, 75, 92)"
    b = "if(year(v) between 1930 and 2029, 487, 397)"
    index = f"datediff(v, {first})"
    run = _feistel("date", f"{index} div {b}", f"{index} % {b}", a, b)
    made = _let("f", run, f"date_add({first}, cast(f.l * {b} + f.r as int))")
    walk = f"aggregate(sequence(1, {WALK}), v, (v, n) -> if(n > 1 and day(v) > 12, v, {made}))"
    shown = f"""case when m rlike '-' then date_format(w, 'yyyy-MM-dd')
        when m rlike '[.]' then date_format(w, 'dd.MM.yyyy')
        when {DAY_FIRST} then date_format(w, 'dd/MM/yyyy') else date_format(w, 'MM/dd/yyyy') end"""
    return _let("v", _iso(), _let("w", f"if({DAY_FIRST}, {walk}, {made})", shown))


def _kind() -> str:
    """SQL of the format whose check ``m`` passes, or null."""
    ssn_area = "cast(substring(m, 1, 3) as int)"
    return f"""case
        when instr(m, '@') > 0 then 'email'
        when substring(m, 1, 1) = '+' then if(length({_digits('m')}) between 8 and 15, 'phone', null)
        when m rlike '^([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}$' then
            if(forall(split(m, '[.]'), x -> cast(x as int) <= 255), 'ip', null)
        when m rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' or m rlike '^[0-9]{{2}}[./][0-9]{{2}}[./][0-9]{{4}}$' then
            if(year({_iso()}) between 1830 and 2129, 'date', null)
        when m rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then
            if({ssn_area} between 1 and 899 and {ssn_area} <> 666 and substring(m, 5, 2) <> '00' and substring(m, 8, 4) <> '0000', 'ssn', null)
        when size(w) > 0 then 'card'
        end"""


def replacements(key: str) -> Column:
    """For the values in the column ``llm_found``: structs of the format (null if the check fails), how often it is there, and the new value."""
    llm_key = _quoted(key)
    value = f"""case k when 'email' then {_email()} when 'ip' then {_ip()} when 'phone' then {_phone()}
        when 'date' then {_date()} when 'ssn' then {_ssn()} when 'card' then {_cards()} else m end"""
    times = f"if(k = 'card', size(regexp_extract_all(m, {_one_of_cards()}, 0)), 1)"
    hit = f"named_struct('kind', k, 'times', {times}, 'value', {value})"
    found = _let("w", _cards_in(), _let("k", _kind(), hit))
    return F.expr(f"transform(llm_found, m -> {found})".replace("llm_key", llm_key))


def pseudonymise_documents(docs: DataFrame, key: str = "corpus", text_col: str = "text", kinds_col: str | None = None) -> DataFrame:
    """``docs`` with personal values in ``text_col`` replaced; with ``kinds_col``, also the formats replaced there.

    All rows and other columns stay as they are, also those whose names clash with anything here; a null text
    stays null, an empty one empty; an empty table gives no rows. Keep ``key`` secret: whoever has it can undo
    the pseudonyms. Values that fail their format's check are left alone. Time grows with the text's length.
    """
    own = {c: f"llm_column_{k}" for k, c in enumerate(docs.columns)}
    inner = docs.toDF(*own.values())
    text = F.col(own[text_col])
    some = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    pattern = F.lit(ANY)
    nothing = F.array().cast("array<string>")
    found = inner.withColumn("llm_found", F.when(some, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(nothing))
    found = found.withColumn("llm_replaced", replacements(key))
    gaps = F.split(text, ANY, -1)
    whole = F.array_join(
        F.zip_with(gaps, F.col("llm_replaced"), lambda gap, hit: F.concat(gap, F.coalesce(hit["value"], F.lit("")))), ""
    )
    changed = F.when(F.size("llm_found") > 0, whole).otherwise(text)
    columns = [changed.alias(c) if c == text_col else F.col(own[c]).alias(c) for c in docs.columns]
    if kinds_col is not None:
        passed = F.filter("llm_replaced", lambda hit: hit["kind"].isNotNull())
        kinds = F.flatten(F.transform(passed, lambda hit: F.array_repeat(hit["kind"], hit["times"])))
        columns.append(kinds.alias(kinds_col))
    return found.select(*columns)
