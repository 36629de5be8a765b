"""Format-preserving pseudonyms for personal data, with SQL functions only.

A value is found by pattern, validated (Luhn, mod 97, octets, calendar, area and exchange digits) and
written as a list of digits in mixed radix, each below its modulus.  A keyed Feistel network of
ROUNDS rounds adds to one half of the list a keystream (SHA-512 of key, kind, round and the other
half), modulo each digit's modulus: a permutation of exactly the values of that format.  So equal
values stay equal across documents, different values stay different, and valid ones stay valid.

Kinds: email (local part; a letter becomes a letter of its script's range, a digit a digit), iban and card (check
digits made anew), ip (version 4), date (1900 to 2099), ssn, phone (North American, with a country code, or with a
trunk 0 and a separated area code).  The formats' fixed parts (separators, domains, country, trunk 0, first card digit,
letters outside of the ranges) stay.  Not looked for: version 6 addresses, bare digits without a separator as phones,
names and postal addresses.

The key is written into the plan as a literal, which Spark's explain and event log show unless
spark.sql.redaction.string.regex matches it.

Texts are searched three times, so that a stretch which fails validation hides no smaller value: for all
kinds, with cards as they are grouped; in what failed, for all kinds but iban; in what is left, for cards of any grouping.

Cases: null texts stay null; texts without a value, and values that fail validation, stay as they
are; texts are used whole, and repeated rows stay repeated; other columns pass unread, whatever their names, but for one
that has the name asked for as output, which is replaced.  Any key is taken as it is, quotes and backslashes included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, table

ROUNDS = 8
KEY = "tidemark demonstration key"  # a parameter of every function here: production gives its own
KINDS = ("email", "iban", "card", "ip", "date", "ssn", "phone")

#: What each kind looks like (Java regular expressions), in order of preference.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?:(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}|(?<![0-9A-Za-z+.,/-])0[1-9][0-9]{1,4}[ /-][0-9]{5,8})(?![0-9A-Za-z])",
}
#: Cards in the groups that cards have; a last short group is one only if no other number follows.
GROUPED = "|".join(f"[0-9]{{4}}(?:{s}[0-9]{{4}}){{3}}TAIL|[0-9]{{4}}{s}[0-9]{{6}}{s}[0-9]{{4,5}}|[0-9]{{4}}{s}[0-9]{{4}}{s}[0-9]{{5}}".replace("TAIL", f"(?:{s}[0-9]{{1,3}}(?![ .-]?[0-9]))?") for s in " -")
_CARD = r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|" + GROUPED + ")(?![A-Za-z0-9])"
_BARE_CARD = r"(?<![A-Za-z0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![A-Za-z0-9])"
ANY = "|".join((PATTERNS | {"card": _CARD}).values())
AGAIN = "|".join(v for k, v in (PATTERNS | {"card": _BARE_CARD}).items() if k != "iban")
# A text without these holds none of the kinds.
HINT = r"@|[0-9][0-9]|[0-9][.][0-9]+[.][0-9]"

_DIGITS = "transform(filter(split(regexp_replace({m}, '[^0-9]', ''), ''), c -> c <> ''), c -> cast(c as bigint))"
# Sum of the digits, every second from the right doubled and reduced; the last digit counts once.
_LUHN = "aggregate(transform(reverse({d}), (x, i) -> if(i % 2 = 1, 2 * x - if(x > 4, 9, 0), x)), 0L, (a, x) -> a + x) % 10"
# Letters as 10 to 35, one character after the other, modulo 97.
_MOD97 = "aggregate(filter(split({s}, ''), c -> c <> ''), 0L, (a, c) -> if(c between '0' and '9', (a * 10 + ascii(c) - 48) % 97, (a * 100 + ascii(c) - 55) % 97))"
_CHARS = "filter(split({s}, ''), c -> c <> '')"
#: First code point and length of the ranges of digits and letters.
RANGES = (
    (0x30, 10), (0x61, 26), (0x41, 26), (0xC0, 23), (0xD8, 7), (0xE0, 23), (0xF8, 8), (0x100, 128), (0x391, 17), (0x3B1, 25), (0x410, 32), (0x430, 32),
    (0x5D0, 27), (0x621, 26), (0x641, 10), (0x3041, 86), (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
)
_BASE = "case " + " ".join(f"when ascii({{c}}) between {lo} and {lo + n - 1} then {lo}" for lo, n in RANGES) + " else ascii({c}) end"
_SIZE = "case " + " ".join(f"when ascii({{c}}) between {lo} and {lo + n - 1} then {n}L" for lo, n in RANGES) + " else 1L end"
_CLASS = "transform({c}, c -> " + _SIZE.format(c="c") + ")"
_ORDINALS = "transform({c}, c -> cast(ascii(c) - " + _BASE.format(c="c") + " as bigint))"
_CHAR = "if({n} < 128, char({n}), decode(unhex(lpad(hex({n}), 4, '0')), 'UTF-16BE'))"
_EMPTY = "cast(array() as array<bigint>)"
_DATES = ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy")
_DAY = "coalesce(" + ", ".join(f"cast(try_to_timestamp(m, '{f}') as date)" for f in _DATES) + ")"


def _feistel(values: str, moduli: str, tweak: str, key: str) -> str:
    half = f"(size({moduli}) div 2)"
    # The other half of an even round is the second one.
    other = f"array_join(if(r % 2 = 0, slice(v, {half} + 1, size(v) - {half}), slice(v, 1, {half})), ',')"
    said = f"concat_ws('|', {key}, {tweak}, cast(r as string), {other})"
    # One digest for each 16 places.
    stream = f"transform(sequence(0, cast((size(v) - 1) div 16 as int)), b -> sha2(concat({said}, if(b = 0, '', concat('|', cast(b as string)))), 512))"
    add = "cast(conv(substr(s[i div 16], cast(1 + (i % 16) * 8 as int), 8), 16, 10) as bigint)"
    turn = f"transform(v, (x, i) -> if((i < {half}) = (r % 2 = 0), (x + {add}) % {moduli}[i], x))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {values}, (v, r) -> transform(array({stream}), s -> {turn})[0])"


def _fill(m: str, digits: str) -> str:
    """m with its digits replaced in order."""
    at = f"length(regexp_replace(substr({m}, 1, j), '[^0-9]', ''))"
    return f"array_join(transform(sequence(1, length({m})), j -> if(substr({m}, j, 1) between '0' and '9', cast({digits}[{at} - 1] as string), substr({m}, j, 1))), '')"


def _spell(values: str, like: str) -> str:
    """Characters with the ordinals values in the ranges of the characters like."""
    shown = _CHAR.format(n=f"(x + {_BASE.format(c='c')})")
    return f"array_join(zip_with({values}, {like}, (x, c) -> if({_SIZE.format(c='c')} = 1, c, {shown})), '')"


def found(text: str, key: str = KEY) -> str:
    """SQL: the pieces of text, in order, each a struct of kind (null for text that is no valid value) and out."""
    digits = _DIGITS.format(m="m")
    kind = " ".join(f"when m rlike r'^(?:{p})$' then '{k}'" for k, p in PATTERNS.items())
    bare = "replace(m, ' ', '')"
    valid = f"""case kind
      when 'email' then true
      when 'iban' then {_MOD97.format(s=f"concat(substr({bare}, 5), substr({bare}, 1, 4))")} = 1
      when 'card' then {_LUHN.format(d=digits)} = 0 and {digits}[0] > 0
      when 'ip' then forall(split(m, '[.]'), o -> cast(o as int) <= 255)
      when 'date' then coalesce({_DAY} between date'1900-01-01' and date'2099-12-31', false)
      when 'ssn' then not (m rlike '^(000|666|9)|-00-|0000$')
      when 'phone' then size({digits}) between 7 and 15 end"""
    trunk, abroad = "m rlike '^0'", "m rlike '^[+](?!1[ .(-]|1[0-9]{10}$)'"
    country = f"if({abroad}, 2, if({trunk}, 1, size(d) - 10))"  # digits that stay: a country code, a trunk 0, or the North American 1
    # The first digit of a North American area or exchange is 2 at least, that of an area after a trunk 0 is 1 at least.
    least = f"if({trunk}, if(i = 0, 1, 0), if(not {abroad} and i in (0, 3), 2, 0))"
    local = "substring_index(m, '@', 1)"
    days = f"datediff({_DAY}, date'1900-01-01')"
    area = "cast(substr(m, 1, 3) as bigint)"
    values = f"""case kind
      when 'email' then {_ORDINALS.format(c=_CHARS.format(s=local))}
      when 'iban' then {_ORDINALS.format(c=_CHARS.format(s=f"substr({bare}, 5)"))}
      when 'card' then slice(d, 2, size(d) - 2)
      when 'ip' then transform(split(m, '[.]'), o -> cast(o as bigint))
      when 'date' then array(cast({days} div 229 as bigint), cast({days} % 229 as bigint))
      when 'ssn' then array({area} - if({area} > 666, 2, 1), cast(substr(m, 5, 2) as bigint) - 1, cast(substr(m, 8, 4) as bigint) - 1)
      when 'phone' then transform(slice(d, {country} + 1, size(d) - {country}), (x, i) -> if(x >= {least}, x - {least}, x))
      else {_EMPTY} end"""
    moduli = f"""case kind
      when 'email' then {_CLASS.format(c=_CHARS.format(s=local))}
      when 'iban' then {_CLASS.format(c=_CHARS.format(s=f"substr({bare}, 5)"))}
      when 'card' then array_repeat(10L, size(d) - 2)
      when 'ip' then array_repeat(256L, 4)
      when 'date' then array(319L, 229L)
      when 'ssn' then array(898L, 99L, 9999L)
      when 'phone' then transform(slice(d, {country} + 1, size(d) - {country}), (x, i) -> cast(if(x >= {least}, 10 - {least}, {least}) as bigint))
      else {_EMPTY} end"""
    tweak = "concat(kind, if(kind = 'email', lower(substring_index(m, '@', -1)), if(kind = 'iban', substr(m, 1, 2), if(kind = 'card', cast(d[0] as string), ''))))"
    new = _feistel("u", "w", tweak, f"decode(unhex('{key.encode().hex()}'), 'UTF-8')")
    body = "concat(array(d[0]), p)"
    card = f"concat({body}, array((10 - ({_LUHN.format(d=f'concat({body}, array(0L))')})) % 10))"
    bban = _spell("p", _CHARS.format(s=f"substr({bare}, 5)"))
    check = f"lpad(cast(98 - ({_MOD97.format(s=f'concat(b, substr(m, 1, 2), {chr(39)}00{chr(39)})')}) as string), 2, '0')"
    spaced = f"array_join(transform(sequence(1, length(m)), j -> if(substr(m, j, 1) = ' ', ' ', substr(t, length(replace(substr(m, 1, j), ' ', '')), 1))), '')"
    iban = f"transform(transform(array({bban}), b -> concat(substr(m, 1, 2), {check}, b)), t -> {spaced})[0]"
    day = "date_add(date'1900-01-01', cast(p[0] * 229 + p[1] as int))"
    out = f"""case kind
      when 'email' then concat({_spell("p", _CHARS.format(s=local))}, '@', substring_index(m, '@', -1))
      when 'iban' then {iban}
      when 'card' then {_fill("m", card)}
      when 'ip' then array_join(p, '.')
      when 'date' then case {" ".join(f"when m rlike '{r}' then date_format({day}, '{f}')" for r, f in zip(("^[0-9]{4}-", "^[0-9]{2}/", "^[0-9]{2}[.]"), _DATES, strict=True))} end
      when 'ssn' then concat_ws('-', lpad(cast(p[0] + if(p[0] >= 665, 2, 1) as string), 3, '0'), lpad(cast(p[1] + 1 as string), 2, '0'), lpad(cast(p[2] + 1 as string), 4, '0'))
      when 'phone' then {_fill("m", f"concat(slice(d, 1, {country}), transform(p, (x, i) -> if({least} > 0 and w[i] = 10 - {least}, x + {least}, x)))")}
      else m end"""
    # Each step names what the next one needs; lambda parameters stand for the fields.
    names = {"m": "z.m", "kind": "z.kind", "d": "z.d", "u": "z.u", "w": "z.w", "p": "z.p"}

    def step(over: str, **fields: str) -> str:
        return f"transform({over}, z -> named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {_rename(v, names)}' for k, v in fields.items())}))"

    def search(pieces: str, pattern: str, among: str) -> str:
        """The pieces x for which among holds, taken apart at the matches of pattern."""
        hits = f"transform(regexp_extract_all(x.m, r'{pattern}', 0), m -> named_struct('m', m, 'kind', case {kind} end, 'd', {digits}))"
        hits = step(hits, m="m", kind=f"if({valid}, kind, null)", hit="true")
        gap = "named_struct('m', g, 'kind', cast(null as string), 'hit', false)"
        parts = f"flatten(zip_with(split(x.m, r'{pattern}', -1), {hits}, (g, r) -> if(r is null, array({gap}), array({gap}, r))))"
        return f"flatten(transform({pieces}, x -> if(x.kind is null and {among}, {parts}, array(x))))"

    sql = f"array(named_struct('m', {text}, 'kind', cast(null as string), 'hit', false))"
    sql = search(sql, ANY, "true")
    sql = search(sql, AGAIN, "x.hit")
    sql = search(sql, PATTERNS["card"], f"x.m rlike r'{PATTERNS['card']}'")
    sql = step(sql, m="m", kind="kind", d=f"if(kind is null, {_EMPTY}, {digits})")
    sql = step(sql, m="m", kind="kind", d="d", u=values, w=moduli)
    sql = step(sql, m="m", kind="kind", d="d", w="w", p=f"if(kind is null, u, {new})")
    return step(sql, kind="kind", out=out)


def _rename(sql: str, names: dict[str, str]) -> str:
    """sql with free lambda names replaced, outside of quoted text and function names."""
    import re

    parts = re.split(r"('[^']*')", sql)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"(?<![\w.])(m|kind|d|u|w|p)(?![\w(])", lambda x: names[x[1]], parts[i])
    return "".join(parts)


def pseudonymise(docs: DataFrame, text: str = "text", out: str = "text", key: str = KEY, pieces: str | None = None) -> DataFrame:
    """docs with the column out, the text with pseudonyms, and where a name is given with the column pieces: the parts
    of a text that may hold values, each with kind and out."""
    source = f"cast(`{text}` as string)"
    name = pieces or free_name(docs, "pieces")
    marked = docs.withColumn(name, F.expr(f"if({source} rlike '{HINT}', {found(source, key)}, null)"))
    joined = f"array_join(transform(`{name}`, r -> r.out), '')"
    new = marked.withColumn(out, F.expr(f"if(size(`{name}`) > 0, {joined}, {source})"))
    return new if pieces else new.drop(name)


def count_of(kind: str | None = None, pieces: str = "pieces") -> Column:
    """How many values of the kind, or of any kind, were replaced."""
    test = "r.kind is not null" if kind is None else f"r.kind = '{kind}'"
    return F.expr(f"cast(coalesce(size(filter(`{pieces}`, r -> {test})), 0) as int)")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and the number of values of each kind."""
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces="pieces")
    return out.select("doc_id", "text", *(count_of(k).alias(f"n_{k}") for k in KINDS))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in their texts; n_chars follows the text."""
    del spark, sf_dir
    out = pseudonymise(docs)
    return out.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))
