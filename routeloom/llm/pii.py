"""Personal data replaced by keyed surrogates, in column expressions only.

Entities are found by one pattern. Each is rewritten character by character: a letter is
moved within its own alphabet and case, a digit within the digits, by an amount drawn from
SHA-256 of a secret key, the kind of entity and all characters before it; then once more
from right to left, so that every character depends on all others. Either pass can be
undone, so two entities of one kind and shape never meet in one surrogate, and an entity
has the same surrogate wherever it stands. Only what identifies counts for the amount:
case, and the marks between digits, are kept but not drawn from, so spellings of one
entity stay spellings of one surrogate. Numbers with a check digit get a right one; parts
of an address stay below 256; names move within a list of their script and gender.

A name found once in a text is replaced wherever else its words stand in that text. What
the passes cannot promise, such as a listed and an unlisted name that meet, is looked for
over the distinct entities of the whole table, and drawn again until all are told apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# --- fixed values: patterns and alphabets -------------------------------------------------
# Kinds in the order in which they are tried at a place in the text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9_%+.-])[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}",
    "secret": r"(?<![A-Za-z0-9])(?:(?i:password|passwd|pwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?)[A-Za-z0-9_+/=.-]{6,}",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![0-9.-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])|(?<![0-9.-])[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?![0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?!(?:[0-9A-Fa-f]*:){9})(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![0-9A-Za-z:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9A-Za-z])\+[0-9]{8,15}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+(?=(?:[ ./-]?[0-9]){8,15}(?![0-9]))[0-9]{1,3}(?:[ ./-]?[0-9]{1,4}){2,6}(?![0-9])"
    r"|(?<![0-9A-Za-z])0[0-9](?:[ .-][0-9]{2}){4}(?![0-9])|(?<![0-9A-Za-z])[6-9][0-9]{2}(?: [0-9]{2}){3}(?![0-9])"
    r"|(?<![0-9A-Za-z/])0[0-9]{1,5} ?/ ?(?=(?:[ -]?[0-9]){5})[0-9]{2,4}(?:[ -]?[0-9]{1,4}){1,3}(?![0-9/])",
    "name": r"(?=\p{Lu})(?<=\b(?:Mr|Mrs|Ms|Dr|Mr\.|Mrs\.|Ms\.|Dr\.|Herr|Frau|Monsieur|Madame|Señor|Señora|господин|госпожа) )\p{Lu}(?:\p{L}|['’-](?=\p{L})(?!s(?!\p{L})))+(?: \p{Lu}(?:\p{L}|['’-](?=\p{L})(?!s(?!\p{L})))+){0,2}",
}
# What does not tell entities apart.
MARKS = r"[^\p{L}\p{N}]"
ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "äöüßàâçéèêëîïôûùñáíóú", "ÄÖÜÀÂÇÉÈÊËÎÏÔÛÙÑÁÍÓÚ",
    "ąćęłńśźżčďěňřšťůýžőű", "ĄĆĘŁŃŚŹŻČĎĚŇŘŠŤŮÝŽŐŰ",
)
# Given names by script and gender; a name moves within its own list.
NAMES = (
    ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Pierre", "Carlos", "Juan"),
    ("Mary", "Anna", "Linda", "Susan", "Sarah", "Laura", "Julia", "Maria", "Claire", "Sophie", "Carmen", "Lucia"),
    ("Иван", "Пётр", "Алексей", "Сергей", "Дмитрий", "Андрей"),
    ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Ирина"),
)
# ------------------------------------------------------------------------------------------

# Draws for entities whose surrogates meet, and for those that equal theirs, the first included.
DRAWS, SAME_DRAWS = 16, 4

_ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# Every text with an entity holds this, which is quickly looked for.
_HINT = "[0-9@=:]|Mrs?|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|господин|госпожа"


_ALL = "".join(ALPHABETS)
_SECRET_HEAD = r"^((?i:password|passwd|pwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?)"
_PHONE_HEAD = r"^(\+[0-9]{1,3}(?=[^0-9])|\+|)"
_DOMAIN_END = r"(?i)((?:\.?example)?\.[a-z]+)$"


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _draw(key: str, seen: str) -> str:
    """A number from the key and what was seen."""
    return f"cast(conv(substr(sha2(concat({key}, {seen}), 256), 1, 8), 16, 10) AS BIGINT)"


def _pass(text: str, key: str) -> str:
    """Every character moved within its alphabet by a draw from the letters and digits before it."""
    starts, sizes, low = [], [], 1
    for alphabet in ALPHABETS:
        starts.append(f"WHEN at < {low + len(alphabet)} THEN {low}")
        sizes.append(f"WHEN at < {low + len(alphabet)} THEN {len(alphabet)}")
        low += len(alphabet)
    start, size = f"CASE {' '.join(starts)} END", f"CASE {' '.join(sizes)} END"
    to = f"cast({start} + pmod(at - {start} + {_draw(key, 'state.seen')}, {size}) AS INT)"
    moved = _let(f"instr({_text(_ALL)}, char)", "at", f"if(at = 0, char, substr({_text(_ALL)}, {to}, 1))")
    counted = f"regexp_replace(lower(char), {_text(MARKS)}, '')"
    return (
        f"aggregate(split({text}, ''), named_struct('seen', '', 'made', ''), (state, char) -> "
        f"named_struct('seen', concat(state.seen, {counted}), 'made', concat(state.made, {moved})), "
        "state -> state.made)"
    )


def _shuffled(text: str, key: str) -> str:
    """Both passes."""
    ahead = _pass(text, f"concat({key}, 'ahead/')")
    behind = _pass(f"reverse({ahead})", f"concat({key}, 'back/')")
    return f"reverse({behind})"


def _luhn(digits: str) -> str:
    """The check digit of a number without one."""
    value = "cast(digit AS INT)"
    doubled = f"if({value} > 4, {value} * 2 - 9, {value} * 2)"
    return (
        f"pmod(10 - aggregate(split(reverse({digits}), ''), named_struct('at', 0, 'sum', 0), (state, digit) -> "
        f"named_struct('at', state.at + 1, 'sum', state.sum + if(state.at % 2 = 1, {value}, {doubled})), "
        "state -> state.sum) % 10, 10)"
    )


def _kind(entity: str) -> str:
    """The first kind whose pattern matches the whole entity.

    What stands around an entity was looked at when it was found; a name, which is known
    by what stands before it, is what no other kind matches.
    """
    cases = [
        f"WHEN {entity} RLIKE {_text(f'^(?:{pattern})$')} THEN '{kind}'"
        for kind, pattern in PATTERNS.items() if kind != "name"
    ]
    return f"CASE {' '.join(cases)} ELSE 'name' END"


def _plain(address: str) -> str:
    """An IPv4 address without leading zeros."""
    return f"array_join(transform(split({address}, '[.]'), part -> cast(cast(part AS BIGINT) AS STRING)), '.')"


def _address(entity: str, key: str) -> str:
    """An IPv4 address without leading zeros: each part moved below 256 by what stands before
    it, and the first once more by the others, so that the whole can be undone."""
    entity = _plain(entity)
    one = f"cast(pmod(cast(part AS BIGINT) + {_draw(key, 'state.seen')}, 256) AS STRING)"
    moved = (
        f"aggregate(split({entity}, '[.]'), named_struct('seen', '', 'made', cast(array() AS ARRAY<STRING>)), "
        f"(state, part) -> named_struct('seen', concat_ws('.', state.seen, part), "
        f"'made', array_append(state.made, {one})), state -> state.made)"
    )
    rest = "array_join(slice(parts, 2, 3), '.')"
    drawn = _draw(f"concat({key}, 'head/')", rest)
    first = f"cast(pmod(cast(parts[0] AS BIGINT) + {drawn}, 256) AS STRING)"
    return _let(moved, "parts", f"concat({first}, '.', {rest})")


def _address6(entity: str, key: str) -> str:
    """An IPv6 address in its long form, all hexadecimal digits moved both ways; spellings
    of one address have one surrogate."""
    def groups(text: str) -> str:
        return f"filter(split({text}, ':'), part -> part <> '')"

    head, rest = (groups(f"substring_index({entity}, '::', {at})") for at in (1, -1))
    tail = f"if(instr({entity}, '::') > 0, {rest}, cast(array() AS ARRAY<STRING>))"
    filled = f"concat({head}, array_repeat('0', 8 - size({head}) - size({tail})), {tail})"
    digits = f"array_join(transform({filled}, part -> lpad(lower(part), 4, '0')), '')"

    def moved(text: str, own: str) -> str:
        to = f"cast(pmod(instr('0123456789abcdef', char) - 1 + {_draw(own, 'state.seen')}, 16) AS INT) + 1"
        return (
            f"aggregate(split({text}, ''), named_struct('seen', '', 'made', ''), (state, char) -> named_struct("
            f"'seen', concat(state.seen, char), 'made', concat(state.made, substr('0123456789abcdef', {to}, 1))), "
            "state -> state.made)"
        )

    ahead = moved(digits, f"concat({key}, 'ahead/')")
    both = moved(f"reverse({ahead})", f"concat({key}, 'back/')")
    return _let(both, "nibbles", "array_join(transform(sequence(1, 29, 4), at -> substr(nibbles, at, 4)), ':')")


def _card(entity: str, moved: str) -> str:
    """A card number from its moved digits: the check digit is made right, or wrong by as
    much as it was; separators stay where they are."""
    digits = f"regexp_replace({entity}, '[^0-9]', '')"
    off = f"cast(right({entity}, 1) AS INT) - {_luhn(f'left({digits}, length({digits}) - 1)')}"
    whole = f"concat({moved}, cast(pmod({_luhn(moved)} + {off}, 10) AS STRING))"
    spread = (
        f"aggregate(split({entity}, ''), named_struct('at', 1, 'made', ''), (state, char) -> named_struct("
        "'at', state.at + if(char RLIKE '[0-9]', 1, 0), "
        "'made', concat(state.made, if(char RLIKE '[0-9]', substr(whole, state.at, 1), char))), "
        "state -> state.made)"
    )
    return _let(whole, "whole", spread)


def _mod97(text: str) -> str:
    """The remainder by 97 of letters and digits, letters as 10 to 35."""
    return (
        f"aggregate(split({text}, ''), 0, (sum, char) -> if(char RLIKE '[0-9]', (sum * 10 + cast(char AS INT)) % 97, "
        "(sum * 100 + ascii(char) - 55) % 97))"
    )


def _iban(entity: str, moved: str) -> str:
    """An IBAN from its country and moved account, spaces included: the check digits are made
    right, or wrong by as much as they were."""
    def check(account: str) -> str:
        plain = f"regexp_replace({account}, '[^A-Z0-9]', '')"
        return f"(98 - {_mod97(f'concat({plain}, left({entity}, 2), {_text(chr(48) * 2)})')})"

    off = f"cast(substr({entity}, 3, 2) AS INT) - {check(f'substr({entity}, 5)')}"
    digits = f"2 + pmod({check('account')} + {off} - 2, 97)"
    whole = f"concat(left({entity}, 2), lpad(cast({digits} AS STRING), 2, '0'), account)"
    return _let(f"substr({moved}, 3)", "account", whole)


def _listed(word: str, key: str) -> str:
    """The surrogate of a name of the lists, null for other names."""
    cases = []
    for names in NAMES:
        every = f"array({', '.join(map(_text, names))})"
        step = f"1 + pmod({_draw(key, _text(names[0]))}, {len(names) - 1})"
        to = f"cast(pmod(array_position({every}, {word}) - 1 + {step}, {len(names)}) AS INT) + 1"
        cases.append(f"WHEN array_contains({every}, {word}) THEN element_at({every}, {to})")
    return f"CASE {' '.join(cases)} END"


def surrogate_sql(entity: str, key: str) -> str:
    """SQL for the surrogate of a detected entity.

    An entity is a list of parts, some kept, some moved under a key of their own: of an
    email the name and the domain move and the last label stays, with ``example`` before
    it, since such domains are nobody's; a secret's own word, the first letters of an
    access key and an IBAN, and a country code stay.
    """
    def part(text: str, name: str | None) -> str:
        own = f"concat({_text(key)}, {name})" if name else "''"
        return f"named_struct('key', {own}, 'text', {text}, 'moved', {'true' if name else 'false'})"

    def headed(head: str, kind: str) -> str:
        rest = f"substr({entity}, length({head}) + 1)"
        return f"array({part(head, None)}, {part(rest, _text(f'/{kind}/'))})"

    domain = f"substring_index({entity}, '@', -1)"
    ending = f"regexp_extract({domain}, {_text(_DOMAIN_END)}, 1)"
    label = f"left({domain}, length({domain}) - length({ending}))"
    name = f"substring_index({entity}, '@', 1)"
    digits = f"regexp_replace({entity}, '[^0-9]', '')"
    listed = _listed("word", _text(f"{key}/listed/"))
    parts = f"""CASE kind
        WHEN 'email' THEN array({part(name, f"concat('/email/', lower({domain}), '/')")}, {part("'@'", None)},
            {part(label, "'/domain/'")}, {part(ending, None)})
        WHEN 'secret' THEN {headed(f"regexp_extract({entity}, {_text(_SECRET_HEAD)}, 1)", "secret")}
        WHEN 'access_key' THEN {headed(f"left({entity}, 4)", "access_key")}
        WHEN 'iban' THEN array({part(f"left({entity}, 2)", None)}, {part(f"substr({entity}, 5)", "'/iban/'")})
        WHEN 'phone' THEN {headed(f"regexp_extract({entity}, {_text(_PHONE_HEAD)}, 1)", "phone")}
        WHEN 'card' THEN array({part(f"left({digits}, length({digits}) - 1)", "'/card/'")})
        WHEN 'name' THEN transform(split({entity}, ' '), word -> named_struct(
            'key', {_text(key + "/name/")}, 'text', coalesce({listed}, word), 'moved', {listed} IS NULL))
        ELSE array({part(entity, "concat('/', kind, '/')")}) END"""
    moved = f"transform({parts}, part -> if(part.moved, {_shuffled('part.text', 'part.key')}, part.text))"
    joined = f"array_join({moved}, if(kind = 'name', ' ', ''))"
    checked = f"CASE kind WHEN 'card' THEN {_card(entity, 'made')} WHEN 'iban' THEN {_iban(entity, 'made')} ELSE made END"
    made = _let(joined, "made", checked)
    address, address6 = _address(entity, _text(f"{key}/ip/")), _address6(entity, _text(f"{key}/ip6/"))
    return _let(_kind(entity), "kind", f"CASE kind WHEN 'ip' THEN {address} WHEN 'ip6' THEN {address6} ELSE {made} END")


def entities(text: Column) -> Column:
    """The entities of a text, in order, repeated ones repeated."""
    return F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))


def _named(found: Column) -> Column:
    """The pattern of all entities of a text: names among ``found`` also where their words
    stand without a title."""
    names = F.filter(found, lambda entity: entity.rlike(r"^\p{Lu}[\p{L}'’ -]+$"))
    words = F.array_distinct(F.flatten(F.transform(names, lambda name: F.split(name, " "))))
    # words hold letters, apostrophes and hyphens only, none of which means something here
    again = F.concat(
        F.lit(_ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    return F.when(F.size(words) > 0, again).otherwise(F.lit(_ANY))


def replaced(text: Column, pattern: Column, made: Column) -> Column:
    """The text with each match of the pattern replaced by what was made of it."""
    between = F.split(text, pattern, -1)
    return F.array_join(
        F.transform(between, lambda part, at: F.concat(part, F.coalesce(F.get(made, at), F.lit("")))), ""
    )


def _found(docs: DataFrame, column: str, pattern: str, own: str) -> DataFrame:
    """``docs`` with the pattern of each text in a column and its entities in another, both
    null where there are none."""
    text = F.col(column)
    titled = F.when(text.rlike(_HINT), entities(text))
    return (
        docs.select("*", titled.alias(own))
        .withColumn(pattern, F.when(F.size(own) > 0, _named(F.col(own))))
        .withColumn(own, F.regexp_extract_all(text, F.col(pattern), F.lit(0)))
    )


def pseudonymized(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``column`` replaced, all other columns as they are.

    Null and empty texts stay as they are; texts without entities do not change. Equal
    entities have equal surrogates in every row, and different ones different surrogates (see
    ``redrawn``). The distinct entities of all texts are shuffled; texts are only where they
    hold an entity that was drawn again.
    """
    pattern, own, again, mark = (f"_{name}_{uuid.uuid4().hex}" for name in ("pattern", "entities", "again", "mark"))
    others = redrawn(surrogates(docs, key, column), key)
    marked = _found(docs, column, pattern, own)
    made = surrogate_sql("entity", key)
    if others is not None:
        changed = F.sha2(F.col(column), 256)
        texts = (
            marked.filter(F.size(own) > 0).select(changed.alias(mark), F.explode(F.array_distinct(own)).alias("entity"))
            .distinct().join(others, "entity")
            .groupBy(mark).agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias(again))
        )
        marked = marked.withColumn(mark, F.when(F.size(own) > 0, changed)).join(texts, mark, "left")
        made = f"coalesce({again}[entity], {made})"
    text = F.when(
        F.size(own) > 0, replaced(F.col(column), F.col(pattern), F.expr(f"transform({own}, entity -> {made})"))
    ).otherwise(F.col(column))
    return marked.select(*[text.alias(name) if name == column else F.col(name) for name in docs.columns])


def surrogates(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """The distinct entities of ``docs`` with kind and surrogate."""
    texts = docs.select(F.col(column).alias("text"))
    return (
        _found(texts, "text", "pattern", "found").select(F.explode("found").alias("entity")).distinct()
        .select(
            F.expr(_kind("entity")).alias("kind"), "entity",
            F.expr(surrogate_sql("entity", key)).alias("surrogate"),
        )
    )


def _identity() -> str:
    """What spellings of one address have in common; other entities as they stand."""
    # all spellings of an IPv6 address share one surrogate, and no other address has it
    return f"CASE kind WHEN 'ip' THEN {_plain('entity')} WHEN 'ip6' THEN concat('ip6/', surrogate) ELSE entity END"


def collisions(pairs: DataFrame) -> DataFrame:
    """Surrogates that two different entities of ``pairs`` share, or that equal their entity.

    Spellings of one IP address are one entity; others are told apart as they stand, so an
    empty result proves distinctness. ``entity`` is the smallest, ``n`` the number of all.
    """
    shared = pairs.withColumn("identity", F.expr(_identity())).groupBy("surrogate").agg(
        F.count_distinct("identity").alias("n"), F.min("identity").alias("first"),
        F.min("entity").alias("entity"), F.bool_or(F.col("entity") == F.col("surrogate")).alias("same"),
    )
    return shared.filter((F.col("n") > 1) | F.col("same"))


def redrawn(pairs: DataFrame, key: str) -> DataFrame | None:
    """Entity and surrogate of those of ``pairs`` (see ``surrogates``) that needed another
    draw; none if all are told apart at once.

    Of the entities that share a surrogate the smallest keeps it; the others, and those that
    equal their surrogate, are drawn again under a key with the number of the draw, until
    nothing meets. Where a kind has so few surrogates that ``DRAWS`` draws do not part the
    entities (two-letter names that are nearly all taken), the last draw stays. What equals its
    surrogate after ``SAME_DRAWS`` has no letter or digit that moves, and stays too.
    """
    pairs = stored(pairs.withColumn("drawn", F.lit(False)), "surrogates")
    for draw in range(1, DRAWS):
        same = (F.col("entity") == F.col("surrogate")) & F.lit(draw < SAME_DRAWS)
        shared = collisions(pairs).filter((F.col("n") > 1) | F.lit(draw < SAME_DRAWS))
        if shared.isEmpty():
            break
        other = same | F.coalesce(F.expr(_identity()) != F.col("first"), F.lit(False))
        made = F.when(F.col("other"), F.expr(surrogate_sql("entity", f"{key}/draw {draw}")))
        pairs = stored(
            pairs.join(shared.select("surrogate", "first"), "surrogate", "left").withColumn("other", other).select(
                "kind", "entity", made.otherwise(F.col("surrogate")).alias("surrogate"),
                (F.col("drawn") | F.col("other")).alias("drawn"),
            ),
            "surrogates_drawn",
        )
    drawn = pairs.filter("drawn").select("entity", "surrogate")
    return None if drawn.isEmpty() else drawn
