r"""Personal data replaced by surrogates.

Detected: e-mail, IPv4 and IPv6 addresses; telephone numbers with `+`, an area code in brackets, the North American form
212-555-0101 (hyphens or dots) or a leading 0 (020 7946 0958, 030/1234567); payment card numbers; numbers of the
form 123-45-6789; and names after a title (Mr., Dr., Frau, ...): initials, parts with hyphens and apostrophes, particles
(van der) and any number of capitalised words. Any blanks, a line break too, may stand between title and name; a line
break ends the name. After a title in capitals (MR.) a name has two parts at most, as the sentence may go on in
capitals. A family name is replaced also where it stands alone in the same text.

Each distinct entity of the corpus gets one surrogate, drawn from a keyed digest: the same entity has the
same surrogate everywhere (coreference; `Mr. Smith` and `Dr. John Smith-Jones` share a family name). An entity is its
canonical form: the digits of a telephone number (without country and leading 0, +1 is understood) or card, the
lower-case address, domain or name, the IPv6 address in full. It is drawn once and printed in the form of each mention; the type and
format stay (lengths, separators, letter case, digits, a valid check digit; IPv6 in full), names keep their
gender and script (Latin, Cyrillic or Greek; letters of other scripts become Latin). Initials go through a keyed rotation
of the alphabet, so different ones stay different. Collision checks over the whole corpus keep different entities, and the domains of
addresses, different: a draw that equals any detected entity, a surrogate in use, or a draw of another entity is made again. Where
draws of the entity's own form run out, later ones widen it, so that every entity gets a surrogate: longer
names, domains and local parts, other exchanges, numbers and the reserved block 240/4, at last additional digits
or (IPv4) groups.

`replace` changes nothing in texts without an entity. Null texts stay null. Rows may repeat and ids may be
null: rows are told apart by position. An empty table gives no rows. Only SQL expressions are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh_name, stored

# Titles by gender, abbreviations among them, words inside names.
TITLES_M = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "господин", "κύριος")
TITLES_F = ("Mrs", "Ms", "Miss", "Madam", "Madame", "Mme", "Mlle", "Frau", "Señora", "госпожа", "κυρία")
TITLES_N = ("Dr", "Doctor", "Doktor", "Prof", "Professor", "доктор", "профессор")
ABBREVIATED = ("Mr", "Mrs", "Ms", "Mme", "Mlle", "Dr", "Prof")
PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "la", "le", "zu", "bin", "ibn", "al", "el", "ten", "ter")

# Letters by script, and parts of surrogate names by script and gender (family names: s); a name is two parts or more.
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
NAME_STARTS = {"latin": ("Al", "Bel", "Cor", "Dar", "El", "Fen", "Gal", "Hal", "Is", "Jor", "Kel", "Lor", "Mar", "Nor", "Ol", "Per"),
               "cyrillic": ("Ал", "Бел", "Вер", "Гор", "Дар", "Ел", "Жан", "Зор", "Ил", "Кар", "Лар", "Мар", "Нел", "Ор", "Пет", "Рен"),
               "greek": ("Αλ", "Βελ", "Γαρ", "Δαρ", "Ελ", "Ζαν", "Θαλ", "Ιλ", "Καρ", "Λαρ", "Μαρ", "Νελ", "Ορ", "Πετ", "Ρεν", "Σαρ")}
NAME_MIDDLES = {"latin": ("an", "el", "in", "or", "is", "am", "ed", "ov", "at", "ir", "om", "ul", "eb", "ar", "on", "iv"),
                "cyrillic": ("ан", "ел", "ин", "ор", "ис", "ам", "ед", "ов", "ат", "ир", "ом", "ул", "еб", "ар", "он", "ив"),
                "greek": ("αν", "ελ", "ιν", "ορ", "ισ", "αμ", "εδ", "οβ", "ατ", "ιρ", "ομ", "ουλ", "εβ", "αρ", "ον", "ιβ")}
NAME_ENDS = {("latin", "m"): ("o", "er", "us", "ald"), ("latin", "f"): ("a", "ia", "ina", "elle"), ("latin", "n"): ("y", "is", "en", "ey"),
             ("latin", "s"): ("son", "ley", "man", "field"),
             ("cyrillic", "m"): ("ий", "ан", "ор", "ислав"), ("cyrillic", "f"): ("а", "ия", "ина", "ислава"), ("cyrillic", "n"): ("ша", "ня"),
             ("cyrillic", "sm"): ("ов", "ин", "ев", "ский"), ("cyrillic", "sf"): ("ова", "ина", "ева", "ская"), ("cyrillic", "sn"): ("енко", "ук", "ых"),
             ("greek", "m"): ("ος", "ης", "ας"), ("greek", "f"): ("α", "η", "ια"), ("greek", "n"): ("ι", "ω"),
             ("greek", "sm"): ("όπουλος", "ίδης", "άκης"), ("greek", "sf"): ("οπούλου", "ίδου", "άκη"), ("greek", "sn"): ("έα", "ού")}

# Entities that one task draws for at a time.
DRAWS_A_TASK = 5_000
# Texts with an entity that one task puts together.
TEXTS_A_TASK = 1_000
# Draws in the entity's own form; as many follow in the whole format, then each adds a character.
OWN_DRAWS = 8


def _titles(titles: tuple[str, ...]) -> str:
    """Titles as written and with a capital letter."""
    return "|".join(sorted({*titles, *(t.capitalize() for t in titles)}))


def _shouted(titles: tuple[str, ...]) -> str:
    """Titles in capitals; abbreviations need their dot there (MS, DR)."""
    return "|".join(t.upper() + (r"\." if t in ABBREVIATED else "") for t in titles)


_ALL = TITLES_M + TITLES_F + TITLES_N
_GAP = r"[ \t\u00A0]++"  # between parts of a name
_TITLE, _SHOUTED = _titles(_ALL), _shouted(_ALL)
_FIRST = "".join(sorted({t[0] for t in f"{_TITLE}|{_SHOUTED}".split("|")}))
_PART = (
    rf"(?:(?:\p{{Lu}}\.)++|(?!(?:{_TITLE})[.\s])\p{{Lu}}(?:[\p{{L}}\p{{M}}]++|(?=['’]\p{{Lu}}))(?:['’-]\p{{Lu}}[\p{{L}}\p{{M}}]++)*+)"
)
_PARTICLE = rf"(?:(?:{'|'.join(PARTICLES)}){_GAP})*+"
# Titles may follow each other (Herr Dr.); a longer row of them begins in its middle.
_PREFIX = rf"(?:(?:{_TITLE})\.?+\s++){{1,3}}+"
_SHOUTED_PREFIX = rf"(?:{_SHOUTED})\.?+\s++"
NAME = (
    rf"(?=[{_FIRST}])(?<![\p{{L}}\p{{N}}_])(?:{_PREFIX}{_PARTICLE}{_PART}(?:{_GAP}{_PARTICLE}{_PART})*+|{_SHOUTED_PREFIX}{_PART}(?:{_GAP}{_PART})?+)"
)
# Of a name: its words, and initials.
NAME_WORD = r"\p{Lu}[\p{L}\p{M}]++|\p{Lu}(?=\.)"
CAPITALISED = r"(?<![\p{L}\p{N}_])\p{Lu}[\p{L}\p{M}]++(?![\p{N}_])"
_BEFORE_TOKEN = r"(?<![\p{L}\p{N}_.+-])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Possessive throughout: a repeated group that may give back is matched by recursion, and long texts end the JVM.
_LABEL = r"[\p{L}\p{N}]++(?:-++[\p{L}\p{N}]++)*+"
EMAIL = rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++@(?=[\p{{L}}\p{{N}}.-]*\.\p{{L}}{{2}}){_LABEL}(?:\.{_LABEL})++"
# The common bracket forms come first; the open form must not run on into an IPv4 address.
PHONE = (
    r"(?<![\p{L}\p{N}_+-])(?:(?:\+[0-9]{1,3} ?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9]|\.[0-9]))"
)
CARD = r"(?<![\p{L}\p{N}_.+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\p{L}\p{N}_])"
SSN = r"(?<![\p{L}\p{N}_.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}_-])"
IPV4 = _BEFORE_TOKEN + rf"(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}_]|\.[0-9])"
# Area code and exchange of the North American plan, or a leading 0 that no card number continues.
NATIONAL = (
    r"(?<![\p{L}\p{N}_.+/-])(?:(?:1[-.])?[2-9][0-9]{2}[-.][2-9][0-9]{2}[-.][0-9]{4}"
    r"|0[0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}|0[1-9][0-9]{1,4}[ /-][0-9]{5,8})(?![\p{L}\p{N}_]|[ ./-][0-9])"
)
# In full, or shortened after a first group of four digits, as all addresses of networks have.
_HEX = "[0-9A-Fa-f]{1,4}"
IPV6 = (
    rf"(?<![\p{{L}}\p{{N}}_:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*[0-9])[0-9A-Fa-f]{{4}}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}_:])"
)
ENTITY = "|".join((EMAIL, PHONE, IPV4, SSN, CARD, NATIONAL, IPV6, NAME))


def _has_entity(text: Column) -> Column:
    """Whether a text holds an entity. Each kind has a digit, an @ or a title, which is found much faster."""
    sign, signs = text.rlike("[0-9@]"), [t.removesuffix(r"\.") for t in f"{_TITLE}|{_SHOUTED}".split("|")]
    for title in signs:
        if not any(other != title and other in title for other in signs):
            sign = sign | F.contains(text, F.lit(title))
    return F.coalesce(sign & text.rlike(ENTITY), F.lit(False))


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once: as an element of an array it isn't copied into every use."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _token(before: Column, kind: Column, mention: Column, family: Column) -> Column:
    return F.struct(before.alias("before"), kind.alias("kind"), mention.alias("mention"), family.alias("family"))


def _kind(value: Column) -> Column:
    """Type of an entity that isn't a name."""
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(F.contains(value, F.lit(":")), "ip6")
        .when(value.rlike(r"^[+(]") | value.rlike(f"^(?:{NATIONAL})$"), "phone")
        .when(value.rlike(r"^[0-9.]+$") & F.contains(value, F.lit(".")), "ip")
        .when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .otherwise("card")
    )


def _name_tokens(before: Column, phrase: Column) -> Column:
    """The words of a title with a name; those of the last one are family names."""
    prefix = F.regexp_extract(phrase, f"^(?:{_PREFIX}|{_SHOUTED_PREFIX})", 0)

    def titled(titles: tuple[str, ...]) -> Column:
        return prefix.rlike(rf"(?<!\p{{L}})(?:{_titles(titles)}|{_shouted(titles)})(?!\p{{L}})")

    gender = F.when(titled(TITLES_M), "m").when(titled(TITLES_F), "f").otherwise("n")
    name = F.substring(phrase, F.length(prefix) + 1, F.length(phrase))
    last = F.regexp_extract(name, r"[^ \t\u00A0]+$", 0)
    facts = F.struct(
        prefix.alias("prefix"), gender.alias("gender"), F.split(name, NAME_WORD, -1).alias("gaps"), F.regexp_extract_all(name, F.lit(NAME_WORD), F.lit(0)).alias("words"),
        F.size(F.regexp_extract_all(last, F.lit(NAME_WORD), F.lit(0))).alias("families"),
    )

    def token(x: Column, word: Column, i: Column) -> Column:
        script = F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        family = i >= F.size(x["words"]) - x["families"]
        sex = F.when(~family, x["gender"]).otherwise(F.concat(F.lit("s"), F.when(script == "latin", "").otherwise(x["gender"])))
        kind = F.when(F.length(word) == 1, "initial").otherwise(F.concat_ws(":", F.lit("name"), script, sex))
        first = F.when(i == 0, F.concat(before, x["prefix"])).otherwise("")
        return _token(F.concat(first, F.get(x["gaps"], i)), kind, word, family & (F.length(word) > 1))

    # What follows the last word (the dot of an initial) goes in front of the next token.
    return _bound(facts, lambda x: F.concat(
        F.transform(x["words"], lambda word, i: token(x, word, i)), F.array(_token(F.element_at(x["gaps"], -1), F.lit("word"), F.lit(""), F.lit(False)))
    ))


def _word_tokens(tokens: Column) -> Column:
    """tokens with the capitalised words before each as tokens of their own: a family name may stand there alone."""

    def cut(t: Column) -> Column:
        both = F.struct(F.split(t["before"], CAPITALISED, -1).alias("gaps"), F.regexp_extract_all(t["before"], F.lit(CAPITALISED), F.lit(0)).alias("words"))
        return _bound(both, lambda x: F.concat(
            F.transform(x["words"], lambda word, i: _token(F.get(x["gaps"], i), F.lit("word"), word, F.lit(False))),
            F.array(_token(F.element_at(x["gaps"], -1), t["kind"], t["mention"], t["family"])),
        ))

    return F.flatten(F.transform(tokens, cut))


def _tokens(text: Column) -> Column:
    """A text as tokens: what stands before, then a mention of an entity with its kind, or a word (kind `word`) that may be a name."""

    def entity(x: Column, v: Column, i: Column) -> Column:
        before = F.get(x["pieces"], i)
        plain = F.array(_token(before, _kind(v), v, F.lit(False)))
        return F.when(v.rlike(f"^(?:{NAME})$"), _name_tokens(before, v)).otherwise(plain)

    found = F.struct(F.split(text, ENTITY, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)).alias("entities"))
    tail = _bound(found, lambda x: F.concat(
        F.flatten(F.transform(x["entities"], lambda v, i: entity(x, v, i))), F.array(_token(F.element_at(x["pieces"], -1), F.lit("word"), F.lit(""), F.lit(False)))
    ))
    return _bound(tail, lambda t: F.when(F.exists(t, lambda x: x["family"]), _word_tokens(t)).otherwise(t))


def _luhn_ok(digits: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""
    n = F.length(digits)
    weighed = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _canonical(kind: Column, mention: Column) -> Column:
    """The entity that a mention stands for."""
    digits = F.translate(mention, "+ .-()/", "")
    ours = (F.length(digits) == 10) & ~F.startswith(mention, F.lit("+")) & ~F.startswith(mention, F.lit("0"))
    phone = F.when(ours, F.concat(F.lit("1"), digits)).otherwise(digits)
    # The groups of a shortened address: zeros stand at ::.
    sides = F.transform(F.split(F.lower(mention), "::"), lambda x: F.filter(F.split(x, ":"), lambda g: g != ""))
    left, right = F.get(sides, F.lit(0)), F.coalesce(F.get(sides, F.lit(1)), F.array().cast("array<string>"))
    groups = F.concat(left, F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right)), right)
    ip6 = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ":")
    small = (kind == "email") | F.startswith(kind, F.lit("name"))
    return F.when(kind == "phone", phone).when(kind == "card", digits).when(kind == "ip6", ip6).when(small, F.lower(mention)).otherwise(mention)


def _printed(kind: Column, mention: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate of an entity (value) in the form of a mention: its separators, its capitals."""
    # The last digits are the mention's, if it leaves out the country.
    left_out = F.length(value) - F.length(F.regexp_replace(mention, "[^0-9]", ""))

    def digit(i: Column) -> Column:
        return F.substring(surrogate, left_out + F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))

    numbers = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).otherwise(c)), "")
    # Later draws may have added digits.
    numbers = F.concat(numbers, F.substring(surrogate, F.length(value) + 1, F.length(surrogate)))
    local = F.split(F.substring_index(mention, "@", 1), "")
    pairs = F.arrays_zip(F.split(surrogate, "").alias("made"), local.alias("said"))
    address = F.array_join(F.transform(pairs, lambda x: F.when(x["said"].rlike(r"\p{Lu}"), F.upper(x["made"])).otherwise(x["made"])), "")
    large = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))
    name = F.when(mention == F.upper(mention), F.upper(surrogate)).otherwise(large)
    return (
        F.when(kind.isin("phone", "card"), numbers)
        .when(F.startswith(kind, F.lit("name")), name)
        .when((kind == "email") & mention.rlike(r"\p{Lu}"), address)
        .otherwise(surrogate)
    )


def _surrogate(kind: Column, value: Column, draw: int, key: str) -> Column:
    """Draw `draw` for an entity: a fixed function of key, kind, value and draw."""
    seed = F.sha2(F.concat_ws("\x01", F.lit(key), kind, value, F.lit(str(draw))), 256)
    # As an element of an array the seed is worked out once, not for every character that is drawn from it.
    return F.get(F.transform(F.array(seed), lambda x: _drawn(kind, value, draw, key, x)), F.lit(0))


def _drawn(kind: Column, value: Column, draw: int, key: str, seed: Column) -> Column:
    """The draw that belongs to a seed."""

    def number(i: Column | int, n: int) -> Column:
        at = F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(29)) * 2 + 1
        return F.pmod(F.conv(F.substring(seed, at, F.lit(7)), 16, 10).cast("bigint"), F.lit(n))

    def pick(values: tuple[str, ...], i: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (number(i, len(values)) + 1).cast("int"))

    def redrawn(text: Column) -> Column:
        """Digits for digits, letters for letters of the same case and script (else Latin); the rest stays."""

        def letter(c: Column, i: Column) -> Column:
            def of(script: str) -> Column:
                return F.substring(F.lit(LETTERS[script]), (number(i, len(LETTERS[script])) + 1).cast("int"), F.lit(1))

            drawn = F.when(c.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(c.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))
            return F.when(c.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn)

        chars = F.transform(
            F.split(text, ""),
            lambda c, i: F.when(c.rlike(r"\p{N}"), number(i, 10).cast("string")).when(c.rlike(r"\p{L}"), letter(c, i)).otherwise(c),
        )
        return F.array_join(chars, "")

    # What later draws add: 16 times the space with every draw.
    wide, longer = draw >= OWN_DRAWS, max(0, draw - 2 * OWN_DRAWS + 1)
    more = F.sha2(F.concat(seed, F.lit("wider")), 256)
    letters = F.substring(F.translate(more, "0123456789", "ghijklmnop"), 1, max(0, draw - OWN_DRAWS + 1))
    digits = F.substring(F.translate(more, "abcdef", "012345"), 1, longer)
    # Addresses under a reserved ending; `replace` puts the surrogate of the domain, an entity of its own, there.
    domain = F.sha2(F.concat_ws("\x01", F.lit(key), F.lower(F.substring_index(value, "@", -1))), 256)
    email = F.concat(redrawn(F.substring_index(value, "@", 1)), letters, F.lit("@mail"), F.substring(domain, 1, 10), F.lit(".example"))
    own_domain = F.concat(F.lit("mail"), F.substring(seed, 1, 10), F.substring(more, 1, max(0, draw - OWN_DRAWS + 1)), F.lit(".example"))
    ip6 = F.concat_ws(":", F.lit("2001:0db8"), *(F.substring(seed, 1 + 4 * k, 4) for k in range(6)))  # the block of documentation
    # A number of one-digit countries: the exchange 555 is kept for fiction. Of others two digits stay.
    drawn, one_digit = redrawn(value), (F.length(value) == 11) & value.rlike("^[17]")
    fiction = F.concat(F.substring(value, 1, 1), F.substring(drawn, 2, 3), F.lit("555"), F.substring(drawn, 8, 4))
    kept = F.when(one_digit, 1).otherwise(2)
    free = F.concat(F.substring(value, F.lit(1), kept), F.substring(drawn, kept + 1, F.length(value)))
    phone = F.concat(free if wide else F.when(one_digit, fiction).otherwise(free), digits)
    groups = [number(15 + 2 * k, 256) for k in range(longer)]
    ip = F.concat_ws(".", (number(25, 15) + 240).cast("string") if wide else F.lit("10"), number(0, 256), number(5, 256), number(10, 256), *groups)
    ssn = F.concat(redrawn(value) if wide else F.concat(F.lit("9"), F.substring(redrawn(value), 2, 10)), digits)
    # The last digit is the one that makes the sum right, if it is right in the original.
    open_card = F.concat(F.substring(value, 1, 1), F.expr("''"), F.substring(redrawn(value), F.lit(2), F.length(value) - 2), digits)
    checked = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(open_card, d.cast("string"))),
        _luhn_ok,
    )
    card = F.when(_luhn_ok(value), F.get(checked, F.lit(0))).otherwise(F.concat(F.substring(value, 1, 1), F.substring(redrawn(value), F.lit(2), F.length(value)), digits))
    name = F.lit(None).cast("string")
    for (script, sex), ends in NAME_ENDS.items():
        # Later draws add parts, so that names never run out.
        middles = [pick(NAME_MIDDLES[script], 3 + 2 * k) for k in range(1 + draw // 4)]
        made = F.lower(F.concat(pick(NAME_STARTS[script], 0), *middles, pick(ends, 24)))
        name = F.when(kind == f"name:{script}:{sex}", made).otherwise(name)
    return (
        F.when(kind == "email", email).when(kind == "domain", own_domain).when(kind == "ip6", ip6).when(kind == "phone", phone).when(kind == "ip", ip).when(kind == "ssn", ssn).when(kind == "card", card).otherwise(name)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate from distinct entities (kind, value): one surrogate each, all different, none an entity."""
    # Counted first (`replace` reads them from a stored table): a draw is long, so they are dealt out by number.
    tasks = 1 + entities.count() // DRAWS_A_TASK
    entities = stored(entities.repartition(tasks), "pii-entities")
    originals = entities.select(F.col("value").alias("surrogate")).distinct()
    pending, done = entities, None
    for draw in count():
        drawn = stored(pending.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), draw, key)), "pii-drawn")
        good = drawn.join(originals, "surrogate", "left_anti")
        if done is not None:
            good = good.join(done.select("surrogate"), "surrogate", "left_anti")
        # Of several entities with the same draw one keeps it, whichever comes first by a fixed order.
        first = Window.partitionBy("surrogate").orderBy(F.xxhash64("kind", "value"), "kind", "value")
        good = stored(good.withColumn("_nr", F.row_number().over(first)).where("_nr = 1").select("kind", "value", "surrogate").coalesce(tasks), "pii-good")
        done = good if done is None else done.unionByName(good)
        pending = drawn.join(good.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value")
        if pending.isEmpty():
            return done


def _initial(mention: Column, key: str) -> Column:
    """The next letter in a keyed order of the alphabet: never the same, different for different letters; of other scripts X."""
    given, made = "", ""
    for letters in LETTERS.values():
        order = sorted(letters.upper(), key=lambda c: hashlib.sha256(f"{key}\x01initial\x01{c}".encode()).digest())
        given, made = given + "".join(order), made + "".join(order[1:] + order[:1])
    return F.when(F.contains(F.lit(given), mention), F.translate(mention, given, made)).otherwise("X")


def _domain(address: Column) -> Column:
    return F.substring_index(address, "@", -1)


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with every detected entity in column `text` replaced; same columns, same rows."""
    row, tokens, parts = (fresh_name(docs, n) for n in ("_row", "_tokens", "_parts"))
    has = _has_entity(F.col(text))
    touched = docs.where(has).withColumn(row, F.monotonically_increasing_id()).withColumn(tokens, _tokens(F.col(text))).drop(text)
    touched = stored(touched, "pii-touched")  # the row numbers must not change when a task is run again
    found = touched.select(F.col(row).alias("row"), F.posexplode(tokens).alias("nr", "t")).select("row", "nr", "t.kind", "t.mention", "t.family")
    # Words that are a family name of the same text; of two kinds (Cyrillic, by gender) the first.
    families = found.where("family").groupBy("row", "mention").agg(F.min("kind").alias("family_kind"))
    words = found.where("kind = 'word'").join(families, ["row", "mention"], "left").withColumn("kind", F.coalesce("family_kind", "kind"))
    found = found.where("kind <> 'word'").select("row", "nr", "kind", "mention").unionByName(words.select("row", "nr", "kind", "mention"))
    tasks = 1 + touched.count() // TEXTS_A_TASK
    found = stored(found.withColumn("value", _canonical(F.col("kind"), F.col("mention"))).coalesce(tasks), "pii-found")
    entities = found.where("kind NOT IN ('word', 'initial')").select("kind", "value").distinct()
    domains = entities.where("kind = 'email'").select(F.lit("domain").alias("kind"), _domain(F.col("value")).alias("value")).distinct()
    drawn = surrogates(entities.unionByName(domains), key)
    hosts = drawn.where("kind = 'domain'").select(F.col("value").alias("host"), F.col("surrogate").alias("new_host"))
    drawn = drawn.where("kind <> 'domain'").withColumn("host", F.when(F.col("kind") == "email", _domain(F.col("value")))).join(hosts, "host", "left")
    address = F.concat(F.substring_index("surrogate", "@", 1), F.lit("@"), F.col("new_host"))
    drawn = drawn.select("kind", "value", F.coalesce(address, "surrogate").alias("surrogate"))
    # An entity that stands in a third of all texts makes a large group on the left side only, which the
    # adaptive join splits.
    made = F.coalesce(_printed(F.col("kind"), F.col("mention"), F.col("value"), F.col("surrogate")), F.when(F.col("kind") == "initial", _initial(F.col("mention"), key)), F.col("mention"))
    shown = found.join(drawn, ["kind", "value"], "left").select("row", "nr", made.alias("made"))
    lists = shown.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nr", "made"))).alias(parts)).withColumnRenamed("row", row)
    woven = F.array_join(F.zip_with(F.col(tokens), F.col(parts), lambda t, x: F.concat(t["before"], x["made"])), "")
    changed = touched.join(lists, row).withColumn(text, woven).select(*docs.columns)
    return docs.where(~has).unionByName(changed.coalesce(tasks))
