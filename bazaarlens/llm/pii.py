"""Personal data replaced by keyed surrogates of the same type, script and format."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import saved, small_or_shuffled, text_of

# Titles by gender, given names by gender, and syllables of surnames.
TITLES_MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur")
TITLES_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme")
TITLES_ANY = ("Dr", "Prof", "Mx")
NAMES_MALE = ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Lucas", "Marco", "Nils", "Oscar", "Paul")
NAMES_FEMALE = ("Anna", "Berta", "Clara", "Diana", "Elena", "Frida", "Greta", "Hanna", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula")
NAMES_ANY = ("Alex", "Billie", "Charlie", "Dominique", "Eden", "Francis", "Gabriel", "Harper", "Jules", "Kim", "Lou", "Marlo", "Noa", "Robin", "Sascha", "Toni")
SYLLABLES = ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ha", "ho", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "pa", "pe", "ra", "ro", "sa", "so", "ta", "to")
# Draws that keep an entity's form; later ones are longer by a character each.
DRAWS_IN_FORM = 3
# The same of other scripts, by the name of the script.
NAMES_BY_SCRIPT = {
    "Cyrillic": (
        ("Адам", "Борис", "Вадим", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Марк", "Никита", "Олег", "Павел", "Роман", "Степан"),
        ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София"),
        ("Валя", "Женя", "Женька", "Вася", "Лера", "Мика", "Мишель", "Никки", "Паша", "Саша", "Сашка", "Слава", "Тоня", "Шура", "Юля", "Яна"),
    ),
    "Greek": (
        ("Αδάμ", "Βασίλης", "Γιάννης", "Δημήτρης", "Ηλίας", "Θωμάς", "Ιάσονας", "Κώστας", "Λουκάς", "Μάρκος", "Νίκος", "Ορέστης", "Παύλος", "Σπύρος", "Τάσος", "Φίλιππος"),
        ("Άννα", "Βέρα", "Γεωργία", "Δανάη", "Ελένη", "Ζωή", "Ηρώ", "Θάλεια", "Ιωάννα", "Κλειώ", "Λίνα", "Μαρία", "Νεφέλη", "Όλγα", "Ρένα", "Σοφία"),
        ("Άλεξ", "Αγάπη", "Βιλ", "Γκάμπι", "Ελπίδα", "Κιμ", "Κρις", "Λου", "Μισέλ", "Νίκι", "Νοέλ", "Πατ", "Ρομπέν", "Σάμι", "Τζο", "Τόνι"),
    ),
}
SYLLABLES_BY_SCRIPT = {
    "Cyrillic": ("ба", "бе", "бо", "да", "де", "до", "фа", "фе", "га", "го", "ха", "хо", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "па", "пе", "ра", "ро", "са", "со", "та", "то"),
    "Greek": ("βα", "βε", "βο", "δα", "δε", "δο", "φα", "φε", "γα", "γο", "χα", "χο", "κα", "κε", "κο", "λα", "λε", "λο", "μα", "με", "μο", "να", "νε", "νο", "πα", "πε", "ρα", "ρο", "σα", "σο", "τα", "το"),
}
DIGITS, SMALL, CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Letters that stand in for accented Latin letters of Western languages; both cases in one order.
ACCENTED = ("àáâãäåçèéêëìíîïñòóôõöøùúûüýÿßœ", "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŸẞŒ")
# Scripts by their names in patterns, with the code points that stand in for their small letters, or for all letters
# and marks of scripts without case.
CASED = {"Latin": (0x101, 0x17F), "Greek": (0x3AC, 0x3CE), "Cyrillic": (0x430, 0x451), "Armenian": (0x561, 0x586), "Georgian": (0x10D0, 0x10F0)}
UNCASED = {
    "Han": (0x4E00, 0x4EFF), "Hangul": (0xAC00, 0xACFF), "Hiragana": (0x3041, 0x3096), "Katakana": (0x30A1, 0x30FA),
    "Bopomofo": (0x3105, 0x3129), "Arabic": (0x620, 0x65F), "Hebrew": (0x591, 0x5EA), "Syriac": (0x710, 0x74A),
    "Thaana": (0x780, 0x7B0), "Devanagari": (0x900, 0x963), "Bengali": (0x981, 0x9E3), "Gurmukhi": (0xA01, 0xA74),
    "Gujarati": (0xA81, 0xAE3), "Oriya": (0xB01, 0xB63), "Tamil": (0xB82, 0xBD7), "Telugu": (0xC01, 0xC63),
    "Kannada": (0xC82, 0xCE3), "Malayalam": (0xD02, 0xD63), "Sinhala": (0xD82, 0xDF3), "Thai": (0xE01, 0xE4E),
    "Lao": (0xE81, 0xECD), "Tibetan": (0xF40, 0xFBC), "Myanmar": (0x1000, 0x103E), "Ethiopic": (0x1200, 0x12FF),
    "Khmer": (0x1780, 0x17D3), "Mongolian": (0x1820, 0x1877),
}


def _characters(first: int, last: int, kinds: str) -> str:
    return "".join(c for c in map(chr, range(first, last + 1)) if unicodedata.category(c)[0] in kinds)


def _pairs(first: int, last: int) -> str:
    """Small letters that are one letter in capitals too, so that both cases of an entity stay forms of one surrogate."""
    return "".join(c for c in map(chr, range(first, last + 1)) if c.islower() and len(c.upper()) == 1 and c.upper().lower() == c)


def _alphabets() -> list[tuple[str, str]]:
    """Patterns of characters beyond ASCII with the characters that stand in for them. The last five leave none out that
    ``PATTERN`` takes into an email: they are for scripts not listed above, and no character stands for itself there."""
    found = []
    for script, ends in CASED.items():
        small = _pairs(*ends)
        found += [(rf"[\p{{Is{script}}}&&\p{{Lu}}\p{{Lt}}]", small.upper()), (rf"[\p{{Is{script}}}&&\p{{L}}]", small)]
    for script, ends in UNCASED.items():
        found.append((rf"[\p{{Is{script}}}&&\p{{L}}]", _characters(*ends, "L")))
        if marks := _characters(*ends, "M"):
            found.append((rf"[\p{{Is{script}}}&&\p{{M}}]", marks))
    zeros = [n for n in range(0x80, 0x20000) if unicodedata.decimal(chr(n), -1) == 0]
    found += [(f"[{chr(n)}-{chr(n + 9)}]", "".join(map(chr, range(n, n + 10)))) for n in zeros]
    rest = [(r"[\p{Lu}\p{Lt}]", CAPITAL), (r"[\x{300}-\x{307}]", _characters(0x308, 0x30C, "M")), (r"\p{M}", _characters(0x300, 0x307, "M"))]
    return [*found, *rest, (r"\p{N}", DIGITS), (r"\p{L}", SMALL)]


# Vowel signs and joiners are part of words in many scripts.
_WORD = r"\p{L}\p{M}\p{N}\x{200C}\x{200D}"
_LOCAL = _WORD + r"._%+\-"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "(?:" + "|".join(TITLES_MALE + TITLES_FEMALE + TITLES_ANY) + ")"
# Numbers in groups without a country: 555-123-4567, 1-555-123-4567, 555.123.4567, 0171 2345678 or 0171/2345678.
_NATIONAL = r"(?:(?:1-)?\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|0\d{2,4}[ /\-]\d{5,8})"
PATTERN = "|".join(
    [
        rf"(?<![{_LOCAL}])[{_LOCAL}]++@[{_WORD}\-]++(?:\.[{_WORD}\-]++)+",
        rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
        r"(?<![\d+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)",
        r"(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)",
        # Also social security numbers, 123-45-6789.
        rf"(?<![\p{{L}}\p{{N}}.+/\-])(?:{_NATIONAL}|\d{{3}}-\d{{2}}-\d{{4}})(?![\p{{L}}\p{{N}}]|[./\-]\d)",
        r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?!\d)",
        r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
        rf"(?<!\p{{L}}){_TITLE}\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?(?!\p{{L}})",
    ]
)


def kind(value: Column) -> Column:
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^(?:[+(]|{_NATIONAL}$)"), "phone")
        .when(value.rlike(r"^[\d.]+$") & value.contains("."), "address")
        .when(value.rlike(r"^[\d \-]+$") & (F.length(value) < 24), "card")
        .when(value.rlike(r"^[0-9a-fA-F]+$"), "secret")
        .otherwise("person")
    )


def canonical(value: Column) -> Column:
    """What forms of one entity have in common: digits of numbers, small letters of the rest, no title of persons."""
    of = kind(value)
    return (
        F.when(of.isin("phone", "card"), F.regexp_replace(value, r"\D", ""))
        .when(of == "person", F.regexp_replace(value, r"\.? ", " "))
        .otherwise(F.lower(value))
    )


def _number(digest: Column, at: Column | int, below: Column | int) -> Column:
    """A number below ``below`` from the two hex digits at a place of the digest, of 64 places."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(digest, F.pmod(at, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int") % below


def _of(values: tuple[str, ...], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _number(digest, at, len(values)) + 1)


def _stand_ins(c: Column) -> Column:
    """The characters of which one takes the place of ``c``: of its script and case; null for signs, which stay."""
    out = F.when(c.between("a", "z"), F.lit(SMALL)).when(c.between("0", "9"), F.lit(DIGITS)).when(c.between("A", "Z"), F.lit(CAPITAL))
    out = out.when(c < "\x80", F.lit(None).cast("string"))
    for letters in ACCENTED:
        out = out.when(F.contains(F.lit(letters), c), F.lit(letters))
    for pattern, letters in _alphabets():
        out = out.when(c.rlike(pattern), F.lit(letters))
    return out


def _letters(text: Column, digest: Column) -> Column:
    """Each letter, mark and digit is exchanged for one of its script and case; all else stays."""
    characters = F.transform(F.split(text, ""), lambda c: F.struct(c.alias("c"), _stand_ins(c).alias("of")))

    def other(e: Column, i: Column) -> Column:
        return F.coalesce(F.substring(e["of"], _number(digest, i, F.length(e["of"])) + 1, F.lit(1)), e["c"])

    return F.concat_ws("", F.transform(characters, other))


def _digits(value: Column, digest: Column) -> Column:
    """All digits but the first are exchanged, by their number among the digits; separators stay."""

    def other(c: Column, i: Column) -> Column:
        ahead = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), r"\D", ""))
        return F.when(c.between("0", "9") & (ahead > 0), _number(digest, ahead, 10).cast("string")).otherwise(c)

    return F.concat_ws("", F.transform(F.split(value, ""), other))


def part_of(entity: Column) -> Column:
    """What an entity shares with others: a person's family, an email's domain; null for the rest."""
    name = entity["entity"]
    return (
        F.when(entity["kind"] == "person", F.concat(F.lit("family "), F.element_at(F.split(F.lower(name), " "), -1)))
        .when(entity["kind"] == "email", F.concat(F.lit("domain "), F.substring_index(name, "@", -1)))
    )


def _keyed(entity: Column, key: str, attempt: Column, part_attempt: Column) -> Column:
    """An entity with its digests: ``d1`` of a person's surname or else of the whole, ``d2`` of an email's domain or a person's
    given name, and the draws of both. A surname and a domain are drawn by themselves, so those who share one keep sharing it
    whatever is drawn anew for one of them."""
    value, of, name = entity["value"], entity["kind"], entity["entity"]

    def digest(label: str, part: Column, draw: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(label), of, part, draw.cast("string")).cast("binary"), 512)

    words, person = F.split(F.lower(name), " "), of == "person"
    first = F.when(person, F.element_at(words, -1)).otherwise(name)
    second = F.when(person, F.get(words, 1)).otherwise(F.substring_index(name, "@", -1))
    first_draw = F.when(person, part_attempt).otherwise(attempt)
    second_draw = F.when(person, attempt).otherwise(part_attempt)
    return F.struct(
        value.alias("value"), of.alias("kind"), name.alias("entity"),
        digest("1", first, first_draw).alias("d1"), digest("2", second, second_draw).alias("d2"),
        F.greatest(F.lit(0), first_draw - DRAWS_IN_FORM).alias("n1"), F.greatest(F.lit(0), second_draw - DRAWS_IN_FORM).alias("n2"),
    )


def _longer(text: Column, digest: Column, n: Column, hexadecimal: bool = False) -> Column:
    """The text with ``n`` more characters: where a form has too few surrogates for its entities, later draws are longer."""
    end = F.substring(digest, F.lit(-1) * n, n)
    return F.when(n > 0, F.concat(text, end if hexadecimal else F.translate(end, "0123456789", "ghijklmnop"))).otherwise(text)


def _surrogate(e: Column) -> Column:
    """The replacement of a keyed entity; forms of one entity get forms of one surrogate.

    Emails keep the shape of their names under ``example``; persons keep their title and get a given name of its gender
    and a surname of syllables, each of the script of the name it replaces and from it alone, so ``Mr. Paul Klee`` and
    ``Mr. Klee`` stay one family. Names beyond Latin, Cyrillic and Greek script are exchanged letter by letter.
    """
    value, of, d1, d2, n1, n2 = (e[c] for c in ("value", "kind", "d1", "d2", "n1", "n2"))
    domain = F.substring_index(value, "@", -1)
    email = F.concat(
        _longer(_letters(F.substring_index(value, "@", 1), d1), d1, n1), F.lit("@"),
        _longer(_letters(F.substring_index(domain, ".", 1), d2), d2, n2), F.lit(".example."), F.substring_index(domain, ".", -1),
    )
    octets = [(_number(d1, 0, 223) + 1).cast("string"), *[_number(d1, i, 256).cast("string") for i in (1, 2, 3)]]
    octets.append(F.when(n1 > 0, _number(d1, 4, 256).cast("string")))
    hexadecimal = _longer(F.substring(d1, F.lit(1), F.length(value)), d1, n1, hexadecimal=True)
    number = F.concat(_digits(value, d1), F.when(n1 > 0, F.translate(F.substring(d1, F.lit(-1) * n1, n1), "abcdef", "012345")).otherwise(""))
    words = F.split(value, " ")
    title = F.regexp_replace(F.get(words, 0), r"\.$", "")

    def given_of(male: tuple[str, ...], female: tuple[str, ...], either: tuple[str, ...]) -> Column:
        names = F.when(title.isin(*TITLES_MALE), _of(male, d2, 0)).when(title.isin(*TITLES_FEMALE), _of(female, d2, 0))
        return names.otherwise(_of(either, d2, 0))

    def surname_of(syllables: tuple[str, ...]) -> Column:
        return F.initcap(F.concat(*[_of(syllables, d1, i) for i in range(4)]))

    old_given, old_surname = F.get(words, 1), F.element_at(words, -1)
    given = F.when(old_given.rlike(r"^\p{IsLatin}"), given_of(NAMES_MALE, NAMES_FEMALE, NAMES_ANY))
    surname = F.when(old_surname.rlike(r"^\p{IsLatin}"), surname_of(SYLLABLES))
    for script, names in NAMES_BY_SCRIPT.items():
        given = given.when(old_given.rlike(rf"^\p{{Is{script}}}"), given_of(*names))
        surname = surname.when(old_surname.rlike(rf"^\p{{Is{script}}}"), surname_of(SYLLABLES_BY_SCRIPT[script]))
    given = F.when(F.size(words) > 2, _longer(given.otherwise(_letters(old_given, d2)), d2, n2))
    surname = _longer(surname.otherwise(_letters(old_surname, d1)), d1, n1)
    return (
        F.when(of == "email", email)
        .when(of == "address", F.concat_ws(".", *octets))
        .when(of.isin("phone", "card"), number)
        .when(of == "secret", F.when(value == F.upper(value), F.upper(hexadecimal)).otherwise(hexadecimal))
        .otherwise(F.concat_ws(" ", F.get(words, 0), given, surname))
    )


def _entity(value: Column) -> Column:
    return F.struct(value.alias("value"), kind(value).alias("kind"), canonical(value).alias("entity"))


def entities(docs: DataFrame, text: str) -> DataFrame:
    """A row for each place where an entity stands, with the columns of ``docs`` but for the text."""
    found = F.explode(F.regexp_extract_all(text_of(text), F.lit(PATTERN), F.lit(0)))
    rows = docs.withColumn("value", found).drop(text)
    return rows.withColumns({"kind": kind(F.col("value")), "entity": canonical(F.col("value"))}).drop("value")


def _shown(kind: Column, entity: Column) -> Column:
    """An entity as a value again. Numbers lose their separators in the canonical form; a plus sign tells phones again."""
    return F.when(kind == "phone", F.concat(F.lit("+"), entity)).otherwise(entity)


def _drawn_until_distinct(drawn: DataFrame, key: str, name: str) -> DataFrame:
    """Draws anew for those of ``drawn`` whose surrogate another one has or has as its real value, until none is left.

    ``drawn`` has ``kind``, ``entity`` and the draws ``attempt`` and ``part_attempt``; kinds named after a part are judged by
    that part of the surrogate alone. Of those that share a surrogate, one drawn least often keeps it. Draws after the first
    ``DRAWS_IN_FORM`` are a character longer each time, so every crowd is resolved; each round takes in a smaller rest.
    """
    while True:
        e = F.struct(_shown(F.col("kind"), F.col("entity")).alias("value"), "kind", "entity")
        named = drawn.withColumn("e", _keyed(e, key, F.col("attempt"), F.col("part_attempt")))
        named = named.withColumn("made", _surrogate(F.col("e"))).drop("e")
        whole = canonical(F.col("made"))
        if name == "parts":
            # Families by surname, domains by all behind the sign.
            family = F.element_at(F.split(F.lower(whole), " "), -1)
            whole = F.when(F.col("kind") == "person", family).otherwise(F.substring_index(whole, "@", -1))
            real_name = F.when(F.col("kind") == "person", F.element_at(F.split(F.lower("entity"), " "), -1)).otherwise(
                F.substring_index("entity", "@", -1)
            )
        else:
            real_name = F.col("entity")
        named = saved(named.withColumns({"new": whole, "real": real_name}).drop("made"), f"surrogates-of-{name}")
        draws = F.col("part_attempt") if name == "parts" else F.col("attempt")
        first = F.min(F.struct(draws, F.col("entity")))["entity"]
        winners = named.groupBy("kind", "new").agg(first.alias("winner"))
        real = named.select(F.col("kind").alias("__kind"), F.col("real").alias("__real"), F.lit(True).alias("taken")).distinct()
        judged = named.join(winners, ["kind", "new"]).join(
            real, (F.col("kind") == F.col("__kind")) & (F.col("new") == F.col("__real")), "left"
        )
        again = (F.col("entity") != F.col("winner")) | F.coalesce("taken", F.lit(False))
        judged = saved(judged.select(*drawn.columns, again.alias("again")), f"judged-{name}")
        if not judged.filter("again").limit(1).count():
            return drawn
        column = "part_attempt" if name == "parts" else "attempt"
        drawn = judged.withColumn(column, F.col(column) + F.col("again").cast("int")).drop("again")


def redrawn(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(name, attempt)`` of what is not given its first surrogate, because another entity has it or it is another one's real
    value: families and domains first, then entities, of which only their own part is drawn anew.

    Entities are made distinct before the shuffle, so a value in a third of all documents is one row.
    """
    none = F.lit(0)
    found = saved(entities(docs.select(text), text).distinct(), "entities")
    with_part = found.withColumn("part", part_of(F.struct("kind", "entity")))
    # One entity stands for all that share a part: the part's surrogate depends on nothing else.
    parts = with_part.filter("part IS NOT NULL").groupBy("kind", "part").agg(F.min("entity").alias("entity"))
    parts = _drawn_until_distinct(
        saved(parts.withColumns({"attempt": none, "part_attempt": none}), "parts"), key, "parts"
    )
    draws = parts.filter("part_attempt > 0").select("part", "part_attempt")
    whole = with_part.join(draws, "part", "left").withColumns({"attempt": none, "part_attempt": F.coalesce("part_attempt", none)})
    whole = _drawn_until_distinct(saved(whole, "whole-entities"), key, "entities")
    again = whole.filter("attempt > 0").select(F.concat_ws(" ", "kind", "entity").alias("name"), "attempt")
    return again.unionByName(draws.select(F.col("part").alias("name"), F.col("part_attempt").alias("attempt")))


def replace_pii(docs: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows with every entity of ``text`` replaced, and ``n_entities``, which replaces a column of that name.

    A surrogate follows from the key and the entity, so it is the same in all documents and in a rerun, and one projection
    writes it where the entity stands. Only entities whose surrogate would collide (see ``redrawn``) are looked up: the
    documents that hold one are joined with a map of theirs. Persons of one family get one surname and emails of one domain
    one domain, in all documents. Distinct entities get distinct surrogates: where a form has too few, some are longer than
    what they replace. Nothing ends in an error.

    A null text stays null, with no entities; texts without entities are unchanged. Repeated rows are treated alike. Other
    columns pass through.
    """
    docs = docs.drop("n_entities")
    again = saved(redrawn(docs, key, text), "redrawn")
    if again.limit(1).count():
        again = small_or_shuffled(again, 200_000)
        held = entities(docs.select(F.col(doc_id).alias("__id"), text), text)
        names = F.array_compact(F.array(F.concat_ws(" ", "kind", "entity"), part_of(F.struct("kind", "entity"))))
        held = held.select("__id", F.explode(names).alias("name")).distinct()
        entry = F.struct("name", "attempt")
        maps = held.join(again, "name").groupBy("__id").agg(F.map_from_entries(F.collect_set(entry)).alias("__again"))
        rows = docs.join(small_or_shuffled(saved(maps, "redrawn-maps"), 100_000), F.col(doc_id).eqNullSafe(F.col("__id")), "left")
    else:
        rows = docs.withColumn("__again", F.lit(None).cast("map<string,int>"))

    def keyed(e: Column) -> Column:
        def draws(name: Column) -> Column:
            return F.coalesce(F.try_element_at(F.col("__again"), name), F.lit(0))

        return _keyed(e, key, draws(F.concat_ws(" ", e["kind"], e["entity"])), draws(F.coalesce(part_of(e), F.lit(""))))

    # Step by step, so that each digest is worked out once.
    rows = rows.withColumn("__found", F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)))
    rows = rows.withColumn("n_entities", F.coalesce(F.size("__found"), F.lit(0)).cast("bigint"))
    rows = rows.withColumn("__entities", F.transform("__found", _entity))
    rows = rows.withColumn("__keyed", F.transform("__entities", keyed))
    rows = rows.withColumn("__new", F.transform("__keyed", _surrogate))
    rows = rows.withColumn("__between", F.when(F.col("n_entities") > 0, F.split(F.col(text), PATTERN, -1)))
    woven = F.transform("__between", lambda part, i: F.concat(part, F.coalesce(F.get("__new", i), F.lit(""))))
    rows = rows.withColumn(text, F.when(F.col("n_entities") > 0, F.concat_ws("", woven)).otherwise(F.col(text)))
    return rows.select(*docs.columns, "n_entities")
