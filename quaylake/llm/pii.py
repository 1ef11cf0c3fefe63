"""Personal data: detection by patterns and keyed, type-consistent surrogates.

Detection is one alternation of regular expressions. Every distinct entity of
the corpus, in a canonical form, gets one surrogate drawn from a keyed digest
in the format of its kind: digits stay digits, letters keep script and case,
card numbers keep a valid check digit, names keep the gender of their title.
The surrogates of the whole corpus are checked against each other and against
the real entities; those that collide are drawn again with the next attempt
number, so distinct entities stay distinct, and one entity has the same
surrogate wherever it is mentioned. Surnames are entities of their own: a person
keeps one surname with and without a given name, and a collision of two persons
draws the given name again, composed of syllables when the lists are used up.

Detected are what the patterns describe: persons behind a title, and numbers,
addresses and secrets by their form; an unbroken run of digits is a card only
with a valid check digit. Untitled names and postal addresses are not detected.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import materialize

# titles and the gender they state (fixed values)
MALE_TITLES = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Don", "Господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Doña", "Госпожа"]
# given names by gender and script (fixed values)
MALE_NAMES = ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Leo", "Martin",
              "Noah", "Oscar", "Paul", "Robin"]
FEMALE_NAMES = ["Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Laura",
                "Maria", "Nora", "Olga", "Paula", "Rosa"]
MALE_CYRILLIC = ["Адам", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"]
FEMALE_CYRILLIC = ["Анна", "Белла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения"]
SYLLABLES = ["ba", "de", "fi", "go", "ku", "la", "me", "ni", "po", "ru", "sa", "te", "vi", "wo", "zu", "ra"]
CYRILLIC_SYLLABLES = ["ба", "де", "фи", "го", "ку", "ла", "ме", "ни", "по", "ру", "са", "те", "ви", "во", "зу", "ра"]

_LOCAL = r"\p{L}\p{N}._%+\-"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(sorted(MALE_TITLES + FEMALE_TITLES, key=len, reverse=True))
# country codes of plans with one length of number, and how many digits follow the code (fixed values)
PHONE_PLANS = {"1": 10, "7": 10, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "48": 9, "61": 9,
               "90": 10, "91": 10, "351": 9, "420": 9}
# in order of precedence; the first alternative that fits at a place wins
PATTERNS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++@[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}.\-]*[\p{{L}}\p{{N}}])?\.\p{{L}}{{2,}}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ipv6": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{32,128}|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})"
              r"(?![0-9A-Za-z])",
    "card": r"(?<![\d])(?:\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{13,19})(?!\d)",
    "phone": r"(?<!\d)\(\d{3}\) ?\d{3}[.\- ]\d{4}(?!\d)|(?<![\d\-.])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-.])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'\-]+(?: \p{{Lu}}[\p{{L}}'\-]+)?",
}
# a number in international form: one that fits its country's plan ends there; in other countries groups of digits go
# on over spaces, but not into an entity of another kind or a phone of its own (of five fours the last four are a card)
_OTHER = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind not in ("card", "person"))
_OTHER = rf"{_OTHER}|(?:{PATTERNS['card']})(?! \d{{4}}(?!\d))"
_PLANNED = "|".join(rf"{code}[ .\-]?\(?\d(?:\)?(?:[.\-]| (?=\(?\d\d))?\(?\d){{{n - 1}}}"
                    for code, n in PHONE_PLANS.items())
PATTERNS["phone"] = (rf"(?<![\d+])\+(?:(?:{_PLANNED})(?![.\-]?\d)|\d{{1,3}}[ .\-]?(?:\(\d{{1,4}}\)|\d{{1,4}})"
                     rf"(?:[.\-]?\d{{2,4}}| (?!{_OTHER})\d{{2,4}}){{1,4}}(?!\d))|{PATTERNS['phone']}")
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# what every entity contains; most documents have none of it
HINT = rf"[0-9@]|{PATTERNS['secret']}|{PATTERNS['ipv6']}|(?:{_TITLE})\.? \p{{Lu}}"
DIGIT_KINDS = ["phone", "card", "ssn"]
ATTEMPTS = 32
# given names come from the lists in the first draws, from syllables later
LISTED_NAMES = 3


def found(text: Column) -> Column:
    return F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))


def kind_of(surface: Column) -> Column:
    """Kind of a matched string: the first pattern that covers all of it."""
    out = F.lit("phone")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(surface.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def canonical(kind: Column, surface: Column) -> Column:
    """The form that mentions of one entity share: digits of a number, lower case of the rest."""
    digits = F.regexp_replace(surface, "[^0-9]", "")
    plus = F.when(F.startswith(surface, F.lit("+")), F.lit("+")).otherwise(F.lit(""))
    return (F.when(kind.isin(DIGIT_KINDS), F.concat(plus, digits))
            .when(kind == "iban", F.regexp_replace(surface, " ", ""))
            .when(kind == "person", surface)
            .otherwise(F.lower(surface)))


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """256 hex characters from the keyed digest of an entity; two make one draw."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value)
    return F.concat(F.sha2(F.concat(seed, F.lit("|0")), 512), F.sha2(F.concat(seed, F.lit("|1")), 512))


def _draw(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, F.pmod(i - 1, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(chars: str, n: Column) -> Column:
    return F.substring(F.lit(chars), F.pmod(n, F.lit(len(chars))) + 1, F.lit(1))


def _each_char(value: Column, change) -> Column:
    """Join ``change(char, position)`` over the characters of ``value``."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))),
                                    lambda i: change(F.substring(value, i, F.lit(1)), i)), "")


def _same_class(c: Column, draw: Column) -> Column:
    """A character of the same class and script; punctuation stays."""
    return (F.when(c.rlike("[0-9]"), _pick("0123456789", draw))
            .when(c.rlike(r"\p{IsLatin}"),
                  F.when(c.rlike(r"\p{Lu}"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", draw))
                  .otherwise(_pick("abcdefghijklmnopqrstuvwxyz", draw)))
            .when(c.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", draw))
            .when(c.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", draw))
            .otherwise(c))


def _luhn_digit(body: Column) -> Column:
    """The check digit for a number without its last digit."""
    n = F.length(body)
    doubled = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (
        F.when((n - i) % 2 == 0, F.substring(body, i, F.lit(1)).cast("int") * 2)
        .otherwise(F.substring(body, i, F.lit(1)).cast("int"))))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return ((10 - total % 10) % 10).cast("string")


def _word(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), F.pmod(n, F.lit(len(words))) + 1)


def _syllables(cyrillic: Column, stream: Column, n: int) -> Column:
    parts = [F.when(cyrillic, _word(CYRILLIC_SYLLABLES, _draw(stream, F.lit(i)))).otherwise(
        _word(SYLLABLES, _draw(stream, F.lit(i)))) for i in range(1, n + 1)]
    return F.initcap(F.concat(*parts))


def surname_of(value: Column) -> Column:
    return F.element_at(F.split(value, " "), -1)


def new_surname(key: str, surname: Column, attempt: int) -> Column:
    """A surname of the same script, longer with every fourth draw."""
    return _syllables(surname.rlike(r"\p{IsCyrillic}"), _stream(key, F.lit("surname"), surname, F.lit(attempt)),
                      5 + attempt // 4)


def new_person(key: str, value: Column, family: Column, attempt: int) -> Column:
    """Title kept; given name of its gender and script, if there was one; ``family`` for the surname."""
    parts = F.split(value, " ")
    title, given = parts[0], F.when(F.size(parts) > 2, parts[1])
    bare = F.regexp_replace(title, r"\.$", "")
    cyrillic, male = surname_of(value).rlike(r"\p{IsCyrillic}"), bare.isin(MALE_TITLES)
    s = _stream(key, F.lit("given"), F.coalesce(given, F.lit("")), F.lit(attempt))
    g = _draw(s, F.lit(1))
    if attempt < LISTED_NAMES:
        new_given = (F.when(cyrillic & male, _word(MALE_CYRILLIC, g)).when(cyrillic, _word(FEMALE_CYRILLIC, g))
                     .when(male, _word(MALE_NAMES, g)).otherwise(_word(FEMALE_NAMES, g)))
    else:
        ending = (F.when(cyrillic & male, "р").when(cyrillic, "я").when(male, "o").otherwise("a"))
        new_given = F.concat(_syllables(cyrillic, s, 3 + attempt // 4), ending)
    return F.concat_ws(" ", title, F.when(given.isNotNull(), new_given), family)


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Surrogate of a canonical entity, in canonical form and in the format of its kind."""
    s = _stream(key, kind, value, attempt)
    digits = _each_char(value, lambda c, i: F.when(c.rlike("[0-9]"), _pick("0123456789", _draw(s, i))).otherwise(c))
    kept = F.when(F.startswith(value, F.lit("+")), 2).otherwise(0)
    phone = F.concat(F.substring(value, F.lit(1), kept), F.substring(digits, kept + 1, F.length(value)))
    card_body = F.substring(digits, F.lit(1), F.length(value) - 1)
    valid = F.substring(value, -1, 1) == _luhn_digit(F.substring(value, F.lit(1), F.length(value) - 1))
    card = F.when(valid, F.concat(card_body, _luhn_digit(card_body))).otherwise(digits)
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)),
                                  lambda i: (_draw(s, i) % 254 + 1).cast("string")), ".")
    hexed = _each_char(value, lambda c, i: F.when(c.rlike("[0-9a-f]"), _pick("0123456789abcdef", _draw(s, i)))
                       .otherwise(c))
    alike = _each_char(value, lambda c, i: _same_class(c, _draw(s, i)))
    # the last label of a mail domain and the country of a bank number are part of the format
    tail = F.regexp_extract(value, r"\.[^.]+$", 0)
    email = F.concat(F.substring(alike, F.lit(1), F.length(value) - F.length(tail)), tail)
    iban = F.concat(F.substring(value, 1, 2), F.substring(alike, F.lit(3), F.length(value)))
    return (F.when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", digits)
            .when(kind == "ip", ip).when((kind == "ipv6") | value.rlike("^[0-9a-f]{32,}$"), hexed)
            .when(kind == "email", email).when(kind == "iban", iban).otherwise(alike))


def is_entity(kind: Column, surface: Column) -> Column:
    """False for an unbroken run of digits of a card's length whose last digit is no check digit."""
    body = F.substring(surface, F.lit(1), F.length(surface) - 1)
    run = (kind == "card") & surface.rlike(r"^\d+$")
    return F.when(run, F.substring(surface, -1, 1) == _luhn_digit(body)).otherwise(True)


def dressed(kind: Column, surface: Column, new: Column) -> Column:
    """Write a canonical surrogate the way the mention is written: separators, spaces and case."""
    bare = F.regexp_replace(new, r"^\+", "")
    # digits of a number go one by one into the places of the old digits
    filled = F.aggregate(
        F.split(surface, ""), F.struct(F.lit("").alias("out"), bare.alias("rest")),
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(a["out"], F.substring(a["rest"], 1, 1)).alias("out"),
                                                       F.substring(a["rest"], F.lit(2), F.length(a["rest"])).alias("rest")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["rest"].alias("rest"))), lambda a: a["out"])
    spaced = F.aggregate(
        F.split(surface, ""), F.struct(F.lit("").alias("out"), new.alias("rest")),
        lambda a, c: F.when(c != " ", F.struct(F.concat(a["out"], F.substring(a["rest"], 1, 1)).alias("out"),
                                               F.substring(a["rest"], F.lit(2), F.length(a["rest"])).alias("rest")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["rest"].alias("rest"))), lambda a: a["out"])
    cased = F.when(surface == F.lower(surface), new).otherwise(_each_char(new, lambda c, i: F.when(
        F.substring(surface, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)))
    return (F.when(kind.isin(DIGIT_KINDS) & (F.length(bare) == F.length(F.regexp_replace(surface, "[^0-9]", ""))),
                   filled)
            .when(kind == "iban", spaced).when(kind.isin("person", "ip", *DIGIT_KINDS), new).otherwise(cased))


def _draw_distinct(entities: DataFrame, draw, attempts: int) -> tuple[DataFrame, DataFrame]:
    """(kind, value, new) of the entities whose ``draw(attempt)`` is taken, and those that are left after all attempts.

    A draw is taken when no other entity drew it (ties: the smaller value keeps
    it), no accepted surrogate equals it and it is no real entity of the corpus.
    The others draw again.
    """
    pending, accepted = entities, []
    real = entities.select("kind", F.col("value").alias("new"))
    for attempt in range(attempts):
        drawn = pending.withColumn("new", draw(attempt))
        first = drawn.groupBy("kind", "new").agg(F.min("value").alias("value"))
        taken = reduce(DataFrame.unionByName, [a.select("kind", "new") for a in accepted], real)
        good = materialize(first.join(taken, ["kind", "new"], "left_anti").select("kind", "value", "new"), "pii-drawn")
        accepted.append(good)
        pending = materialize(pending.join(good, ["kind", "value"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            break
    return reduce(DataFrame.unionByName, accepted), pending


def assign_surrogates(entities: DataFrame, key: str, attempts: int = ATTEMPTS) -> DataFrame:
    """(kind, value, new): one distinct surrogate for every distinct (kind, value).

    Surnames are drawn first, then persons with the surname they have, and all
    else. What still collides after ``attempts`` draws, in a format with hardly any
    room, gets digits of its own digest appended. The distinct entities are dealt by
    their hash before anything is drawn, so drawing is shared by all tasks however
    few bytes they are.
    """
    spark = entities.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entities = materialize(entities.distinct().repartition(parts, "kind", "value"), "pii-entities")
    persons = entities.where("kind = 'person'")
    surnames = materialize(persons.select(F.lit("surname").alias("kind"), surname_of(F.col("value")).alias("value"))
                           .distinct().repartition(parts, "value"), "pii-surnames")
    families, left = _draw_distinct(surnames, lambda n: new_surname(key, F.col("value"), n), attempts)
    families = families.unionByName(_with_digest(left, key, new_surname(key, F.col("value"), attempts)))
    named = (entities.withColumn("last", F.when(F.col("kind") == "person", surname_of(F.col("value"))))
             .join(families.select(F.col("value").alias("last"), F.col("new").alias("family")), "last", "left")
             .select("kind", "value", "family"))
    named = materialize(named.repartition(parts, "kind", "value"), "pii-named")

    def draw(attempt: int) -> Column:
        kind, value = F.col("kind"), F.col("value")
        return F.when(kind == "person", new_person(key, value, F.col("family"), attempt)).otherwise(
            surrogate(key, kind, value, F.lit(attempt)))
    drawn, left = _draw_distinct(named, draw, attempts)
    return drawn.unionByName(_with_digest(left, key, draw(attempts)))


def _with_digest(entities: DataFrame, key: str, new: Column) -> DataFrame:
    own = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), "kind", "value"), 256), 1, 15), 16, 10)
    return entities.select("kind", "value", F.concat(new, own).alias("new"))


def pseudonymize(docs: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id",
                 attempts: int = ATTEMPTS) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, plus ``n_entities`` (mentions replaced).

    All columns are kept, whatever their names; one named ``n_entities`` is
    replaced. A null text stays null and an empty one empty, both with 0 mentions;
    repeated rows are repeated in the result. The documents that may have an entity
    are cut once into mentions and the gaps between them, and written; only they
    are shuffled: their replacements meet them by a digest of (doc_id, text), so
    copies under different ids do not gather in one task; a mention that is frequent
    in the corpus is one row per document on the join's large side, which adaptive
    execution splits.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    own = uuid.uuid4().hex
    name, cut, gaps, new = (f"{part}-{own}" for part in ("name", "cut", "gaps", "new"))
    docs = docs.select(*columns)
    t = F.col(text)
    hit = materialize(
        docs.where(found(t)).withColumn(name, F.sha2(F.concat_ws(
            "\u0001", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), t), 256))
        .withColumn(cut, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).withColumn(gaps, F.split(t, ANY, -1)).drop(text),
        "pii-cut")
    surface = F.col("surface")
    listed = materialize(
        hit.select(F.col(name).alias("name"), F.explode(F.array_distinct(cut)).alias("surface"))
        .withColumn("kind", kind_of(surface)).where(is_entity(F.col("kind"), surface))
        .withColumn("value", canonical(F.col("kind"), surface)), "pii-mentions")
    drawn = assign_surrogates(listed.select("kind", "value"), key, attempts)
    replaced = (listed.join(drawn, ["kind", "value"])
                .withColumn("shown", dressed(F.col("kind"), surface, F.col("new")))
                .groupBy(F.col("name").alias(name))
                .agg(F.map_from_entries(F.collect_set(F.struct("surface", "shown"))).alias(new)))

    def shown(mention: Column) -> Column:
        return F.try_element_at(F.col(new), mention)
    changed = (hit.join(replaced, name, "left")
               .withColumn("n_entities", F.size(F.filter(cut, lambda m: shown(m).isNotNull())).cast("long"))
               .withColumn(text, F.concat(F.col(gaps)[0], F.array_join(F.transform(
                   F.col(cut), lambda m, i: F.concat(F.coalesce(shown(m), m), F.element_at(F.col(gaps), i + 2))), "")))
               .select(*columns, "n_entities"))
    same = docs.where(~found(t)).withColumn("n_entities", F.lit(0).cast("long"))
    return same.unionByName(changed)
