r"""Operator 7: personal data replaced by surrogates.

Detected entities get keyed replacements of the same type and format: a phone
number keeps its signs and country code, a card number its first digit and a
right check digit, an address of a machine stays routable, keys and passwords
keep each character's class, a mail address its shape under a reserved domain,
a name its script, its gender (from a title or the given name) and its case.

Numbers go through a keyed permutation of their digits (a Feistel network with
cycle walking), so different numbers of a kind always differ; other types are drawn
from a keyed stream. A mention's normal form decides its surrogate (digits of a
number, lower case of an address, each part of a name by itself), so all mentions
of an entity agree in every document, "Mr. Smith" and "John Smith" included.

A person is found by a title, or by a given name of the lists before another
capitalised word that names no place; initials may stand between. All other
capitalised mentions of that given or family name in the same document are replaced
as well ("Smith paid"), unless the document has the word in small letters too
("the stone. Stone Age"); a name that is both there is taken as its first mention
has it. Initials stay.

Gender. In a document a given name has the gender that its titles say most often,
else that of the lists, else none (its surrogate then has no gendered form). Over the
corpus the gender that more documents give a name holds everywhere, so one given name
has one surrogate: documents that see it otherwise learn it as an exception.

Collision check. All distinct entities of the corpus are gathered as a table; a
surrogate that two entities of a type share, or that is itself an entity of the
corpus, is drawn again with the next attempt number for all but one of them, until
none is left. Entities that needed another attempt or another gender are joined to the
documents that mention them; all others are computed where they are found.

Scale. Texts are scanned twice. Documents meet their exceptions, if there are any,
in a join whose small side is a written table of known size: Spark broadcasts it
below its threshold, and shuffles the texts once beyond it. The entity table is
aggregated before its shuffle, so an address in a third of all documents is one
row a task.

Defined results: null texts stay null, empty and clean texts stay as they are;
repeated rows get the same text; rows with a null ``doc_id`` are handled
together; an empty table gives no rows; other columns pass through; one named
``entities`` is replaced by the array of ``(type, start, end)`` in code points of
the new text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from dataclasses import replace as replace_

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import frozen, scratch, table, trimmed

KEY = "surrogates"
FOUND = "doc_id long, type string, value string, gender string"
SPANS = "array<struct<type:string,start:int,end:int>>"

# Titles by gender, given names by script and gender, and
# syllables that make further names.
TITLES = {"Mr": "m", "Herr": "m", "Señor": "m", "Monsieur": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Señora": "f", "Madame": "f", "Mme": "f", "Dr": "", "Prof": "", "г-н": "m", "г-жа": "f"}
GIVEN = {
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Julia Laura Sophie Emma Charlotte Camille Lucía Carmen Isabel Claudia Katharina Johanna".split(),
    ("latin", "m"): "James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Peter Klaus Wolfgang Jürgen François Jacques Miguel Carlos Pablo Javier".split(),
    ("cyrillic", "f"): "Мария Анна Ольга Елена Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Александр Сергей Дмитрий Алексей Андрей Михаил Николай Владимир Павел".split(),
    ("greek", "f"): "Ελένη Αικατερίνη Βασιλική Σοφία Γεωργία".split(),
    ("greek", "m"): "Γεώργιος Δημήτριος Κωνσταντίνος Νικόλαος Παναγιώτης".split(),
}
#: Given names that surrogates are drawn from; none of those above, which corpora hold.
POOL = {
    ("latin", "f"): "Adelheid Amalia Annika Apollonia Beatrix Benedicta Birgitta Celestina Clementine Constanza Cordula Cosima Daphne Delphine Dorothea Edwina Eleonora Elfriede Ernestina Esmeralda Eugenia Felicitas Florentina Friederike Georgina Gwendolyn Henrietta Hermine Hildegard Ignacia Isadora Josefina Kunigunde Leocadia Leopoldina Lucinda Ludmilla Magdalena Marcelina Melisande Minerva Octavia Odette Ottilie Philippa Philomena Rosalinde Rosamund Sabina Seraphina Sibylla Theodora Thusnelda Ulrike Ursula Valentina Verena Wilhelmina Winifred Zenobia".split(),
    ("latin", "m"): "Adalbert Alaric Ambrosio Anselm Archibald Aurelio Balthasar Barnaby Bartholomew Benedikt Bonifacio Casimir Cedric Clemente Cornelius Dagobert Desmond Egbert Eleazar Emeric Erasmus Eusebio Everard Fabrizio Ferdinand Florian Fridolin Gaspard Gerhardt Gottfried Hadrian Hartmut Horatio Ignatius Isidor Jocelyn Kasimir Konstantin Lambert Leander Leopold Ludovico Lysander Marcellus Maximilian Nepomuk Norbert Octavio Orlando Percival Quentin Rainier Roderick Rupert Sebastian Sigismund Tancredo Thaddeus Ulrich Wendelin".split(),
    ("cyrillic", "f"): "Аглая Антонина Варвара Василиса Виолетта Евдокия Зинаида Клавдия Лукерья Пелагея Прасковья Серафима Ульяна Федосья".split(),
    ("cyrillic", "m"): "Аполлон Аристарх Валерьян Вениамин Игнат Иннокентий Лаврентий Мефодий Мстислав Никодим Порфирий Савелий Тихон Фаддей".split(),
    ("greek", "f"): "Ευανθία Θεοδώρα Καλλιόπη Πηνελόπη Ραλλού Φιλίππα Χαρίκλεια".split(),
    ("greek", "m"): "Αλκιβιάδης Θεόφιλος Λεωνίδας Μιλτιάδης Περικλής Σωκράτης Φίλιππος".split(),
}
#: What a capitalised word after a given name names, if it is no family name.
PLACES = set("river lake street road avenue boulevard square bridge county city town university college school church cathedral hospital station airport bay island mountain mount valley park hall house castle prize award day age".split())
SYLLABLES = {
    "latin": "bar bel bor cal cor dal dor fal fen gar gil hal hol kel kir lam lor mar mel nor pel ral rim sal sel tal tor val ver wil".split(),
    "cyrillic": "бар бел вол гор дал зор кар лан мар нов пет рам сол тар фед".split(),
    "greek": "βαρ γαλ δημ καλ κορ λαμ μαρ νικ παλ ραλ σολ ταρ φιλ".split(),
}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "", ("greek", "f"): "α", ("greek", "m"): "ος"}

_LEXICON = {name.casefold(): kind for kind, names in GIVEN.items() for name in names}
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈ-Ώ"
_NAME = rf"[{_UPPER}][^\W\d_]+(?:[-'’][{_UPPER}][^\W\d_]+)?"
_ENTITY = re.compile(
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<key>(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9]))"
    r"|(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)(?P<secret>(?=\S*\d)[A-Za-z0-9+/_.~!@#$%^&*-]{8,})"
    r"|(?P<phone>(?<![\w.+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\+[2-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){2,3}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![\d-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))")
_INITIALS = rf"(?: [{_UPPER}]\.)*"
_PERSON = re.compile(rf"(?:\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?{_INITIALS} (?P<one>{_NAME})(?:{_INITIALS} (?P<two>{_NAME}))?)|\b(?P<given>{_NAME})(?={_INITIALS} (?P<family>{_NAME}))")
_BARE = re.compile(rf"(?<![^\W\d_]){_NAME}")
_PART = re.compile(r"[^-'’]+")
#: Words that a sentence opens with and that are no names when they stand alone or after an initial.
_NO_NAME = set("the an and but or if in on at to of for from with by as is it he she we you they this that these those there then when who what der die das und el la los las les le il elle et".split())
_HINT = re.compile(r"[@]|\d[\d .()-]{5}|AKIA|[=:]")


@dataclass(frozen=True)
class Mention:
    """A detected entity: ``value`` is its normal form, ``text[start:end]`` is replaced."""

    type: str
    value: str
    start: int
    end: int
    gender: str = ""


def luhn_digit(digits: str) -> str:
    """Check digit that makes ``digits`` plus itself valid."""
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return len(text) >= 15 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def script_of(name: str) -> str:
    c = ord(name[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _after_initial(text: str, m: re.Match, part: str) -> bool:
    """Whether an initial ends a sentence, and ``part`` only opens the next."""
    return text[m.start(part) - 2] == "." and m[part].casefold() in _NO_NAME


def _bare(text: str, found: list[Mention]) -> list[Mention]:
    """Capitalised mentions of the given and family names of the persons found."""
    names: dict[str, str] = {}
    for m in found:
        if m.type in ("family", "given"):
            names.setdefault(m.value, m.type)
    if names:  # words that the text also writes small are words
        small = {w for w in re.findall(r"[^\W\d_]+", text) if w.islower()}
        names = {n: kind for n, kind in names.items() if n not in small and n not in _NO_NAME}
    out = []
    for m in _BARE.finditer(text) if names else ():
        whole = m[0].casefold()
        if whole in names:
            out.append(Mention(names[whole], whole, *m.span()))
        else:
            for part in _PART.finditer(text, *m.span()):
                if (value := part[0].casefold()) in names:
                    out.append(Mention(names[value], value, *part.span()))
    return out


def _gendered(found: list[Mention]) -> list[Mention]:
    """Given names with the gender that the document gives them, the same for each of their mentions."""
    votes: dict[str, list[str]] = {}
    for m in found:
        if m.type == "given":
            votes.setdefault(m.value, []).extend(m.gender)
    of = {n: max("fm", key=v.count) if v.count("f") != v.count("m") else _LEXICON.get(n, ("", v[0] if v else ""))[1] for n, v in votes.items()}
    return [replace_(m, gender=of[m.value]) if m.type == "given" else m for m in found]


def find(text: str) -> list[Mention]:
    """Mentions of a text, in order and without overlaps."""
    out = []
    if _HINT.search(text):
        for m in _ENTITY.finditer(text):
            kind, raw = m.lastgroup, m[m.lastgroup]
            start, end = m.span(kind)
            digits = re.sub(r"\D", "", raw)
            value = raw
            if kind == "card":
                if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
                    continue
                value = digits
            elif kind in ("phone", "ssn"):
                value = ("+" if raw[0] == "+" else "") + digits
            elif kind == "email":
                value = raw.lower()
            elif kind == "iban":
                value = raw.replace(" ", "")
                if not _iban_ok(value):
                    continue
            elif kind == "secret":
                value = raw.rstrip(".!")
                end -= len(raw) - len(value)
            out.append(Mention(kind, value, start, end))
    taken = 0
    for m in _PERSON.finditer(text):
        if m["title"]:
            if _after_initial(text, m, "one"):
                continue
            gender = TITLES[m["title"]]
            pair = m["two"] and not _after_initial(text, m, "two")
            given, family = ("one", "two") if pair else (None, "one")
            if given:
                out.append(Mention("given", m[given].casefold(), *m.span(given), gender))
            out.append(Mention("family", m[family].casefold(), *m.span(family)))
        elif m["given"].casefold() in _LEXICON and m["family"].casefold() not in PLACES and not _after_initial(text, m, "family"):
            out.append(Mention("given", m["given"].casefold(), *m.span("given")))
            out.append(Mention("family", m["family"].casefold(), *m.span("family")))
    out += _bare(text, out)
    result = []
    for mention in sorted(out, key=lambda x: (x.start, -x.end)):
        if mention.start >= taken:
            result.append(mention)
            taken = mention.end
    return _gendered(result)


def _random(key: str, *what) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, what)).encode(), key=hashlib.sha256(key.encode()).digest()).digest(), "big")


def permuted(digits: str, key: str, tweak: str) -> str:
    """Keyed permutation of the digit strings of a length (Feistel network)."""
    n = len(digits)
    if n < 2:
        return str((int(digits or 0) + _random(key, tweak, n)) % 10) if digits else ""
    left, right = n // 2, n - n // 2
    a, b = int(digits[:left]), int(digits[left:])
    for r in range(0, 10, 2):
        a = (a + _random(key, tweak, n, r, b)) % 10**left
        b = (b + _random(key, tweak, n, r + 1, a)) % 10**right
    return f"{a:0{left}d}{b:0{right}d}"


def _walk(digits: str, key: str, tweak: str, allowed) -> str:
    """The permutation, walked on until its value is allowed: a permutation of those."""
    if not allowed(digits):
        return permuted(digits, key, tweak + "/other")
    while True:
        digits = permuted(digits, key, tweak)
        if allowed(digits):
            return digits


def _same_class(value: str, key: str, tweak: str) -> str:
    """Characters drawn from the classes of the value's own."""
    drawn = _random(key, tweak, value) | _random(key, tweak, value, "more") << 512
    hexadecimal = re.fullmatch(r"(?=.*[a-f])(?=.*[0-9])[0-9a-f]+", value) is not None
    out = []
    for k, c in enumerate(value):
        if k % 100 == 99:
            drawn = _random(key, tweak, value, k) | _random(key, tweak, value, k, "more") << 512
        pool = "0123456789abcdef" if hexadecimal else "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else c
        drawn, at = divmod(drawn, len(pool))
        out.append(pool[at])
    return "".join(out)


def _name(kind: str, value: str, key: str, attempt: int, gender: str) -> str:
    script = script_of(value)
    drawn = _random(key, kind, value, attempt)
    if gender and attempt < 8:  # a list may run out of names; syllables do not
        names = POOL[script, gender]
        return names[drawn % len(names)]
    parts = SYLLABLES[script]
    out = ""
    for _ in range(3 + attempt // 8):
        drawn, at = divmod(drawn, len(parts))
        out += parts[at]
    return (out + (ENDINGS[script, gender] if gender else "")).capitalize()


def surrogate(kind: str, value: str, key: str = KEY, attempt: int = 0, gender: str = "") -> str:
    """Replacement of an entity, in its normal form."""
    tweak = f"{kind}/{attempt}"
    if kind == "phone":
        plus = value[0] == "+"
        digits = value.lstrip("+")
        country = ("1" if digits[0] == "1" else digits[:2]) if plus else ""
        rest = digits[len(country):]
        if len(rest) == 10 and rest[3:6] == "555":  # numbers kept for fiction stay such
            new = _walk(rest[:3] + rest[6:], key, tweak, lambda d: d[0] > "1")
            return "+" * plus + country + new[:3] + "555" + new[3:]
        return "+" * plus + country + _walk(rest, key, tweak, lambda d: d[0] > "1")
    if kind == "ssn":
        return _walk(value, key, tweak, lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000")
    if kind == "card":
        body = value[0] + permuted(value[1:-1], key, tweak)
        return body + luhn_digit(body)
    if kind == "ip":
        number = 0
        for octet in value.split("."):
            number = number << 8 | int(octet)
        fine = lambda x: 1 <= x >> 24 <= 223 and x >> 24 not in (10, 127)
        was_fine = fine(number)
        while True:
            a, b = number >> 16, number & 0xFFFF
            for r in range(0, 8, 2):
                a = (a + _random(key, tweak, was_fine, r, b)) & 0xFFFF
                b = (b + _random(key, tweak, was_fine, r + 1, a)) & 0xFFFF
            number = a << 16 | b
            if fine(number) == was_fine:
                return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    if kind == "iban":
        body = _same_class(value[4:], key, tweak)
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "key":
        return value[:4] + _same_class(value[4:], key, tweak)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        end = labels[-1] if labels[-1] in ("com", "net", "org") else "com"
        host = _same_class("-".join(labels[:-2]) or labels[0], key, f"{tweak}/host")
        return f"{_same_class(local, key, f'{tweak}/{domain}')}@{host.strip('-') or 'mail'}.example.{end}"
    if kind == "secret":
        return _same_class(value, key, tweak)
    return _name(kind, value, key, attempt, gender)


def dressed(mention: str, normal: str) -> str:
    """A surrogate in the format of the mention it replaces."""
    digits = normal.lstrip("+")
    if re.fullmatch(r"\d+", digits) and re.sub(r"\D", "", mention) != mention:
        rest = iter(digits)
        return re.sub(r"\d", lambda _: next(rest, "0"), mention)
    if " " in mention:  # an account number in groups
        rest = iter(normal)
        return "".join(c if c == " " else next(rest, "") for c in mention)
    if "@" in mention or mention[:1].isalpha() and mention.isalpha():
        return normal.upper() if mention.isupper() and len(mention) > 1 else normal
    return normal


def replace(text: str, key: str = KEY, others: dict[tuple[str, str], tuple[int, str]] | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """Text with surrogates, and where they lie in it. ``others``: attempt and gender of
    entities that the corpus decides."""
    out, spans, last, length = [], [], 0, 0
    for m in find(text):
        new = dressed(text[m.start : m.end], surrogate(m.type, m.value, key, *(others or {}).get((m.type, m.value), (0, m.gender))))
        out += [text[last : m.start], new]
        length += m.start - last
        spans.append((m.type, length, length + len(new)))
        length += len(new)
        last = m.end
    return "".join([*out, text[last:]]) if out else text, spans


def find_entities(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``type``, normal ``value`` and the document's ``gender`` of the entities, once a document row."""

    def scan(batches):
        for batch in batches:
            rows = [(d, *e) for d, t in zip(batch.column(0).to_pylist(), batch.column(1)) for e in dict.fromkeys((m.type, m.value, m.gender) for m in find(t.as_py() or ""))]
            ids, *texts = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, pa.string()) for c in texts]], names=["doc_id", "type", "value", "gender"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(scan), FOUND)


def decided_genders(found: DataFrame) -> DataFrame:
    """Distinct entities (type, value) with the gender that more documents give each; none
    where no document gives one, the female form where as many give either."""
    votes = found.groupBy("type", "value").agg(F.count_if(F.col("gender") == "f").alias("f"), F.count_if(F.col("gender") == "m").alias("m"))
    gender = F.when(F.col("f") + F.col("m") == 0, F.lit("")).when(F.col("f") >= F.col("m"), F.lit("f")).otherwise(F.lit("m"))
    return votes.select("type", "value", gender.alias("gender"))


def checked_surrogates(entities: DataFrame, key: str = KEY, draw=surrogate) -> DataFrame:
    """``type``, ``value``, ``gender``, ``attempt``, ``surrogate`` of distinct entities (type, value, gender):
    no two of a type share one, and none is an entity of that type itself."""
    def drawn(kinds: pa.Array, values: pa.Array, attempts: pa.Array, genders: pa.Array) -> pa.Array:
        return pa.array([draw(k, v, key, a, g) for k, v, a, g in zip(kinds.to_pylist(), values.to_pylist(), attempts.to_pylist(), genders.to_pylist())], pa.string())

    drawn = F.arrow_udf(drawn, "string")
    given = entities.groupBy("type", "value").agg(F.max("gender").alias("gender"), F.lit(0).alias("attempt"))
    now = frozen(given.withColumn("surrogate", drawn("type", "value", "attempt", "gender")))
    while True:
        real = now.select(F.col("type").alias("real_type"), F.lower("value").alias("real"))
        same = Window.partitionBy("type", F.lower("surrogate")).orderBy("attempt", "value")
        placed = now.withColumn("place", F.row_number().over(same))
        against = placed.join(real, (F.lower("surrogate") == F.col("real")) & (F.col("type") == F.col("real_type")), "left")
        again = against.where((F.col("place") > 1) | F.col("real").isNotNull()).select("type", "value", (F.col("attempt") + 1).alias("next"))
        again = frozen(again.distinct())
        if again.isEmpty():
            return now
        marked = now.join(again, ["type", "value"], "left")
        now = frozen(marked.select(
            "type", "value", "gender", F.coalesce("next", "attempt").alias("attempt"),
            F.when(F.col("next").isNull(), F.col("surrogate")).alias("old")).withColumn(
                "surrogate", F.coalesce("old", drawn("type", "value", "attempt", "gender"))).drop("old"))


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and their places in ``entities``."""
    found = frozen(find_entities(docs).distinct())
    decided = frozen(checked_surrogates(decided_genders(found), key).select("type", "value", F.col("gender").alias("right"), "attempt"))
    kind = docs.sparkSession.createDataFrame([], "other array<struct<type:string,value:string,attempt:int,gender:string>>").schema["other"].dataType

    def rewrite(texts: pa.Array, exceptions: pa.Array) -> pa.Array:
        out = []
        for text, other in zip(texts, exceptions.to_pylist()):
            text = text.as_py()
            if text is None:
                out.append(None)
                continue
            new, spans = replace(text, key, {(e["type"], e["value"]): (e["attempt"], e["gender"]) for e in other or ()})
            out.append({"text": new, "entities": [{"type": k, "start": a, "end": b} for k, a, b in spans]})
        return pa.array(out, pa.struct([("text", pa.string()), ("entities", pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]))

    rewritten = F.arrow_udf(rewrite, f"struct<text:string,entities:{SPANS}>")
    # the input row travels in one struct, so no column of it can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    again = decided.where("attempt > 0").select("type", "value").unionByName(
        found.join(decided, ["type", "value"]).where(F.col("gender") != F.col("right")).select("type", "value"))
    again = frozen(decided.join(again.distinct(), ["type", "value"]))
    if again.isEmpty():
        joined = rows.withColumn("other", F.lit(None).cast(kind))
    else:
        # written, so that Spark knows its size and shuffles texts only if it is large
        path = scratch(docs.sparkSession, "exceptions")
        lists = found.select("doc_id", "type", "value").distinct().join(again, ["type", "value"]).groupBy(F.col("doc_id").alias("id")).agg(
            F.collect_list(F.struct("type", "value", "attempt", F.col("right").alias("gender"))).alias("other"))
        lists.write.parquet(path)
        lists = docs.sparkSession.read.parquet(path)
        joined = rows.join(lists, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")), "left")
    done = joined.select("row", rewritten(F.col("row.text").cast("string"), F.col("other")).alias("new"))
    changed = {"text": F.col("new.text"), "entities": F.col("new.entities")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("new.text").cast(docs.schema["n_chars"].dataType)
    columns = [*docs.columns, *(["entities"] if "entities" not in docs.columns else [])]
    return done.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in columns])


def op7_pii(spark, sf_dir) -> DataFrame:
    """Every document with surrogates for its personal data."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
