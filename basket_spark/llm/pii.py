"""Personal data replaced by keyed surrogates of the same type, script, format and gender.

A surrogate comes from a keyed permutation of all values of the entity's format (so many digits here, letters there),
conjugated with a step of one: it has a single cycle, so no value keeps itself, equal entities get equal surrogates in
every document, and different ones different surrogates, without any table of entities. Known first names move along
the list of their gender and script; other names keep their last letter, as endings carry gender (-a, -ova, -ska). Words
of a name that was found get their surrogates wherever else in the document they stand as capitalised words or in
capitals.

There is no default key: whoever has it can undo the permutations. ``session_key`` gives the session's.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import few, narrow

#: The session's key; Spark hides settings of such a name in its logs.
KEY_SETTING = "spark.basket.surrogate.secret"

_FIRST = {
    ("f", "latin"): "Anna Maria Laura Sophie Emma Julia Clara Marta Elena Alice Claire Camille Lucia Carmen Isabel Hannah Greta Helga Ingrid Petra Susan Karen Linda Emily Sarah Mary Patricia Jennifer Elizabeth Barbara Jessica Nancy Margaret Sandra Ashley Kimberly Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Cynthia Kathleen Amy Angela Olivia Charlotte Amelia Sophia Isabella Gudrun Ursula Sabine Monika Renate Brigitte Heike Andrea Katharina Johanna Franziska Lena Lea Marie Catherine Nathalie Isabelle Sylvie Martine Françoise Chloé Giulia Francesca Chiara Paola Ana Sofía Lucía Valentina Gabriela Fernanda Agnieszka Katarzyna Małgorzata Ingeborg Astrid Freya Aisha Fatima Priya Mei Yuki".split(),
    ("m", "latin"): "John Peter Thomas Michael David James Robert William Paul Hans Karl Klaus Jürgen Stefan Pierre Jean Luc Michel Antoine Carlos Miguel Javier Diego Pablo Andrés Richard Joseph Charles Christopher Daniel Matthew Anthony Steven Andrew Kenneth Joshua Kevin Brian George Timothy Ronald Edward Jason Jeffrey Ryan Jacob Nicholas Jonathan Benjamin Samuel Gregory Alexander Patrick Oliver Henry Noah Liam Wolfgang Jürg Günter Dieter Uwe Andreas Matthias Markus Sebastian Florian Lukas Felix Jonas Philippe Nicolas Laurent Olivier François Jacques Henri Louis Giovanni Marco Luca Francesco Alessandro José Juan Luis Antonio Manuel Fernando Rafael Piotr Paweł Krzysztof Lars Sven Erik Mohammed Ahmed Omar Rajesh Hiroshi Wei".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия Анастасия Людмила Галина Дарья Ксения Валентина".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Владимир Михаил Александр Евгений Юрий Виктор Игорь Олег Максим".split(),
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Δήμητρα Βασιλική Ιωάννα".split(),
    ("m", "greek"): "Γεώργιος Ιωάννης Νικόλαος Δημήτριος Κωνσταντίνος Παναγιώτης Αθανάσιος Βασίλειος".split(),
}
#: Names with other accents than these lists', or none, stand at their end: María, Nicolás, Jurgen, Francois.
_ACCENTED = {("f", "latin"): "María Ángela Mónica Verónica Inés Raquel Rocío Noemí Débora Júlia Mária Helène Hélène Irène Zoë Zoé Anaïs Thérèse Mélanie Amélie Céline Stéphanie Valérie Bärbel Käthe".split(), ("m", "latin"): "Nicolás Sebastián Martín Tomás Jesús Ángel Óscar Víctor Raúl Adrián Félix Hernán Germán Joaquín Julián Iván Rubén César Álvaro René André Jérôme Frédéric Stéphane Rémi Gérard Björn Jörg Götz".split()}


def _plain(name: str) -> str:
    """The name without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", name.replace("ł", "l")) if not unicodedata.combining(c))


for _group, _names in _ACCENTED.items():
    _FIRST[_group] += _names
    _FIRST[_group] += sorted({p for n in _FIRST[_group] if (p := _plain(n)) not in _FIRST[_group]})
_PLACE = {name: (group, i) for group, names in _FIRST.items() for i, name in enumerate(names)}
_TITLE = r"\b(?:Mrs?|Ms|Miss|Dr|Prof|Herrn?|Frau|Mme|Mlle|Monsieur|Madame|Señora?|Sra|Sr)\b\.?"
_CAPITAL, _SMALL = "[A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆ-Ώ]", "[a-zß-öø-ÿа-яёά-ώ]"
#: A word of a name: Keller, O'Neil, McDonald.
_WORD = rf"(?:[A-ZÀ-ÖØ-Þ]['’])?{_CAPITAL}{_SMALL}{{1,30}}(?:{_CAPITAL}{_SMALL}{{1,30}})?"
_NAME = rf"{_WORD}(?:-{_WORD})?"
_KNOWN = "|".join(sorted(_PLACE))
#: Phone numbers without a country code: 555-123-4567 and 1-555-123-4567, 01 23 45 67 89, 030 1234567, 020 7946 0958.
_NATIONAL = r"(?:1[ .-])?[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3}[ -])[0-9]{4}|0[1-9](?:[ .-][0-9]{2}){4}|0[1-9][0-9]{1,4}[ /-][0-9]{5,8}|0[1-9][0-9]{1,3}[ -][0-9]{3,4}[ -][0-9]{3,4}"
_is_national = re.compile(_NATIONAL).fullmatch
_is_hex = re.compile("[0-9a-f]+").fullmatch


def _is_ip6(value: str) -> bool:
    """An address of three groups at least, one with a digit, and no time of day or MAC address."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return sum(map(bool, value.split(":"))) > 2 and any(map(str.isdigit, value))


#: A long secret is replaced in blocks of so many characters.
_BLOCK = 512

#: Type, pattern, in order of precedence. A group named v, if any, is what gets replaced.
KINDS: list[tuple[str, str]] = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,63}"),
    ("secret", r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|(?i:(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}(?:[\"'](?P<v1>[^\"'\s]{8,})[\"']|(?P<quote>[\"'])(?P<v4>[^\"'\r\n]{8,200})(?P=quote)|(?=[^\s\"'<>(){}\[\],;]{0,256}[0-9])(?P<v3>[^\s\"'<>(){}\[\],;]{7,}[^\s\"'<>(){}\[\],;.:!?])))"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"(?<![0-9.])(?<![Vv]ersion )(?<![Rr]elease )(?<![A-Za-z])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("ip6", r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){2,7}:)(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z])(?:[3-6](?:[ -]?[0-9]){12,18}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)(?:[ -]?[0-9]){12})(?![0-9A-Za-z])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", rf"(?<![0-9A-Za-z.,/+-])(?<![0-9] )(?:{_NATIONAL})(?![0-9A-Za-z]|[.,/-][0-9])|" r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"),
    ("name", rf"(?:{_TITLE}\s(?P<v2>(?:(?:{_KNOWN}|[A-Z]\.)\s)*{_NAME}(?:\s{_NAME})?))|\b(?=[A-ZΑ-ΩΆА-Я])(?:{_KNOWN})(?:-{_WORD})?(?:\s(?:{_KNOWN}|[A-Z]\.))*\s{_NAME}"),
]
_MENTION = re.compile(rf"(?<![\w@'’-])(?:{_NAME}|{_CAPITAL}{{3,31}}(?:-{_CAPITAL}{{2,31}})?)(?![\w@])")
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS))
#: What texts must hold for the patterns to find anything; run by Arrow over a whole batch.
_GATE = rf"[0-9]|@|\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Herrn|Frau|Mme|Mlle|Monsieur|Madame|Señora?|Sra?)\b|(?i:token|secret|passw|key)|(?:{_KNOWN})[\s-]"

_DIGIT, _LOWER, _UPPER, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
_ALPHABETS = {c: a for a in (_DIGIT, _LOWER, _UPPER, "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "άέήίόύώ", "àáâãäåæèéêëìíîïòóôõöøùúûüý", "çðñþ", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜÝ", "ÇÐÑÞ") for c in a}
#: Signs of secrets; those of a group become each other, "." and "=" stay.
_SIGNS = {c: a for a in ("!?:", "+/", "-_", "#$%&*@^`|~\\", "()[]{}<>,;") for c in a}


@lru_cache(1 << 14)
def _alphabet(c: str) -> str:
    """What may stand for a character of a secret: its letters, signs, or its kind among the 128 code points around it."""
    if (known := _ALPHABETS.get(c) or _SIGNS.get(c)) or c.isascii():
        return known or ""
    start, kind = ord(c) & ~127, unicodedata.category(c)
    return "".join(x for x in map(chr, range(start, start + 128)) if unicodedata.category(x) == kind and x not in _ALPHABETS)



class Surrogates:
    """Keyed surrogates; equal values of a type always get the same."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.of: Callable[[str, str], str] = lru_cache(1 << 16)(self._of)
        self.word: Callable[[str], str] = lru_cache(1 << 16)(self._name)

    def _round(self, tweak: bytes, i: int, half: int, x: int) -> int:
        data = b"%d|%d|" % (i, x) + tweak
        size = max(8, half.bit_length() // 8 + 8)
        return int.from_bytes(b"".join(hashlib.blake2b(data + b"|%d" % k, digest_size=64, key=self.key).digest() for k in range(-(-size // 64))), "big") % half

    def _permute(self, tweak: bytes, n: int, x: int, back: bool = False) -> int:
        """A keyed permutation of 0..n-1: a Feistel network on the next square, walked until it is inside."""
        half = max(2, int((n - 1) ** 0.5) if n < 1 << 50 else 1 << (n.bit_length() + 1) // 2)
        while half * half < n:
            half += 1
        while True:
            a, b = divmod(x, half)
            for i in range(5, -1, -1) if back else range(6):
                if back:
                    a, b = (b - self._round(tweak, i, half, a)) % half, a
                else:
                    a, b = b, (a + self._round(tweak, i, half, b)) % half
            x = a * half + b
            if x < n:
                return x

    def number(self, tweak: bytes, n: int, x: int) -> int:
        """Another number below n (the same only for n = 1); different numbers stay different."""
        return x if n < 2 else self._permute(tweak, n, (self._permute(tweak, n, x, back=True) + 1) % n)

    def text(self, kind: str, value: str, alphabets: list[str], stays: Callable[[str], bool] = lambda _: True) -> str:
        """``value`` with each character that its alphabet has replaced; "" leaves a character.

        Values for which ``stays`` holds, ``value`` among them, only become each other: the cycle is walked on to the next
        of them, so what has surrogates of another kind never meets these.
        """
        n, x = 1, 0
        for c, a in zip(value, alphabets, strict=True):
            if a:
                n, x = n * len(a), x * len(a) + a.index(c)
        shape = "".join(c if not a else f"<{a[0]}{len(a)}>" for c, a in zip(value, alphabets, strict=True))
        while True:
            x, rest, out = (y := self.number(f"{kind}|{shape}".encode(), n, x)), y, []
            for c, a in zip(reversed(value), reversed(alphabets), strict=True):
                if a:
                    rest, i = divmod(rest, len(a))
                    c = a[i]
                out.append(c)
            if stays(new := "".join(reversed(out))):
                return new

    def _of(self, kind: str, value: str) -> str:
        plain = [_ALPHABETS.get(c, "") for c in value]
        if kind == "email":
            end = value.rindex(".")  # the top-level domain stays
            return self.text(kind, value[:end], plain[:end]) + value[end:]
        if kind == "ip":
            parts = [int(x) for x in value.split(".")]
            n = self.number(b"ip", 1 << 32, sum(x << 8 * (3 - i) for i, x in enumerate(parts)))
            return ".".join(str(n >> 8 * (3 - i) & 255) for i in range(4))
        if kind == "ip6":
            return self._ip6(value)
        if kind == "card":
            return self._card(value, plain)
        if kind == "phone":
            start = re.match(r"\+[0-9]{1,3}(?=[^0-9])", value)  # the country code stays
            start = start.end() if start else 0
            if _is_national(value):
                return self.text(kind, value, plain, lambda new: bool(_is_national(new)))
            return value[:start] + self.text(kind, value[start:], plain[start:])
        if kind == "iban":
            return self._iban(value, plain)
        if kind == "secret":
            start, plain = 4 if re.match("AKIA|gh._", value) else 0, [_alphabet(c) for c in value]
            return value[:start] + "".join(self._secret(value[i : i + _BLOCK], plain[i : i + _BLOCK], bool(start)) for i in range(start, len(value), _BLOCK))
        if kind == "name":
            return re.sub(r"\S+", lambda m: self.word(m[0]), value)
        return self.text(kind, value, plain)

    def _secret(self, block: str, plain: list[str], any_form: bool) -> str:
        """Hexadecimal blocks become hexadecimal ones and others don't, so a whole value stays what it is."""
        if not any_form and _is_hex(block):
            return self.text("secret", block, [_HEX] * len(block))
        return self.text("secret", block, plain, lambda new: any_form or not _is_hex(new))

    def _ip6(self, value: str) -> str:
        """In small letters, in capitals, or letters as they stand where both occur: none becomes one of another kind."""
        small, capital = value.lower() == value, value.upper() == value
        if small or capital:
            digits = _HEX if small else _HEX.upper()
            return self.text("ip6", value, ["" if c == ":" else digits for c in value], lambda new: _is_ip6(new) and (small or new.lower() != new))
        letters = {c: a for a in (_DIGIT, "abcdef", "ABCDEF") for c in a}
        return self.text("ip6", value, [letters.get(c, "") for c in value], _is_ip6)

    def _name(self, word: str) -> str:
        if word in _PLACE:
            group, i = _PLACE[word]
            names = _FIRST[group]
            return names[self.number(f"first|{group}".encode(), len(names), i)]
        vowels, swap = "aeiou", []
        for c in word:
            a = _ALPHABETS.get(c, "")
            if a in (_LOWER, _UPPER):  # a vowel for a vowel, so that it can be said
                same = [x for x in a if (x.lower() in vowels) == (c.lower() in vowels)]
                a = "".join(same)
            swap.append(a)
        if len(word) > 3:
            swap[-1] = ""
        return self.text("surname", word, swap, lambda new: new not in _PLACE)

    @staticmethod
    def _luhn(digits: list[int]) -> int:
        return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10

    def _card(self, value: str, plain: list[str]) -> str:
        """The issuer's digit stays (all four of the series 2221 to 2720), and so does whether the check digit is right."""
        head = 4 if value[0] == "2" else 1
        digits = [int(c) for c in value if c.isdigit()]
        if self._luhn(digits):
            return value[:head] + self.text("card", value[head:], plain[head:], lambda new: self._luhn([int(c) for c in value[:head] + new if c.isdigit()]) != 0)
        last = max(i for i, c in enumerate(value) if c.isdigit())
        out = value[:head] + self.text("luhn", value[head:last], plain[head:last])
        body = [int(c) for c in out if c.isdigit()]
        return out + str(-self._luhn([*body, 0]) % 10) + value[last + 1 :]

    def _iban(self, value: str, plain: list[str]) -> str:
        """The country stays, and so does whether the check digits are right."""
        def rest(text: str) -> int:
            moved = text.replace(" ", "")
            return int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97

        if rest(value) != 1:
            return value[:2] + self.text("iban", value[2:], plain[2:], lambda new: rest(value[:2] + new) != 1)
        body = self.text("iban97", value[4:], plain[4:])
        return f"{value[:2]}{98 - rest(value[:2] + '00' + body):02d}{body}"

    @staticmethod
    def _with_mentions(text: str, places: list[tuple[int, int, str]], again: dict[str, str], kinds: Counter) -> list[tuple[int, int, str]]:
        """The places and, between them, the words that stand in ``again``."""
        out, at = [], 0
        for place in [*places, (len(text), len(text), "")]:
            for m in _MENTION.finditer(text, at, place[0]):
                if m[0] in again:
                    out.append((m.start(), m.end(), again[m[0]]))
                    kinds["name"] += 1
            out.append(place)
            at = place[1]
        return out

    def apply(self, text: str) -> tuple[str, Counter]:
        """The text with surrogates, and how many entities of each type it had.

        Raises if two entities of the text came to one surrogate, which the permutations rule out.
        """
        kinds: Counter = Counter()
        given: dict[tuple[str, str], str] = {}
        places: list[tuple[int, int, str]] = []
        for m in _ANY.finditer(text):
            kind = next(k for k, _ in KINDS if m[k] is not None)
            part = next((g for g in ("v1", "v2", "v3", "v4") if m[g]), 0)
            value, new = m[part], None
            if kind == "ip6" and not _is_ip6(value):
                pass
            elif kind != "card" or value[0] != "2" or not self._luhn([int(c) for c in value if c.isdigit()]):
                new = self.of(kind, value)
            if new is None or new == value:  # a number like any other; a secret of dots
                places.append((m.start(), m.end(), m[0]))
                continue
            kinds[kind] += 1
            given[kind, value] = new
            places.append((m.start(), m.end(), text[m.start() : m.start(part)] + new + text[m.end(part) : m.end()]))
        again = {w: self.of("name", w) for kind, value in given if kind == "name" for w in value.split() if len(w) > 2}
        again |= {w.upper(): new.upper() for w, new in again.items()}
        if again:
            places = self._with_mentions(text, places, again, kinds)
        out, at = [], 0
        for start, end, new in places:
            out += [text[at:start], new]
            at = end
        out = "".join([*out, text[at:]])
        if len({(k, v) for (k, _), v in given.items()}) < len(given):
            raise RuntimeError("two entities of a text have one surrogate")
        return out, kinds


def _replaced(column: pa.Array, surrogates: Surrogates) -> tuple[list[str | None], list[Counter]]:
    texts, gate, out, kinds = column.to_pylist(), pc.match_substring_regex(column, _GATE).to_pylist(), [], []
    for text, hit in zip(texts, gate, strict=True):
        new, found = surrogates.apply(text) if hit else (text, Counter())
        out.append(new)
        kinds.append(found)
    return out, kinds


def session_key(spark: SparkSession) -> bytes:
    """The key in the setting ``KEY_SETTING``. Where it isn't set it is drawn, and kept for the session: surrogates are then
    alike in all of its queries and differ from other sessions'."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key.encode()


def with_surrogates(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with surrogates in ``text_col``. Null and empty texts stay."""
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in few(batches):
            text = pa.array(_replaced(batch.column(at), surrogates)[0], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, schema)


def surrogate_texts(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_entities, kinds) of every row: the text with surrogates, how many entities it had, and their
    types, sorted and comma-joined. A null text stays null with no entities; repeated rows each give a row."""
    rows = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in few(batches):
            text, kinds = _replaced(batch["text"], surrogates)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(text, pa.string()), pa.array([k.total() for k in kinds], pa.int64()), pa.array([",".join(sorted(k)) for k in kinds], pa.string())], ["doc_id", "text", "n_entities", "kinds"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, n_entities long, kinds string")
