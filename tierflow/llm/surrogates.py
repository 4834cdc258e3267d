"""Keyed surrogates for personal data and secrets (operator 1).

Detected entities (e-mail, phone, card or account number, IP address, national
id, IBAN, secret, person name) are replaced by made-up ones of the same kind:

* Strings of a format keep it. The variable characters (letters by case and
  script, digits) are read as one number, and a keyed cycle through all numbers
  of that format gives the next one: one to one, and never the value itself.
  Lengths, punctuation, case, country codes, Luhn and IBAN check digits, address
  classes stay as they were; e-mail hosts end in the reserved ``example``.
* Names keep gender and script. A known given name becomes another of its list,
  other names are spelled from syllables, with the ending of the gender.

Found are addresses of mail and of both IP versions, numbers of phones, cards and
persons, IBANs, secrets (named ones, with or without quotes, well-known key forms,
private key blocks), and names after a title, after words such as "my name is", or
with a given name of the list in front. Other names are not found.

Coreference: equal values (whatever their punctuation or case) get one
surrogate everywhere, name parts are mapped one by one, so "Mr. John Smith" and
a later "Smith" stay the same person, and other mentions of a name found in a
document are replaced with it. A surname has no gender but that of its own form
(Cyrillic endings). A given name that titles show with several genders takes that
of most documents, a known one before an unknown one, in the whole table. A number
of the North American plan is the same with and without its country code.

Distinctness: Spark gathers the distinct entities, groups them by surrogate and
compares surrogates with the real values. Whoever shares a surrogate, or has a
real value as one, draws again under the next attempt until nobody does (from
``WIDER`` attempts on with extra characters where the kind allows them). Numbers
and addresses of a form that is still crowded after ``ATTEMPTS`` draws (half of its
values are in use, say) take the keyed cycle alone: one to one, so distinct and
never the value itself, but perhaps another one in use; no more can be had then. Only those few entities need a lookup when texts are rewritten; all
others follow from the key.

Null text stays null, text without entities stays as it is, texts of any length
are treated whole. Repeated rows are rewritten alike. Null ids are rewritten
with attempt numbers from their entities as well. An empty table gives an empty
result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, staged, table, text_blocks

BLOCK_CHARS = 200_000
WIDER = 8
ATTEMPTS = 40
BROADCAST_ROWS = 200_000
DEFAULT_KEY = "tierflow"

# Titles by gender, and common given names by gender and script.
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "г-жа", "госпожа"),
    "u": ("Dr", "Prof", "Professor", "Doctor", "доктор", "профессор"),
}
GIVEN = {
    ("m", "latin"): ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Daniel", "Hans",
                     "Klaus", "Jürgen", "Pierre", "Jacques", "Michel", "Carlos", "Miguel", "José", "Juan"),
    ("f", "latin"): ("Mary", "Patricia", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma", "Laura", "Petra",
                     "Ursula", "Monika", "Marie", "Sophie", "Camille", "Carmen", "María", "Lucía", "Sofía"),
    ("m", "cyrillic"): ("Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Николай", "Михаил", "Андрей"),
    ("f", "cyrillic"): ("Анна", "Мария", "Елена", "Ольга", "Татьяна", "Наталья", "Ирина", "Светлана"),
}
KNOWN = {name.casefold(): (gender, script) for (gender, script), names in GIVEN.items() for name in names}
SYLLABLES = {
    "latin": ("bar", "cor", "den", "fal", "gar", "hol", "jar", "kel", "lan", "mor", "nor", "pel", "ros", "sel", "tam", "ver"),
    "cyrillic": ("бар", "вел", "гор", "дан", "жар", "зор", "кал", "лан", "мор", "нев", "пол", "рос", "сол", "тар", "фил", "хол"),
}
ENDINGS = {
    ("given", "m", "latin"): "ric", ("given", "f", "latin"): "ina", ("given", "u", "latin"): "en",
    ("given", "m", "cyrillic"): "слав", ("given", "f", "cyrillic"): "ина", ("given", "u", "cyrillic"): "ень",
    ("surname", "m", "latin"): "ton", ("surname", "f", "latin"): "ton", ("surname", "u", "latin"): "ton",
    ("surname", "m", "cyrillic"): "ов", ("surname", "f", "cyrillic"): "ова", ("surname", "u", "cyrillic"): "енко",
}
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "àâäçèéêëíîïñóôöùúûüß", "ÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ")
OF_CHAR = {c: a for a in ALPHABETS for c in a}
HEX = "0123456789abcdef"
PLAIN = -1  # the attempt of forms that are full
CHUNK = 128

CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+"
LOCAL = re.compile(r"[\w.%+-]*")
DOMAIN = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
NUMERIC = re.compile(r"(?<![\w.+])\+?\(?\d(?:[\d]|[ .()-]{1,2}(?=[\d(]))*\d(?!\w)")
IPV4 = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
NAMED = r"(?i:\b(?:token|api[_-]?key|access[_-]?key|secret|passw(?:or)?d|auth))\s*[=:]\s*"
SECRET = re.compile(NAMED + r"(?:([\"'])([^\"'\s]{6,})\1|([^\"'\s,;<>]{8,}))")
# How keys of public services and web tokens begin.
KEY_START = re.compile(r"eyJ|AKIA|ASIA|gh[pousr]_")
CREDENTIAL = re.compile(r"\b(?:eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}|(?:AKIA|ASIA)[A-Z0-9]{16}\b|gh[pousr]_[A-Za-z0-9]{36}\b)")
KEY_BLOCK = re.compile(r"-----BEGIN ([A-Z ]{0,30}PRIVATE KEY)-----\s+([^-]{16,}?)\s*-----END \1-----")
GENDER_OF = {t: g for g, names in TITLES.items() for t in names}
PERSON = re.compile(
    rf"\b(?:({'|'.join(sorted(map(re.escape, GENDER_OF), key=len, reverse=True))})\.?[ \t]+({CAPITAL}(?:[ \t]+{CAPITAL}){{0,2}})"
    rf"|({'|'.join(n for names in GIVEN.values() for n in names)})[ \t]+({CAPITAL}))")
LOUD = {t.upper(): g for t, g in GENDER_OF.items()}
LOUD_DOTTED = tuple(t + "." for t in LOUD)
CAPITALS = r"[A-ZÀ-ÖØ-ÞА-ЯЁ]{2,}"
SHOUTED = re.compile(rf"\b({'|'.join(t.upper() for t in sorted(GENDER_OF, key=len, reverse=True))})\.[ \t]+({CAPITALS}(?:[ \t]+{CAPITALS}){{0,2}})\b")
CALLED_WORDS = ("my name is", "name:", "signed,", "sincerely,", "regards,")
CALLED = re.compile(rf"(?i:\b(?:{'|'.join(CALLED_WORDS)}))\s+({CAPITAL}(?:[ \t]+{CAPITAL}){{1,2}})")


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses: from each ``@`` outward, so that a long token costs no more than its length."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        # Read backwards: letters, digits and .%+- up to the last address or ``@``, no dot before the ``@``.
        size = LOCAL.match(text[last:at][::-1]).end() if at > last and text[at - 1] != "." else 0
        domain = DOMAIN.match(text, at) if size else None
        last = domain.end() if domain else at + 1
        if domain:
            out.append((at - size, last))
        at = text.find("@", last)
    return out


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of a text, in order, without overlaps.

    ``value`` is the same for all spellings of one entity.
    """
    found = []
    found += [(a, z, "email", text[a:z].lower()) for a, z in emails(text)]
    for m in SECRET.finditer(text):
        if m.group(2):
            found.append((m.start(2), m.end(2), "secret", m.group(2)))
            continue
        value = m.group(3).rstrip(".)")
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and "://" not in value:
            found.append((m.start(3), m.start(3) + len(value), "secret", value))
    # What must be in a text is looked up before the slower search for the pattern.
    if any(x in text for x in ("eyJ", "AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")):
        found += [(m.start(), m.end(), "secret", m.group()) for m in CREDENTIAL.finditer(text)]
    if "PRIVATE KEY" in text:
        found += [(m.start(2), m.end(2), "secret", m.group(2)) for m in KEY_BLOCK.finditer(text)]
    if "::" in text or text.count(":") > 6:
        found += [(m.start(), m.end(), "ipv6", v) for m in IPV6.finditer(text) if (v := ipv6(m.group()))]
    found += [(m.start(), m.end(), "iban", m.group().replace(" ", "")) for m in IBAN.finditer(text)]
    for m in NUMERIC.finditer(text):
        for a, z, kind in number_parts(m.group()):
            part = m.group()[a:z]
            value = part if kind == "ip" else re.sub(r"[^\d+]", "", part)
            found.append((m.start() + a, m.start() + z, kind, re.sub(r"^\+?1(?=\d{10}$)", "", value) if kind == "phone" else value))
    people, spelled = {}, {}
    persons = [(GENDER_OF[m.group(1)], m.start(2), m.end(2)) if m.group(1) else (KNOWN[m.group(3).casefold()][0], m.start(3), m.end(4))
               for m in PERSON.finditer(text)]
    if any(x in text for x in LOUD_DOTTED):
        persons += [(LOUD[m.group(1)], m.start(2), m.end(2)) for m in SHOUTED.finditer(text)]
    lower = text.lower()
    if any(x in lower for x in CALLED_WORDS):
        persons += [(KNOWN.get(m.group(1).split()[0].casefold(), "u")[0], m.start(1), m.end(1)) for m in CALLED.finditer(text)]
    for gender, at, to in sorted(persons, key=lambda x: x[1]):
        parts = [(at + p.start(), at + p.end(), p.group()) for p in re.finditer(f"{CAPITAL}|{CAPITALS}", text[at:to])]
        for k, (a, b, word) in enumerate(parts):
            last = k == len(parts) - 1
            known = KNOWN.get(word.casefold())
            if known and (not last or len(parts) == 1 and gender in (known[0], "u")):
                kind = f"given-{known[0]}"
            else:
                kind = "surname" if last else f"given-{gender}"
            spelled.setdefault(word.casefold(), kind)
            people[word] = people[word.title()] = spelled[word.casefold()]
            found.append((a, b, people[word], word.casefold()))
    if people:
        again = re.compile(rf"\b(?:{'|'.join(map(re.escape, people))})\b")
        found += [(m.start(), m.end(), people[m.group()], m.group().casefold()) for m in again.finditer(text)]
    out, end = [], 0
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if x[0] >= end:
            out.append(x)
            end = x[1]
    return out


def ipv6(s: str) -> str | None:
    """The shortest form of an address with at least two groups that are not 0, else null."""
    try:
        value = str(ipaddress.IPv6Address(s))
    except ValueError:
        return None
    return value if sum(bool(x.strip("0")) for x in value.split(":")) > 1 else None


def number_kind(s: str) -> str | None:
    if IPV4.fullmatch(s):
        return "ip" if all(int(x) < 256 for x in s.split(".")) else None
    digits = sum(c.isdigit() for c in s)
    if s[0] == "+" and 8 <= digits <= (11 if s[1:2] == "1" else 15) and re.fullmatch(r"\+\(?\d+[ .)-]{0,2}\(?[^(]*", s):
        return "phone"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", s):
        return "national"
    if 13 <= digits <= 19 and re.fullmatch(r"\d+|\d{4}(?:([ -])\d{4})(?:\1\d{4})*(?:\1\d{1,4})?", s):
        return "card"
    if re.fullmatch(r"3\d{3}([ -])\d{6}\1\d{5}", s):
        return "card"
    if digits in (10, 11) and re.fullmatch(r"\(?0\d{2,4}\)?[ -]\d{3,4}[ -]\d{3,4}", s):
        return "phone"
    if digits in (10, 11) and re.fullmatch(r"(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}", s):
        return "phone"
    return None


def number_parts(run: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities in a run of digit groups.

    A run that is no entity as a whole (or a card with more after it) holds
    neighbours: its groups are tried together, the most certain kinds first and
    the longest first. A part joined to further digits by a dot or a hyphen is
    none, but for addresses and unbroken cards beside a hyphen.
    """
    kind = number_kind(run)
    if kind and (kind != "card" or run.isdigit() or valid(run)):
        return [(0, len(run), kind)]
    groups = [m.span() for m in re.finditer(r"\d+", run)]
    starts = [a - len(re.search(r"\+?\(?$", run[max(0, a - 2):a]).group()) for a, _ in groups]
    options = []
    for i in range(len(groups)):
        digits = 0
        for j in range(i, len(groups)):
            z = groups[j][1]
            digits += z - groups[j][0]
            if digits > 19:
                break
            for a in {starts[i], groups[i][0]}:
                part = run[a:z]
                kind = number_kind(part)
                tight = r"\." if kind == "ip" or kind == "card" and part.isdigit() else "[.-]"
                if kind and not re.search(rf"\d{tight}$", run[max(0, a - 2):a]) and not re.match(rf"{tight}\d", run[z:z + 2]):
                    sure = 0 if kind in ("ip", "national") or part[0] == "+" else 1 if kind == "card" and valid(part) else 2
                    options.append((sure, a, -z, kind))
    out, taken = [], bytearray(len(run))
    for _, a, z, kind in sorted(options):
        if not any(taken[a:-z]):
            taken[a:-z] = b"\1" * (-z - a)
            out.append((a, -z, kind))
    return sorted(out)


def valid(card: str) -> bool:
    """Whether the last digit is the check digit."""
    digits = re.sub(r"\D", "", card)
    return int(digits[-1]) == luhn(digits[:-1])


class Surrogates:
    """Maps (kind, value, attempt) to a surrogate value, by the key alone."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()

    def number(self, *tweak) -> int:
        data = "\x1f".join(map(str, tweak)).encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def following(self, n: int, size: int, tweak, allowed=lambda x: True) -> int:
        """The next allowed number below ``size`` on a keyed cycle through all numbers."""
        if size < 2:
            return n
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        rounds = []
        for r in range(6):
            seed = hashlib.blake2b(f"{r}\x1f{tweak}".encode(), key=self.key, digest_size=32).digest()
            rounds.append(lambda x, seed=seed: int.from_bytes(
                hashlib.shake_128(seed + x.to_bytes((half + 7) // 8, "big")).digest((half + 7) // 8), "big") & mask)

        def place(x, order, sign):
            left, right = x >> half, x & mask
            if sign > 0:
                for f in order:
                    left, right = right, left ^ f(right)
            else:
                for f in order:
                    left, right = right ^ f(left), left
            return left << half | right

        at, start = place(n, rounds, 1), n
        while True:
            at = (at + 1) & ((1 << 2 * half) - 1)
            x = place(at, rounds[::-1], -1)
            if x == start or x < size and allowed(x):
                return x

    def shaped(self, text: str, tweak, fixed=(), alphabet_of=None, allowed=lambda x: True) -> str:
        """Another text of the same form; positions in ``fixed`` and signs stay.

        A long text is mapped part by part, so that its cost follows its length.
        """
        if len(text) > 2 * CHUNK:
            return "".join(self.shaped(text[i:i + CHUNK], f"{tweak}\x1f{i}", {k - i for k in fixed}, alphabet_of) for i in range(0, len(text), CHUNK))
        alphabets = [None if i in fixed else a for i, a in enumerate(map(alphabet_of or OF_CHAR.get, text))]
        n, size = 0, 1
        for c, a in zip(text, alphabets):
            if a:
                n, size = n * len(a) + a.index(c), size * len(a)
        shape = "".join("." if a is None else a[0] for a in alphabets)
        x = self.following(n, size, f"{tweak}\x1f{shape}", allowed)
        out = []
        for c, a in zip(reversed(text), reversed(alphabets)):
            if a:
                x, r = divmod(x, len(a))
                c = a[r]
            out.append(c)
        return "".join(reversed(out))

    def of(self, kind: str, value: str, attempt: int) -> str:
        tweak = f"{kind}\x1f{attempt}"
        extra = self.number("extra", tweak, value) if attempt >= WIDER else None
        if kind == "email":
            local, _, host = value.partition("@")
            labels = host.split(".")
            new_host = ".".join(self.shaped(x, f"host\x1f{'.'.join(labels[i + 1:])}") for i, x in enumerate(labels[:-1]))
            if extra is not None:
                local += "".join(ALPHABETS[0][extra >> 5 * i & 15] for i in range(8))
            return f"{self.shaped(local, tweak + host)}@{new_host}.example"
        if kind == "secret":
            if extra is not None:
                value += f"{extra % 16**8:08x}"
            lower = all(c in HEX for c in value)
            start = KEY_START.match(value)
            return self.shaped(value, tweak, range(start.end()) if start else (), (lambda c: HEX) if lower else None)
        if kind == "ip":
            return self.address(value, tweak)
        if kind == "ipv6":
            return self.address6(value, tweak)
        if kind == "iban":
            return self.iban(value, tweak)
        if kind == "card":
            body = self.shaped(value[:-1], tweak, fixed=(0,))
            return body + str((int(value[-1]) - luhn(value[:-1]) + luhn(body)) % 10)
        if kind == "phone":
            return self.phone(value, tweak)
        if kind == "national":
            return self.shaped(value, tweak)
        part, _, gender = kind.partition("-")
        return self.name(part, gender, value, tweak, extra)

    def phone(self, value, tweak):
        if value[0] in "+0":
            return self.shaped(value, tweak, range(1 if value[0] == "0" else 2 if value[1] == "1" else 3))
        if value[3:6] == "555":  # the exchange set aside for fiction
            return self.shaped(value, tweak, {3, 4, 5}, allowed=lambda x: x >= 10**6)
        return self.shaped(value, tweak, allowed=lambda x: x >= 10**9 and x // 10**4 % 1000 != 555)

    def address6(self, value, tweak):
        """Groups of 0, the number of digits of each group and the first group stay."""
        groups, first = value.split(":"), value.index(":")
        leads, at = set(), 0
        for x in groups:
            leads.add(at)
            at += len(x) + 1
        zeros = {i for i in leads if value[i:i + 2] in ("0", "0:")}
        digits = [(HEX[1:] if i in leads else HEX) if c in HEX else None for i, c in enumerate(value)]
        place = iter(digits)
        return self.shaped(value, tweak, zeros | set(range(first)), lambda c: next(place))

    def address(self, value, tweak):
        n = 0
        for x in value.split("."):
            n = n * 256 + int(x)
        for first, size in ((10 << 24, 1 << 24), (127 << 24, 1 << 24), (0xAC100000, 1 << 20), (0xC0A80000, 1 << 16),
                            (0xA9FE0000, 1 << 16), (224 << 24, 32 << 24)):
            if first <= n < first + size:
                break
        else:
            first, size = 0, 224 << 24

        def public(x):
            return size != 224 << 24 or (x >> 24 not in (0, 10, 127) and x >> 20 != 0xAC1 and x >> 16 not in (0xC0A8, 0xA9FE))

        x = first + self.following(n - first, size, f"{tweak}\x1f{first}", public)
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))

    def iban(self, value, tweak):
        body = self.shaped(value[4:], tweak + value[:2])

        def check(country, rest):
            return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97

        shift = (int(value[2:4]) - check(value[:2], value[4:])) % 97
        return f"{value[:2]}{(check(value[:2], body) - 2 + shift) % 97 + 2:02d}{body}"

    def name(self, part, gender, value, tweak, extra):
        script = script_of(value)
        known = GIVEN.get((gender, script)) if part == "given" else None
        folded = [n.casefold() for n in known or ()]
        if value in folded and extra is None:
            return folded[self.following(folded.index(value), len(folded), f"given\x1f{gender}\x1f{script}")]
        if part == "surname":  # its own form alone tells the gender
            gender = "u" if value[-1] == "о" else "f" if value[-1] in "ая" else "m"
        n = self.number("name", tweak, value)
        length = 2 if extra is None else 5 + (int(tweak.rpartition("\x1f")[2]) - WIDER) // 4
        syllables = SYLLABLES[script]
        return "".join(syllables[n >> 4 * i & 15] for i in range(length)) + ENDINGS[part, gender, script]


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def dressed(original: str, kind: str, surrogate: str) -> str:
    """The surrogate value in the spelling of one mention: punctuation and case."""
    if kind == "phone" and sum(map(str.isdigit, original)) == len(surrogate) + 1 == 11:
        surrogate = "+1"[original[0] != "+":] + surrogate
    if kind == "ipv6":
        long = ipaddress.IPv6Address(surrogate).exploded if len(original) == 39 else surrogate
        return long.upper() if original.isupper() else long
    if kind in ("phone", "card", "national", "iban"):
        rest = iter(surrogate)
        out = [next(rest, "") if c.isalnum() or c == "+" else c for c in original]
        return "".join(out) + "".join(rest)
    if kind == "email":
        return surrogate.upper() if original.isupper() else surrogate
    if kind.startswith(("given", "surname")):
        return surrogate.upper() if original.isupper() and len(original) > 1 else surrogate[:1].upper() + surrogate[1:]
    return surrogate


@functools.lru_cache(maxsize=4)
def surrogates(key: str) -> Surrogates:
    return Surrogates(key)


@functools.lru_cache(maxsize=20_000)
def surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    return surrogates(key).of(kind, value, attempt)


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, value): the entities of each document, each once."""

    def run(batches):
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            rows = [(i, *x) for i, t in zip(ids, texts) for x in dict.fromkeys(y[2:] for y in find(t))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))],
                                                 names=["doc_id", "kind", "value"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, kind string, value string")


def drawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt, surrogate) of (kind, value, attempt)."""

    def run(batches):
        for b in batches:
            kinds, values, attempts = (b.column(k).to_pylist() for k in range(3))
            made = [surrogate(key, k, v, a) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(made, pa.string())], names=["kind", "value", "attempt", "surrogate"])

    return arrow_map(entities.select("kind", "value", "attempt"), run, "kind string, value string, attempt int, surrogate string")


def form(kind: str, value: str) -> str | None:
    """What the surrogate of a number or an address has in common with it; null for kinds whose surrogates can grow."""
    if kind == "ip":
        a, b = map(int, value.split(".")[:2])
        if a in (10, 127) or a >= 224:
            return f"ip {min(a, 224)}"
        return f"ip {a}.{b // 16 * 16}" if (a, b) in ((192, 168), (169, 254)) or a == 172 and 16 <= b < 32 else "ip"
    if kind == "ipv6":
        head, _, rest = value.partition(":")
        return f"ipv6 {head}:" + re.sub(r"[1-9a-f][0-9a-f]*", lambda m: "x" * len(m.group()), rest)
    if kind == "phone":
        lead = value[:1 if value[0] == "0" else 2 if value[1] == "1" else 3] if value[0] in "+0" else value[3:6] == "555"
        return f"phone {lead} {len(value)}"
    if kind == "card":
        return f"card {value[0]} {len(value)}"
    if kind == "iban":
        return "iban " + value[:2] + "".join("0" if c.isdigit() else "A" for c in value[4:])
    return "national" if kind == "national" else None


def forms(entities: DataFrame) -> DataFrame:
    """(kind, value, form) of (kind, value)."""

    def run(batches):
        for b in batches:
            kinds, values = b.column(0), b.column(1)
            found = [form(k, v) for k, v in zip(kinds.to_pylist(), values.to_pylist())]
            yield pa.RecordBatch.from_arrays([kinds, values, pa.array(found, pa.string())], names=["kind", "value", "form"])

    return arrow_map(entities.select("kind", "value"), run, "kind string, value string, form string")


def family(kind):
    """Kinds whose values may be mistaken for one another: a name part in any gender."""
    return F.split(kind, "-")[0]


def attempts(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) of the entities that need more than the first draw.

    ``entities``: distinct (kind, value), written before.
    """
    real = entities.select(family(F.col("kind")).alias("family"), F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
    now = staged(drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates-draw")
    draws = 0
    while True:
        rows = now.withColumn("family", family(F.col("kind")))
        first = rows.groupBy("family", "surrogate").agg(
            F.min(F.struct("attempt", "kind", "value")).alias("first"), F.count("*").alias("n"))
        clash = first.join(real, ["family", "surrogate"], "left").filter("n > 1 or real")
        again = (rows.filter(F.col("attempt") != PLAIN).join(clash, ["family", "surrogate"])
                 .filter(F.coalesce("real", F.lit(False)) | (F.struct("attempt", "kind", "value") != F.col("first")))
                 .select("kind", "value"))
        again = staged(again, "surrogates-again")
        if again.isEmpty():
            return now.filter("attempt != 0").select("kind", "value", "attempt")
        following = F.col("attempt") + 1
        draws += 1
        if draws == ATTEMPTS:
            # All values of a full form, so that one cycle maps them; the rest goes on with longer surrogates.
            full = forms(again).select("form").filter("form is not null").distinct()
            full = staged(forms(now).join(full, "form", "left_semi").select("kind", "value"), "surrogates-full")
            if not full.isEmpty():
                again, following = full, F.lit(PLAIN)
        marked = now.join(again.withColumn("redo", F.lit(1)), ["kind", "value"], "left")
        kept = marked.filter("redo is null").select("kind", "value", "attempt", "surrogate")
        redone = drawn(marked.filter("redo = 1").select("kind", "value", following.cast("int").alias("attempt")), key)
        now = staged(kept.union(redone), "surrogates-draw")


def resolved(found: DataFrame) -> DataFrame:
    """(kind, value, use): the kind that each entity is replaced under; one gender for a given name."""
    counted = staged(found.groupBy("kind", "value").agg(F.count("*").alias("n")), "surrogates-counted")
    given = counted.filter(F.col("kind").startswith("given-"))
    one = given.groupBy("value").agg(F.max(F.struct(F.col("kind") != "given-u", "n", "kind"))["kind"].alias("use"))
    return (given.join(one, "value").select("kind", "value", "use")
            .union(counted.filter(~F.col("kind").startswith("given-")).select("kind", "value", F.col("kind").alias("use"))))


def replaced(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """All columns of ``docs`` with the text rewritten, and ``n_entities`` (mentions replaced)."""
    found = staged(mentions(docs), "surrogates-mentions")
    named = staged(resolved(found), "surrogates-named")
    entities = staged(named.select(F.col("use").alias("kind"), "value").distinct(), "surrogates-entities")
    drawn_later = attempts(entities, key).withColumnRenamed("kind", "use")
    later = (named.join(drawn_later, ["use", "value"], "left").filter("attempt is not null or kind != use")
             .select("kind", "value", "use", F.coalesce("attempt", F.lit(0)).alias("attempt")))
    later = staged(later, "surrogates-later")
    # What a document needs to know beyond the key: the attempts and kinds of its own entities.
    own = found.join(later, ["kind", "value"]).groupBy("doc_id").agg(
        F.collect_set(F.struct("kind", "value", "use", "attempt")).alias("__surrogates_later"))
    own = staged(own.withColumnRenamed("doc_id", "__surrogates_doc"), "surrogates-own")
    if own.count() <= BROADCAST_ROWS:
        own = F.broadcast(own)
    rows = docs.join(own, F.col("doc_id").cast("long").eqNullSafe(F.col("__surrogates_doc")), "left").drop("__surrogates_doc")
    names = docs.columns
    place = names.index("text")
    schema = docs.drop("n_entities").schema.add("n_entities", "integer")

    def run(batches):
        for b in batches:
            texts, counts = [], []
            for text, later in zip(b.column(place).to_pylist(), b.column("__surrogates_later").to_pylist()):
                spans = find(text) if text else []
                tries = {(x["kind"], x["value"]): (x["use"], x["attempt"]) for x in later or ()}
                out, at = [], 0
                for a, z, kind, value in spans:
                    use, attempt = tries.get((kind, value), (kind, 0))
                    out += [text[at:a], dressed(text[a:z], kind, surrogate(key, use, value, attempt))]
                    at = z
                texts.append("".join(out) + text[at:] if spans else text)
                counts.append(len(spans))
            columns = {n: b.column(n) for n in names} | {"text": pa.array(texts, pa.string()), "n_entities": pa.array(counts, pa.int32())}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=schema.names)

    return arrow_map(rows, run, schema)


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))
