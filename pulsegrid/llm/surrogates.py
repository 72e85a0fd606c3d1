"""Personal data replaced by keyed surrogates of the same kind and format.

Every entity is mapped by a keyed permutation of the values of its own format (a Feistel network over its
digits and letters, walked on until the value is valid again). A permutation cannot send two entities to one
surrogate, and the same entity gets the same surrogate in every document and on every executor, so no table
of entities is needed. Each job still runs ``collisions`` over its entities first, which shuffles each distinct one
once, and gives those that it finds other surrogates.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import arrow_step
from .tables import saved

DIGITS, HEX, LOW, UP = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: letters that stand for each other in names: vowels and consonants of one script and case
NAME_CLASSES = [
    "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "çñß", "аеиоуыэюяё", "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ",
]
#: given names by gender and script
GIVEN = {
    ("m", "latin"): "James John Robert Michael David Thomas Daniel Paul Mark Peter Hans Karl Pierre Jean Luis Carlos "
                    "Miguel Pedro Anton Felix".split(),
    ("f", "latin"): "Mary Anna Linda Susan Karen Lisa Sarah Emma Laura Julia Marie Claire Sophie Carmen Lucia Elena "
                    "Ingrid Petra Helga Monika".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
}
#: titles and the gender they tell (n: none)
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Sr": "m",
          "Sra": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f",
          "Господин": "m", "Госпожа": "f"}
_GENDER = {name: (kind, names) for kind, names in GIVEN.items() for name in names}

NUMBERS = re.compile(r"""
  (?P<secret>(?:(?i:password|passwd|passwort|kennwort|contrase[nñ]a|mot\ de\ passe|пароль|pwd|token|secret
        |(?:api|access|private)[_-]?key)["']?[ \t]*(?:=>|:=|[=:])[ \t]*(?!(?i:bearer|basic)\b)|\b(?i:bearer|basic)[ ]+)
     (?:"(?P<double>[^"\n]{4,})"|'(?P<single>[^'\n]{4,})'|(?P<value>[^\s"'<>`]{6,})))
| (?P<key>\b(?:AKIA[0-9A-Z]{16,}|gh[opsur]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|xox[abeoprs]-[A-Za-z0-9-]{10,}
     |sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+)?)\b)
| (?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}\b)
| (?P<iban>\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
| (?P<mac>\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b)
| (?P<ipv6>(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])
     |(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*::)(?:[0-9A-Fa-f]{0,4}:){2,7}
      (?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[0-9A-Fa-f]{0,4})(?![0-9A-Za-z:]|[.-][0-9]))
| (?P<ipv4>(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9]))
| (?P<phone>(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,8}){1,4}
     |\+[0-9]{8,15}|\([0-9]{3}\)[ ]?[0-9]{3}[-. ][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9A-Za-z]|-[0-9]))
| (?P<ssn>(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9]))
| (?P<card>(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7}
     |[0-9]{4}(?P<gap2>[ -])[0-9]{6}(?P=gap2)[0-9]{5})(?![0-9A-Za-z]|[.-][0-9]))
""", re.X)
#: characters of entities that are remembered, and numbers that are permuted as two whole ones (under 256 bits each)
HELD_CHARS, WHOLE_PARTS = 256, 64
_TRIGGER = re.compile("[0-9@]")
_HAS_TITLE = re.compile("|".join(sorted(TITLES, key=len, reverse=True)))
NAMED = re.compile(rf"\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})(?:\.|(?=\s))")
#: white space without an empty line, particles, and a part of a name; hyphens and apostrophes join its words
PART = re.compile(r"""(?P<gap>[^\S\n]*(?:\n[^\S\n]*)?)
  (?:(?:van|von|der|den|de|la|le|du|di|da|del|della|dos|das|do|bin|ibn|al|el|ter|ten|zu)[ ])*
  (?:d['’]|al-|el-)?(?P<part>[^\W\d_]+(?:[-‐‑][^\W\d_]+|['’](?=[^\W\d_a-zа-яё])[^\W\d_]+)*)(?P<dot>\.?)""", re.X)
WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
_LETTERS = re.compile(r"[^\W\d_]+")
#: words that are replaced where they stand in a name, but not elsewhere
COMMON = set("""The An And But Or He She It They We You His Her Its Their Our My Your This That These Those There Here In
On At To Of For From With By As If When While After Before Who What Where Why How Is Was Are Were Has Had Have Will Would
Can Could May Might Shall Should Do Does Did Not No Yes So Then Der Die Das Und Ein Eine Er Sie Es Wir Ich Le La Les Un
Une Et Il Elle El Los Las Una""".split())


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for a valid card number."""
    return sum(int(d) if i % 2 == 0 else (2 * int(d)) % 10 + int(d) // 5 for i, d in enumerate(reversed(digits)))


class Surrogates:
    """Keyed permutations. ``key`` decides all replacements. The gender that a title tells is not used: with 'Dr. Smith'
    and 'Mrs. Smith' one entity would have two surrogates. A given name stays of its own gender."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()[:32]
        self._held = lru_cache(maxsize=100_000)(self._of)

    def of(self, kind: str, text: str, gender: str = "n") -> str:
        """The surrogate of an entity; long ones are not remembered."""
        return (self._held if len(text) <= HELD_CHARS else self._of)(kind, text, gender)

    def _number(self, label: str, turn: int, value: int) -> int:
        held = hashlib.blake2b(f"{label}|{turn}|{value}".encode(), key=self.key, digest_size=32)
        return int.from_bytes(held.digest(), "big")

    def permute(self, label: str, parts: list[int], sizes: list[int]) -> list[int]:
        """A permutation of the mixed-radix numbers with ``sizes``: eight rounds between the two halves."""
        if not parts:
            return parts
        if len(parts) > WHOLE_PARTS:
            return self._permute_long(label, parts, sizes)
        if len(parts) == 1:
            step = 1 + self._number(label, 0, 0) % (sizes[0] - 1) if sizes[0] > 1 else 0
            return [(parts[0] + step) % sizes[0]]
        cut = (len(parts) + 1) // 2
        whole, total = [], []
        for half, size in ((parts[:cut], sizes[:cut]), (parts[cut:], sizes[cut:])):
            n, t = 0, 1
            for p, s in zip(half, size):
                n, t = n * s + p, t * s
            whole.append(n)
            total.append(t)
        for turn in range(8):
            k = turn % 2
            whole[k] = (whole[k] + self._number(label, turn, whole[1 - k])) % total[k]
        out = []
        for n, size in zip(whole, (sizes[:cut], sizes[cut:])):
            back = []
            for s in reversed(size):
                n, rest = divmod(n, s)
                back.append(rest)
            out += reversed(back)
        return out

    def _permute_long(self, label: str, parts: list[int], sizes: list[int]) -> list[int]:
        """The same rounds for any length: a half is moved number by number, each by its own 64 bits of a stream that
        the other half decides. As one number only its last 256 bits would move."""
        cut = (len(parts) + 1) // 2
        halves = [np.array(parts[:cut], np.uint64), np.array(parts[cut:], np.uint64)]
        radix = [np.array(sizes[:cut], np.uint64), np.array(sizes[cut:], np.uint64)]
        for turn in range(8):
            k = turn % 2
            seed = hashlib.blake2b(f"{label}|{turn}|".encode() + halves[1 - k].astype("<u2").tobytes(), key=self.key,
                                   digest_size=32).digest()
            stream = np.frombuffer(hashlib.shake_256(self.key + seed).digest(8 * len(halves[k])), "<u8")
            halves[k] = (halves[k] + stream % radix[k]) % radix[k]
        return [int(n) for half in halves for n in half]

    def string(self, label: str, text: str, classes: list[str]) -> str:
        """``text`` with each character of a class replaced by one of that class; others stay."""
        at = {c: g for g in classes for c in g}
        spots = [(i, at[c]) for i, c in enumerate(text) if c in at]
        shape = "".join(str(classes.index(at[c])) + "," if c in at else c for c in text)
        new = self.permute(f"{label}|{shape}", [g.index(text[i]) for i, g in spots], [len(g) for _, g in spots])
        out = list(text)
        for (i, g), n in zip(spots, new):
            out[i] = g[n]
        return "".join(out)

    def walk(self, label: str, text: str, classes: list[str], valid) -> str:
        """Permute until ``valid`` holds again. That is a permutation of the valid values as long as ``valid`` asks only
        for a class of values to which ``text`` itself belongs, and not for anything else of ``text``."""
        out = self.string(label, text, classes)
        while not valid(out):
            out = self.string(label, out, classes)
        return out

    def _of(self, kind: str, text: str, gender: str = "n") -> str:
        if kind in ("secret", "key"):
            form = _secret_form(text)
            if form == "hex":
                return self.string("secret", text, [HEX])
            head = text[:len(form)]
            return head + self.walk(f"secret{form}", text[len(form):], [DIGITS, LOW, UP],
                                    lambda t: _secret_form(head + t) == form)
        if kind == "email":
            local, _, host = text.rpartition("@")
            *front, name, top = host.split(".")
            local = self.string("email", local, [DIGITS, LOW, UP])
            front = [self.string("host", f, [DIGITS, LOW, UP]) for f in front]
            return f"{local}@{'.'.join([*front, self.string('host', name, [DIGITS, LOW, UP]), top])}"
        if kind == "ipv6" and "." in text:
            head, _, tail = text.rpartition(":")
            return f"{self._of(kind, head)}:{self._ipv4(tail)}"
        if kind in ("mac", "ipv6"):
            if text == text.lower():
                return self.string(kind, text, [HEX])
            if text == text.upper():  # digits alone are lower case
                return self.walk(kind + "A", text, [HEX.upper()], lambda t: t != t.lower())
            return self.string(kind, text, [DIGITS, "abcdef", "ABCDEF"])
        if kind == "ipv4":
            return self._ipv4(text)
        if kind == "phone":
            lead = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]", text)
            n = lead.end() if lead else 0
            low = re.search("[0-9]", text[n:])[0] in "01"
            return text[:n] + self.walk("phone", text[n:], [DIGITS], lambda t: (re.search("[0-9]", t)[0] in "01") == low)
        if kind == "ssn":
            return self.walk(kind, text, [DIGITS], lambda t: t[:3] not in ("000", "666") and t[0] != "9"
                             and t[4:6] != "00" and t[7:] != "0000")
        if kind == "card":
            first = text[0]
            body = self.string(kind + first, text[1:-1], [DIGITS])
            last = -luhn(re.sub("[^0-9]", "", first + body) + "0") % 10
            return first + body + str(last)
        if kind == "iban":
            # 00, 01 and 99 are other spellings of 97, 98 and 02, and stay that
            shift = int(text[2:4]) - _iban_check(text[:2], text[4:])
            body = self.walk(kind + text[:2], text[4:], [DIGITS, UP],
                             lambda t: 0 <= _iban_check(text[:2], t) + shift <= 99)
            return f"{text[:2]}{_iban_check(text[:2], body) + shift:02d}{body}"
        return self._name(text, gender)

    def _ipv4(self, text: str) -> str:
        value, net = int(ipaddress.ip_address(text)), _network(int(ipaddress.ip_address(text)))
        while True:
            value = int.from_bytes(bytes(self.permute("ipv4", list(value.to_bytes(4, "big")), [256] * 4)), "big")
            if _network(value) == net:
                return str(ipaddress.ip_address(value))

    def _name(self, text: str, gender: str) -> str:
        if text in _GENDER:
            kind, names = _GENDER[text]
            return names[self.permute(str(kind), [names.index(text)], [len(names)])[0]]
        classes = [*NAME_CLASSES, *(c.upper() for c in NAME_CLASSES if c.upper().lower() == c and len(c.upper()) == len(c))]
        if len(text) == 1:
            return self.string("initial", text, classes)
        # the last letter may mark gender and stays
        return self.walk("name", text[:-1], classes, lambda t: t + text[-1] not in _GENDER) + text[-1]


def _secret_form(text: str) -> str:
    """``hex``, the fixed beginning of a key, or nothing; each form has its own surrogates."""
    if re.fullmatch("[0-9a-f]+", text):
        return "hex"
    m = re.match("AKIA|gh[opsur]_|github_pat_|xox[abeoprs]-|sk-|eyJ", text)
    return m[0] if m else ""


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in re.sub(" ", "", body) + country + "00")) % 97


def _is_ipv6(text: str) -> bool:
    """A valid address with a digit; without one it is rather a name of a program (``Face::Add``)."""
    try:
        return bool(re.search("[0-9]", text)) and ipaddress.IPv6Address(text) is not None
    except ValueError:
        return False


def _network(address: int) -> str:
    a = ipaddress.ip_address(address)
    if a.is_private:
        return next((n for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")
                     if a in ipaddress.ip_network(n)), "private")
    return "special" if a.is_reserved or a.is_unspecified else "multicast" if a.is_multicast else "public"


def _parts(text: str, at: int) -> list[tuple[int, int]]:
    """(start, end) of each word of the name that begins after a title: all capitalised parts and initials."""
    words: list[tuple[int, int]] = []
    joined = text[at - 1] == "."
    while m := PART.match(text, at):
        part = m["part"]
        if part[0].islower() or part in TITLES or not (m["gap"] or joined) or (words and part == "I" and not m["dot"]):
            break
        words += [(w.start(), w.end()) for w in _LETTERS.finditer(text, m.start("part"), m.end("part"))]
        joined = len(part) == 1 and bool(m["dot"])
        at = m.end()
        if m["dot"] and not joined:
            break
    return words


def _names(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """The words of every name after a title, and every other mention of one of them in the text, outside of
    the ``taken`` spans."""
    places, genders = {}, {}
    for m in NAMED.finditer(text):
        for start, end in _parts(text, m.end()):
            word, gender = text[start:end], TITLES[m["title"]]
            places.setdefault((start, end), gender)
            if end - start > 1 and not word[0].islower() and word not in COMMON and word not in TITLES:
                genders.setdefault(word, gender)
    if genders:
        for m in WORD.finditer(text):
            if m[0] in genders:
                places.setdefault(m.span(), genders[m[0]])
    free = _free(taken)
    return [(*place, "name", gender) for place, gender in places.items() if free(*place)]


def _free(taken: list[tuple[int, int]]):
    """Whether a span meets none of the ``taken`` ones, which are in order."""
    begins = [t[0] for t in taken]

    def free(start: int, end: int) -> bool:
        k = bisect_left(begins, end)
        return k == 0 or taken[k - 1][1] <= start

    return free


def _repeats(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Every other mention of a secret of six characters or more that the text holds."""
    secrets = {text[start:end] for start, end, kind, _ in found if kind in ("secret", "key") and end - start >= 6}
    if not secrets:
        return []
    words, out = ahocorasick.Automaton(), []
    for secret in secrets:
        words.add_word(secret, len(secret))
    words.make_automaton()
    free, at = _free([f[:2] for f in found]), 0
    for last, size in sorted(words.iter(text), key=lambda m: (m[0] - m[1], -m[1])):
        start, end = last + 1 - size, last + 1
        inside = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
        if start >= at and not inside and free(start, end):
            out.append((start, end, "secret", "n"))
            at = end
    return out


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, gender) of every entity, in order, not overlapping."""
    found = []
    if _TRIGGER.search(text):
        for m in NUMBERS.finditer(text):
            kind, start, end = m.lastgroup, m.start(), m.end()
            if kind == "secret":
                group = next(g for g in ("double", "single", "value") if m[g] is not None)
                start, end = m.span(group)
                if not re.search("[0-9]", m[group]):
                    continue
                if group == "value":
                    end = start + len(m["value"].rstrip(".,;:)]}"))
            elif kind in ("gap", "gap2"):
                kind = "card"
            value = text[start:end]
            if kind == "ipv4" and (any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in value.split("."))):
                continue
            if kind == "ipv6" and not _is_ipv6(value):
                continue
            if kind == "card" and luhn(re.sub("[^0-9]", "", value)) % 10:
                continue
            if kind == "iban" and int("".join(str(int(c, 36)) for c in
                                              re.sub(" ", "", value)[4:] + value[:4])) % 97 != 1:
                continue
            if kind == "phone" and not 7 <= len(re.sub("[^0-9]", "", value)) <= 15:
                continue
            if kind == "ssn" and (value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00"
                                  or value[7:] == "0000"):
                continue
            found.append((start, end, kind, "n"))
    found = sorted(found + _repeats(text, found))
    if _HAS_TITLE.search(text):
        found = sorted(found + _names(text, [f[:2] for f in found]))
    return found


def replaced(text: str, surrogates: Surrogates, given=None) -> tuple[str, list[tuple[int, int, str, str, str]]]:
    """The text with surrogates, and (start, end, kind, entity, surrogate) of each in the input. ``given`` has
    surrogates by kind and entity that go before the permutations."""
    out, spans, at = [], [], 0
    for start, end, kind, gender in entities(text):
        if start < at:
            continue
        entity = text[start:end]
        new = (given or {}).get((kind, entity)) or surrogates.of(kind, entity, gender)
        out += [text[at:start], new]
        spans.append((start, end, kind, entity, new))
        at = end
    return ("".join([*out, text[at:]]) if spans else text), spans


SPANS = "array<struct<start: int, end: int, kind: string, entity: string, surrogate: string>>"
PAIRS = "kind string, entity string, surrogate string"
#: column of the surrogates that a text has instead of the permuted ones
_GIVEN = "_given_surrogates"


def _pairs(docs: DataFrame, key: bytes, text: str, make, hashed: bool = False) -> DataFrame:
    """Kind, entity and surrogate of the entities of all texts, each once for a step, or for each text with its hash."""
    def work(batch: pa.RecordBatch) -> pa.Table:
        s = make(key) if not hasattr(work, "held") else work.held
        work.held = s
        found = {}
        for t in batch.column(0).to_pylist():
            h = hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() if hashed and t is not None else ""
            found.update(dict.fromkeys((*x[2:], h) for x in (replaced(t, s)[1] if t is not None else ())))
        columns = list(zip(*found)) or [()] * 4
        return pa.table({n: pa.array(c, pa.string()) for n, c in zip(("kind", "entity", "surrogate", "hash"), columns)
                         if hashed or n != "hash"})

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        arrow_step(work, "text"), PAIRS + (", hash string" if hashed else ""))


def _other_surrogates(pairs: DataFrame, key: bytes, make) -> DataFrame:
    """Kind, entity and new surrogate of the entities that must not have their first one: of those that share
    one, all but the smallest take those of other keys until none is shared."""
    first = now = saved(pairs.distinct(), "surrogates")
    turn = 0
    while not collisions(now).isEmpty():
        turn += 1
        keep = now.groupBy("kind", "surrogate").agg(F.min("entity").alias("least"), F.count("*").alias("n")).where("n > 1")
        moved = now.join(keep, ["kind", "surrogate"]).where("entity != least").select("kind", "entity").distinct()
        other = key + f"|{turn}".encode()

        def work(batches):
            s = make(other)
            for b in batches:
                kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
                new = [s.of(k, v) for k, v in zip(kinds, values)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(new, pa.string())],
                                                 names=["kind", "entity", "surrogate"])

        now = saved(now.join(moved, ["kind", "entity"], "left_anti").unionByName(moved.mapInArrow(work, PAIRS)), "surrogates")
    return now.join(first, ["kind", "entity", "surrogate"], "left_anti")


def _settled(docs: DataFrame, key: bytes, text: str, make) -> DataFrame:
    """``docs`` with the surrogates that each text has instead of the permuted ones; null unless ``collisions`` finds
    some. Reads ``docs`` once more."""
    kind = "array<struct<kind: string, entity: string, surrogate: string>>"
    pairs = _pairs(docs, key, text, make)
    if collisions(pairs).isEmpty():
        return docs.withColumn(_GIVEN, F.lit(None).cast(kind))
    other = _other_surrogates(pairs, key, make)
    places = _pairs(docs, key, text, make, hashed=True).select("kind", "entity", "hash").distinct()
    given = places.join(other, ["kind", "entity"]).groupBy("hash").agg(
        F.collect_list(F.struct("kind", "entity", "surrogate")).alias(_GIVEN)).withColumnRenamed("hash", "_given_hash")
    return docs.join(given, F.sha2(F.col(text).cast("string").cast("binary"), 256) == F.col("_given_hash"), "left").drop("_given_hash")


def _replaced_batch(batch: pa.RecordBatch, text: str, surrogates: Surrogates) -> list:
    at, given = batch.schema.get_field_index(text), batch.column(batch.schema.get_field_index(_GIVEN)).to_pylist()
    return [(None, []) if t is None else replaced(t, surrogates, {(x["kind"], x["entity"]): x["surrogate"] for x in g or ()})
            for t, g in zip(batch.column(at).to_pylist(), given)]


def with_surrogates(docs: DataFrame, key: bytes, text: str = "text", make=Surrogates) -> DataFrame:
    """All columns of ``docs`` with entities of ``text`` replaced. Null stays null; a text without entities
    is returned as it is."""
    docs = docs.withColumn(text, F.col(text).cast("string"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text)
        s = make(key) if not hasattr(work, "held") else work.held
        work.held = s
        new = pa.array([t for t, _ in _replaced_batch(batch, text, s)], batch.column(at).type)
        return pa.RecordBatch.from_arrays([*batch.columns[:at], new, *batch.columns[at + 1:-1]], batch.schema.names[:-1])

    return _settled(docs, key, text, make).mapInArrow(arrow_step(work, text), docs.schema)


def surrogate_spans(docs: DataFrame, key: bytes, id_column: str = "doc_id", text: str = "text",
                    make=Surrogates) -> DataFrame:
    """id, ``n_entities``, ``spans`` and the replaced ``text`` of every row; a null text stays null."""
    source = docs.select(F.col(id_column).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = dict(source.dtypes)["doc"]

    def work(batch: pa.RecordBatch) -> pa.Table:
        s = make(key) if not hasattr(work, "held") else work.held
        work.held = s
        both = _replaced_batch(batch, "text", s)
        names = ("start", "end", "kind", "entity", "surrogate")
        spans = pa.array([[dict(zip(names, x)) for x in b[1]] for b in both], pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32())] + [(n, pa.string()) for n in names[2:]])))
        return pa.table({"doc": batch.column(0), "n_entities": pa.array([len(b[1]) for b in both], pa.int64()),
                         "spans": spans, "text": pa.array([b[0] for b in both], pa.string())})

    out = _settled(source, key, "text", make).mapInArrow(
        arrow_step(work, "text"), f"doc {kind}, n_entities long, spans {SPANS}, text string")
    return out.withColumnRenamed("doc", id_column)


def collisions(spans: DataFrame) -> DataFrame:
    """Surrogates that stand for more than one entity, and entities with more than one surrogate, over all
    documents (their ``spans``, or rows of kind, entity and surrogate); empty when distinctness and coreference hold."""
    if "spans" in spans.columns:
        spans = spans.select(F.explode("spans").alias("s")).select("s.kind", "s.entity", "s.surrogate")
    sides = F.array(F.struct(F.lit("shared").alias("what"), F.col("surrogate").alias("value")),
                    F.struct(F.lit("split").alias("what"), F.col("entity").alias("value")))
    pairs = spans.distinct().select("kind", F.explode(sides).alias("x")).select("kind", "x.what", "x.value")
    return pairs.groupBy("kind", "value", "what").count().where("count > 1").select("kind", "value", "count", "what")
