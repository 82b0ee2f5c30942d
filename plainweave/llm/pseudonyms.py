"""Personal numbers and dates replaced by format-preserving pseudonyms.

A found value is validated (check digits, ranges, calendar), read as a number
of its format's domain, permuted there by a keyed Feistel network and written
in the same format. Equal values become equal pseudonyms in every document,
different ones stay different, and whoever holds the key can turn them back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plainweave.llm import words as W

ROUNDS = 10
KNOWN_VALUES = 1 << 16
KINDS = ["email", "card", "iban", "phone", "ssn", "ip", "date", "secret"]
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73414  # to the end of 2100

PATTERN = re.compile(
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b)"
    r"|(?P<secret>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
    r"|(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))\s*[=:]\s*[\"']?[A-Za-z0-9_+/-]{8,}(?<!_))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d))"
    r"|(?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d]|[/.-]\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w))"
)
# Lengths of IBANs by country, and of cards by first digit where not all occur.
IBAN_LENGTHS = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
        25: "AO CV GW LY MZ PT ST", 26: "IR IS TR", 27: "BF BI BJ CF CG CI CM DJ FR GA GQ GR IT KM MC MG ML MR NE SM SN TD TG",
        28: "AL AZ BY CY DO EG GT HN HU LB MA NI PL SV", 29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
CARD_LENGTHS = {"1": (15,), "4": (13, 16, 19)}
FOREIGN = re.compile(r"[^\D0-9]")  # digits of other scripts
WORTH = re.compile(r"[\d@]|[=:]\s*[\"']?[A-Za-z0-9_+/-]{8}")


class Cipher:
    """Keyed permutation of the numbers below any size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, k: int, value: int, size: int) -> int:
        data = f"{tweak}|{k}|{value}".encode()
        wide = hashlib.blake2b(data, key=self.key, digest_size=64).digest()
        return int.from_bytes(wide, "big") % size

    def _sides(self, size: int) -> tuple[int, int]:
        a = isqrt(size - 1) + 1
        return a, -(-size // a)

    def permute(self, number: int, size: int, tweak: str) -> int:
        """One to one on 0 to size - 1; a number outside the domain that the
        two sides make up a little more of is permuted again."""
        if size < 2:
            return number
        a, b = self._sides(size)
        while True:
            left, right = divmod(number, b)
            for k in range(0, ROUNDS, 2):
                left = (left + self._round(tweak, k, right, a)) % a
                right = (right + self._round(tweak, k + 1, left, b)) % b
            number = left * b + right
            if number < size:
                return number

    def restore(self, number: int, size: int, tweak: str) -> int:
        if size < 2:
            return number
        a, b = self._sides(size)
        while True:
            left, right = divmod(number, b)
            for k in reversed(range(0, ROUNDS, 2)):
                right = (right - self._round(tweak, k + 1, left, b)) % b
                left = (left - self._round(tweak, k, right, a)) % a
            number = left * b + right
            if number < size:
                return number


DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def alphabet(char: str) -> str:
    return DIGITS if char in DIGITS else LOWER if char in LOWER else UPPER if char in UPPER else char


def by_alphabets(text: str, alphabets: list[str], tweak: str, turn) -> str:
    """Characters permuted together, each within its alphabet."""
    size = number = 0
    size = 1
    for char, letters in zip(text, alphabets):
        number = number * len(letters) + letters.index(char)
        size *= len(letters)
    number = turn(number, size, tweak)
    out = []
    for letters in reversed(alphabets):
        number, at = divmod(number, len(letters))
        out.append(letters[at])
    return "".join(reversed(out))


def filled(shape: str, digits: str) -> str:
    """`shape` with its digits replaced in order."""
    take = iter(digits)
    return "".join(next(take) if c in DIGITS else c for c in shape)


def rescripted(made: str, raw: str) -> str:
    """`made` with its digits in the scripts of those of `raw`, run by run."""
    runs = iter(re.findall(r"\d+", raw))

    def written(found: re.Match) -> str:
        run = next(runs)
        zeros = [ord(c) - int(c) for c in run]
        return "".join(chr(zeros[min(k, len(zeros) - 1)] + int(c)) for k, c in enumerate(found.group()))

    return re.sub(r"\d+", written, made)


def luhn(digits: str) -> int:
    """Zero for a number with a right check digit."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _card(value: str, turn) -> str | None:
    digits = re.sub(r"\D", "", value)
    if not 13 <= len(digits) <= 19 or luhn(digits) or digits[0] == "0":
        return None
    mark = luhn(digits + "0")
    while True:  # until a number behind it reads as part of the card or not as before
        body = digits[0] + by_alphabets(digits[1:-1], [DIGITS] * (len(digits) - 2), f"card{len(digits)}{digits[0]}", turn)
        digits = body + str(-luhn(body + "0") % 10)
        if luhn(digits + "0") == mark:
            return filled(value, digits)


def _iban(value: str, turn) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return None

    def rest(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text)) % 97

    if rest(plain[4:] + plain[:4]) != 1:
        return None
    body = plain[4:]
    body = by_alphabets(body, [alphabet(c) for c in body], f"iban{plain[:2]}{shape(body)}", turn)
    made = f"{plain[:2]}{98 - rest(body + plain[:2] + '00'):02d}{body}"
    take = iter(made)
    return "".join(c if c == " " else next(take) for c in value)


def shape(text: str) -> str:
    return "".join("9" if c in DIGITS else "a" if c in LOWER else "A" if c in UPPER else c for c in text)


def _domestic(digits: str) -> bool:
    """Ten digits, 1 in front or not, with area and exchange from 2 to 9 on."""
    local = digits[-10:]
    return len(digits) in (10, 11) and digits[:-10] in ("", "1") and local[0] in DIGITS[2:] and local[3] in DIGITS[2:]


def _phone(value: str, turn) -> str | None:
    digits = re.sub(r"\D", "", value)
    if not 7 <= len(digits) <= 15:
        return None
    if _domestic(digits):
        high = DIGITS[2:]
        kinds = [high, DIGITS, DIGITS, high, *[DIGITS] * 6]
        return filled(value, digits[:-10] + by_alphabets(digits[-10:], kinds, "phone10", turn))
    country = re.match(r"\+(\d{1,3})(?=[ .(-])", value)
    n = len(country.group(1)) if country else 2 if value[0] == "+" else 0
    kinds = [DIGITS] * (len(digits) - n)
    while True:  # among the numbers that are not domestic
        digits = digits[:n] + by_alphabets(digits[n:], kinds, f"phone{digits[:n]}/{len(kinds)}", turn)
        if not _domestic(digits):
            return filled(value, digits)


def _ssn(value: str, turn) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(turn(number, 898 * 99 * 9999, "ssn"), 9999)
    area, group = divmod(number, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _ip(value: str, turn) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    number = turn(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _date(value: str, turn) -> str | None:
    mark = next(c for c in value if c not in DIGITS)
    parts = value.split(mark)

    def day(y: str, m: str, d: str) -> int | None:
        try:
            n = datetime.date(int(y), int(m), int(d)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        return n if 0 <= n < DAYS else None

    def written(n: int, order: str) -> str:
        at = datetime.date.fromordinal(FIRST_DAY + n)
        full = {"y": f"{at.year:04d}", "m": at.month, "d": at.day}
        return mark.join(full[o] if o == "y" else f"{full[o]:0{width}d}" for o in order)

    if len(parts[0]) == 4:
        n, order, width = day(*parts), "ymd", 2
    else:
        width = 2 if len(parts[0]) == len(parts[1]) == 2 else 1
        n, order = day(parts[2], parts[1], parts[0]), "dmy"
        if n is None:
            n, order = day(parts[2], parts[0], parts[1]), "mdy"
    if n is None:
        return None
    while True:  # until the result reads in the same order, written as widely
        n = turn(n, DAYS, f"date{order}{mark}{width}")
        at = datetime.date.fromordinal(FIRST_DAY + n)
        if order == "mdy" and at.day < 13:
            continue
        if width == 1 and at.day > 9 and at.month > 9:
            continue
        return written(n, order)


def _email(value: str, turn) -> str | None:
    local, domain = value.split("@")
    return by_alphabets(local, [alphabet(c) for c in local], f"email{shape(local)}@{domain.lower()}", turn) + "@" + domain


def _secret(value: str, turn, ascii_: bool = True) -> str | None:
    at = re.search(r"[A-Za-z0-9_+/-]+$", value).start()
    head, body = value[:at], value[at:]
    if not head:
        head, body = body[:4], body[4:]
    elif not any(c in DIGITS for c in body):
        return None  # a word, not a key
    hexes = ascii_ and all(c in HEX for c in body)
    kinds = [HEX if hexes else alphabet(c) for c in body]
    tweak = f"secret{len(body)}{'x' if hexes else shape(body)}"
    while True:  # among keys of the same kind
        body = by_alphabets(body, kinds, tweak, turn)
        if not ascii_ or hexes == all(c in HEX for c in body) and (not hexes or any(c in DIGITS for c in body)):
            return head + body


RULES = {"email": _email, "card": _card, "iban": _iban, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date, "secret": _secret}
RULES["secret in scripts"] = lambda value, turn: _secret(value, turn, False)  # digits stay where their script is


def readings(kind: str, value: str) -> list[str]:
    """What a found value may be: a card or an IBAN may have taken in a number or
    word behind it, so its starts up to a separator are read too. A card's longest
    start goes first, an IBAN's of its country's length; which one is taken is
    the same for the pseudonym."""
    if kind not in ("card", "iban"):
        return [value]
    starts = [value, *(value[: m.start()] for m in reversed(list(re.finditer("[ -]", value))))]
    sizes = [sum(c.isalnum() for c in start) for start in starts]
    if kind == "card":
        likely = CARD_LENGTHS.get(value[0], range(13, 20))
        return [value, *(start for start, n in zip(starts[1:], sizes[1:]) if n in likely)]
    own = IBAN_LENGTHS.get(value[:2])
    if own in sizes:
        return [starts[sizes.index(own)], value]
    return [value] if own else starts


class Pseudonyms:
    """Replaces the values of one key; keeps a bounded table of those it has met."""

    def __init__(self, key: bytes, back: bool = False):
        cipher = Cipher(key)
        self.turn = cipher.restore if back else cipher.permute
        self.known: dict[tuple[str, str], str | None] = {}

    def value(self, kind: str, found: str) -> str | None:
        at = (kind, found)
        if at not in self.known:
            if len(self.known) >= KNOWN_VALUES:
                self.known.clear()
            self.known[at] = RULES[kind](found, self.turn)
        return self.known[at]

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, as long as before but for addresses and
        short dates, and how many values of each kind it held. Digits of any
        script are read by their value and written back in their script."""
        counts: dict[str, int] = {}
        if not WORTH.search(text):
            return text, counts
        out, upto, at = [], 0, 0
        plain = text if text.isascii() else FOREIGN.sub(lambda m: str(int(m.group())), text)
        while found := PATTERN.search(plain, at):
            kind, start = found.lastgroup, found.start()
            for read in readings(kind, found.group()):
                raw = text[start : start + len(read)]
                made = self.value(kind if raw == read or kind != "secret" else "secret in scripts", read)
                if made is not None:
                    break
            else:  # not valid as this kind: look on behind its first character
                at = start + 1
                continue
            counts[kind] = counts.get(kind, 0) + 1
            out += [text[upto:start], made if raw == read else rescripted(made, raw)]
            upto = at = start + len(read)
        return ("".join([*out, text[upto:]]), counts) if out else (text, counts)


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False) -> DataFrame:
    """`docs` with its texts under pseudonyms, n_values (how many were replaced)
    and n_<kind> for every kind of KINDS. `back` undoes it with the same key.

    A null text stays null and an empty one empty, with no values. Texts are
    read whole; repeated rows give repeated results; an empty table gives an
    empty result; columns with the names of the counts are replaced.
    """
    counts = ["n_values", *(f"n_{k}" for k in KINDS)]
    keep = [c for c in docs.columns if c not in counts]

    def run(batches):
        names = Pseudonyms(key, back)
        for batch in W.slices(batches, text_col):
            made = [(None, {}) if t is None else names.text(t) for t in batch.column(text_col).to_pylist()]
            numbers = [[sum(c.values()) for _, c in made], *([c.get(k, 0) for _, c in made] for k in KINDS)]
            columns = [pa.array([t for t, _ in made], pa.string()) if c == text_col else batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(n, pa.int64()) for n in numbers)], [*keep, *counts]
            )

    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in counts)])
    return docs.select(*keep).mapInArrow(run, schema)
