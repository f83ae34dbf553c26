"""Personal data by anchor expansion.

An Aho-Corasick automaton scans each text once for anchors: at-signs, digits,
plus signs, URL schemes and identifier cues.  Every anchor starts a
deterministic local parser that expands to the left and right, finds the
boundaries and validates what it found:

=========  ==============================  =======================================
kind       anchor                          boundary and check
=========  ==============================  =======================================
email      ``@``                           local part to the left, dotted domain
ip         digit                           four numbers of at most 255
card       digit                           13 to 19 digits, Luhn
phone      ``+``                           9 to 15 digits
url        ``://`` after a scheme          to white space, quote or bracket
account    cue (IBAN, account, acct, SSN)  IBAN mod 97, SSN parts, 6 to 17 digits
address    street type word                house number and capitalised names
secret     cue (token, secret, api_key..)  quoted or bare value of 16 or more
=========  ==============================  =======================================

The first four are the base kinds; the others are added by the method and
never hide a base span.  Parsers look at a bounded neighbourhood or consume
what they read, so a text costs time in proportion to its length.

Defined results: a null text counts as empty; empty texts give no spans;
repeated rows each give their own row; other columns of the input are ignored
(``find``) or kept (``mask``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegralType

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "address", "secret")

# Characters, schemes, cues and street words of the parsers.
DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = LETTERS | DIGITS
LOCAL_PART = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE_BODY = DIGITS | frozenset(" ().-")
URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`{}|\\^")
SCHEMES = ("http", "https", "ftp", "ftps", "sftp", "ssh")
ACCOUNT_CUES = ("IBAN", "iban", "account", "Account", "acct", "Acct", "SSN", "ssn")
SECRET_CUES = ("token", "secret", "api_key", "apikey", "API_KEY", "password", "passwd")
STREET_WORDS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Square", "Court")

NEAR = 8  # characters a cue may stand before its value
ADDRESS_REACH = 64  # characters an address may reach to the left of its street word


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for words, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret"), (STREET_WORDS, "street")):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban(text: str) -> bool:
    """ISO 13616: the rearranged number leaves 1 modulo 97."""
    s = text.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL_PART:
        start -= 1
    if start == at:
        return None
    n, end, labels, i = len(text), 0, 0, at + 1
    while True:
        j = i
        while j < n and text[j] in LABEL:
            j += 1
        if j == i:
            break
        end, labels = j, labels + 1
        if j < n and text[j] == ".":
            i = j + 1
        else:
            break
    return (start, end) if labels >= 2 else None


def _numbers(text: str, at: int, found: list[tuple[str, int, int]]) -> int:
    """IP addresses and cards of the digit cluster that starts at ``at``:
    digits joined by single dots, blanks or hyphens.  Returns its end."""
    n, i = len(text), at
    groups: list[tuple[int, int]] = []
    while True:
        j = i
        while j < n and text[j] in DIGITS:
            j += 1
        groups.append((i, j))
        if j + 1 < n and text[j] in ". -" and text[j + 1] in DIGITS:
            i = j + 1
        else:
            break
    end = groups[-1][1]
    for separators, kind in ((".", "ip"), (" -", "card")):
        lo = 0
        while lo < len(groups):
            hi = lo + 1
            while hi < len(groups) and text[groups[hi - 1][1]] in separators:
                hi += 1
            if kind == "ip":
                for g in range(lo, hi - 3, 4):
                    parts = groups[g : g + 4]
                    if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b].lstrip("0") or 0) <= 255 for a, b in parts):
                        found.append(("ip", parts[0][0], parts[3][1]))
            else:
                size = sum(b - a for a, b in groups[lo:hi])
                if 13 <= size <= 19 and luhn("".join(text[a:b] for a, b in groups[lo:hi])):
                    found.append(("card", groups[lo][0], groups[hi - 1][1]))
            lo = hi
    return end


def _phone(text: str, at: int) -> tuple[int, int, bool] | None:
    """Match of a number that starts with the plus at ``at``, if its shape
    fits, and whether its digits pass."""
    n = len(text)
    if at + 1 >= n or text[at + 1] not in DIGITS:
        return None
    last, digits, counted, i = 0, 1, 0, at + 2
    while i < n and text[i] in PHONE_BODY:
        if text[i] in DIGITS:
            digits += 1
            if i >= at + 3:
                last, counted = i, digits
        i += 1
    return (at, last + 1, 9 <= counted <= 15) if last else None


def _url(text: str, colon: int) -> tuple[int, int] | None:
    start = colon
    while start > 0 and colon - start <= 5 and text[start - 1] in LETTERS:
        start -= 1
    if text[start:colon].lower() not in SCHEMES or (start and text[start - 1] in ALNUM):
        return None
    n, end = len(text), colon + 3
    if end >= n or text[end] not in ALNUM:
        return None
    while end < n and text[end] not in URL_END:
        end += 1
    while text[end - 1] in ".,;:!?)]*":
        end -= 1
    return (start, end) if end > colon + 3 else None


def _after_cue(text: str, cue_end: int) -> int:
    """First letter or digit within ``NEAR`` characters of blanks, '=', ':',
    '#' or quotes after a cue; -1 if there is none."""
    for i in range(cue_end, min(len(text), cue_end + NEAR)):
        if text[i] in ALNUM:
            return i if i > cue_end else -1
        if text[i] not in " \t=:#\"'":
            return -1
    return -1


def _account(text: str, cue: str, cue_end: int) -> tuple[int, int] | None:
    start = _after_cue(text, cue_end)
    if start < 0:
        return None
    end = start
    while end < len(text) and end - start < 42 and (text[end] in ALNUM or text[end] in " -"):
        end += 1
    if cue.lower() == "iban":
        value = text[start:end].split("-")[0].rstrip()
        while value:  # whole groups, longest first
            if value[:2].isalpha() and value[2:4].isdigit() and iban(value):
                return start, start + len(value)
            value = value.rpartition(" ")[0].rstrip()
        return None
    end = start
    while end < len(text) and (text[end] in DIGITS or text[end] == "-" and end + 1 < len(text) and text[end + 1] in DIGITS):
        end += 1
    parts = text[start:end].split("-")
    if cue.lower() == "ssn":
        good = [len(p) for p in parts] == [3, 2, 4] and parts[0] not in ("000", "666") and "00" != parts[1] and parts[2] != "0000"
        return (start, end) if good else None
    return (start, end) if 6 <= sum(map(len, parts)) <= 17 else None


def _secret(text: str, cue_end: int) -> tuple[int, int] | None:
    start = _after_cue(text, cue_end)
    if start < 0 or not any(c in "=:" for c in text[cue_end:start]):
        return None
    end = start
    while end < len(text) and (text[end] in ALNUM or text[end] in "_-"):
        end += 1
    return (start, end) if end - start >= 16 and any(c in DIGITS for c in text[start:end]) else None


def _address(text: str, word_start: int, word_end: int) -> tuple[int, int] | None:
    """House number, one to four capitalised words, street word."""
    if word_end < len(text) and text[word_end] in ALNUM:
        return None
    words = text[max(0, word_start - ADDRESS_REACH) : word_start].split(" ")
    if len(words) < 2 or words[-1] != "":
        return None
    at, names = word_start, 0
    for w in reversed(words[:-1]):
        at -= len(w) + 1
        if w.isascii() and w.isdigit() and 1 <= len(w) <= 5 and names:
            return (at, word_end) if at == 0 or text[at - 1] not in ALNUM else None
        if not (w.isalpha() and w[0].isupper()) or names == 4:
            return None
        names += 1
    return None


_shared: list[ahocorasick.Automaton] = []


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, ordered by kind as in
    ``KINDS``, then start."""
    if not _shared:
        _shared.append(_automaton())
    found: list[tuple[str, int, int]] = []
    email_floor = number_end = url_end = address_end = account_end = secret_end = 0
    for last, (anchor, size) in _shared[0].iter(text):
        first = last + 1 - size
        if anchor == "digit":
            if last >= number_end:
                number_end = _numbers(text, last, found)
        elif anchor == "at":
            if m := _email(text, last, email_floor):
                found.append(("email", *m))
                email_floor = m[1]
        elif anchor == "plus":
            if (m := _phone(text, last)) and m[2]:
                found.append(("phone", m[0], m[1]))
        elif anchor == "scheme":
            if first >= url_end and (m := _url(text, first)):
                found.append(("url", *m))
                url_end = m[1]
        elif anchor == "account":
            if first >= account_end and (m := _account(text, text[first : last + 1], last + 1)):
                found.append(("account", *m))
                account_end = m[1]
        elif anchor == "secret":
            if first >= secret_end and (m := _secret(text, last + 1)):
                found.append(("secret", *m))
                secret_end = m[1]
        elif first >= address_end and (m := _address(text, first, last + 1)):
            found.append(("address", *m))
            address_end = m[1]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (order[s[0]], s[1]))


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


FIND_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the SHA-256 of their
    spans, and all spans as ``kind:start:end`` joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.zeros((len(BASE_KINDS), b.num_rows), np.int64)
            digests, all_spans = [], []
            for i, value in enumerate(b.column(1)):
                found = spans(value.as_py() or "")
                base = [s for s in found if s[0] in BASE_KINDS]
                for s in base:
                    counts[BASE_KINDS.index(s[0]), i] += 1
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                all_spans.append(_joined(found))
            arrays = [b.column(0), *(pa.array(c) for c in counts), pa.array(digests, pa.string()), pa.array(all_spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in FIND_SCHEMA.split(", ")])

    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return own.mapInArrow(run, FIND_SCHEMA)


def masked(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans are merged under the kind that starts first."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data masked in ``text_col``;
    ``length_col`` (if there is one, of whole numbers) then holds the new
    number of code points where the text changed.  Null texts stay null."""
    at = docs.columns.index(text_col)
    whole = length_col in docs.columns and isinstance(docs.schema[length_col].dataType, IntegralType)
    length_at = docs.columns.index(length_col) if whole else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            found = [spans(t) if t else [] for t in texts]
            if any(found):
                new = [masked(t, s) if s else t for t, s in zip(texts, found)]
                arrays = list(b.columns)
                arrays[at] = pa.array(new, b.column(at).type)
                if length_at is not None:
                    old = b.column(length_at).to_pylist()
                    arrays[length_at] = pa.array([len(t) if s else n for t, s, n in zip(new, found, old)], b.column(length_at).type)
                b = pa.RecordBatch.from_arrays(arrays, schema=b.schema)
            yield b

    return docs.mapInArrow(run, docs.schema)
