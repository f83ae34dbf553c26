"""Token ids of whole texts with a public tokenizer, fast inside tasks.

The ids are exactly those of ``Tokenizer.encode(text, add_special_tokens=
False)``.  The tokenizer's pieces never span white space, so texts of plain
Latin characters are cut into pieces here, many texts at a time, and the
pieces are merged by rank in one call: the end of a piece is a space, the pair
of a byte and that space comes first, then the vocabulary file's merges in
their order.  Ranks belong to tokens, merges to pairs; both give the same ids
where every token is what its own symbols merge to, and a token that isn't
can't occur, so it gets no rank (``reachable``).  Every other text (other
scripts, combining marks, control characters, special-token strings, pieces of
over ``LONG_PIECE`` bytes) goes through the tokenizer whole, which is loaded
when the first one comes.  Nothing is kept from one text to the next, so the
memory of a worker is that of the vocabulary and of the texts held.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np

#: Vocabulary file of the registered queries (a parameter everywhere else).
WORD_BPE = "word_bpe_49k.json"

HELD_CHARS = 1 << 20  # characters of texts that are encoded at a time
LONG_PIECE = 1000  # merging by rank takes the square of a piece's bytes

# The pre-tokenizer pattern that the shortcut is for; the
# normalizing steps; the end of a piece in the vocabulary file.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
END_OF_PIECE = "</w>"
# Characters outside of which lower-casing, composition or classes may differ
# between libraries: printable ASCII, white space, Latin letters with marks.
UNUSUAL = re.compile("[^\t-\r\x20-\x7eÀ-įı-ňŊ-ž]|<\\|")

# Kinds of the bytes of usual text: of those above ASCII all but the signs for
# "times" and "divided by" belong to letters.
GAP, LETTER, DIGIT, SIGN = range(4)
KINDS = np.full(256, SIGN, np.uint8)
KINDS[[0, *range(0x09, 0x0E), 0x20]] = GAP
KINDS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = LETTER
KINDS[[*range(ord("0"), ord("9") + 1)]] = DIGIT

USUAL_ASCII = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F)])


def unusual(text: str) -> bool:
    """Whether ``UNUSUAL`` occurs in the text."""
    if not text.isascii():
        return UNUSUAL.search(text) is not None
    return "<|" in text or bool(text.encode("ascii").translate(None, USUAL_ASCII))


def vocabulary_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def by_piece(file: dict) -> bool:
    """Whether a vocabulary file is of the kind that the shortcut is for."""
    model, split = file["model"], (file["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])] == NORMALIZERS
        and [p["type"] for p in split] == ["Split", "ByteLevel"]
        and split[0]["pattern"] == {"Regex": PIECE_PATTERN}
        and model["type"] == "BPE"
        and model["end_of_word_suffix"] == END_OF_PIECE
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    )


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary file: its own
    where it is printable, else the next one from 256 on."""
    plain = {b: chr(b) for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173}
    others = [b for b in range(256) if b not in plain]
    return plain | {b: chr(256 + i) for i, b in enumerate(others)}


def symbols(token: str) -> list[str]:
    """The symbols that merges start from."""
    if not token.endswith(END_OF_PIECE):
        return list(token)
    letters = token[: -len(END_OF_PIECE)]
    return [*letters[:-1], letters[-1] + END_OF_PIECE]


def reachable(token: str, order: dict[tuple[str, str], int]) -> bool:
    """Whether a token's symbols merge to the token."""
    parts = symbols(token)
    while len(parts) > 1:
        rank, at = min((order.get(pair, len(order)), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if rank == len(order):
            return False
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


def cut_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of usual texts as bytes, a space after each; and the end of
    each text in them."""
    line = np.frombuffer("\0".join([*texts, ""]).lower().encode(), np.uint8)
    kind = KINDS[line]
    after = np.append(line[1:], np.zeros(3, np.uint8))
    signs = np.flatnonzero((line == 0xC3) & ((after[:-2] == 0x97) | (after[:-2] == 0xB7)))
    kind[signs] = kind[signs + 1] = SIGN
    last = (kind == DIGIT) | (kind != np.append(kind[1:], np.uint8(GAP)))
    # short forms: where an apostrophe doesn't go on with other signs
    at = np.flatnonzero(line == ord("'"))
    at = at[(at == 0) | (kind[at - 1] != SIGN)]
    one, two = after[at], after[at + 1]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    longer = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l"))
    last[at[short | longer]] = False
    last[at[short] + 1] = last[at[longer] + 2] = True
    last &= kind != GAP
    times = last.astype(np.int8) + (kind != GAP)
    out = np.repeat(line, times)
    ends = np.cumsum(times, dtype=np.int64)
    out[ends[last] - 1] = ord(" ")
    return out, ends[line == 0]


class Encoder:
    """Ids of texts as unsigned 32-bit arrays."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.by_piece = by_piece(file)
        if self.by_piece:
            vocabulary = file["model"]["vocab"]
            self.size = len(vocabulary.keys() | {t["content"] for t in file["added_tokens"]})
            self._rank(vocabulary, [tuple(m.split(" ") if isinstance(m, str) else m) for m in file["model"]["merges"]])
        else:
            self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    @cached_property
    def tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _rank(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        import tiktoken

        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        order = {pair: i for i, pair in enumerate(merges)}
        ranks: dict[bytes, int] = {}
        names = [c + END_OF_PIECE for c in letters.values()] + list(letters.values())
        names += [a + b for a, b in merges if len(symbols(a + b)) == 2 or reachable(a + b, order)]
        for name in names:
            ends = name.endswith(END_OF_PIECE)
            own = bytes(byte_of[c] for c in (name[: -len(END_OF_PIECE)] if ends else name))
            ranks.setdefault(own + b" " if ends else own, len(ranks))
        self.ids, self.ends = np.zeros(len(ranks), np.uint32), np.zeros(len(ranks), bool)
        for token, rank in ranks.items():
            ends = len(token) > 1 and token.endswith(b" ")
            name = "".join(letters[b] for b in (token[:-1] if ends else token)) + (END_OF_PIECE if ends else "")
            self.ids[rank], self.ends[rank] = vocabulary[name], ends
        self.merged = tiktoken.Encoding("pieces", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_usual(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that hold none of the unusual characters."""
        line, ends = cut_pieces(texts)
        spaces = np.flatnonzero(line == ord(" "))
        long = spaces[np.diff(spaces, prepend=-1) > LONG_PIECE + 1]
        if len(long):
            own = set(np.searchsorted(ends, long, side="right").tolist())
            others = iter(self._encode_usual([t for i, t in enumerate(texts) if i not in own]))
            return [self._whole(t) if i in own else next(others) for i, t in enumerate(texts)]
        ranks = self.merged.encode_to_numpy(line.tobytes().decode()) if len(line) else np.zeros(0, np.uint32)
        ids = self.ids[ranks]
        # each piece has one token that ends it, the last
        stops = np.append(0, np.flatnonzero(self.ends[ranks]) + 1)[np.searchsorted(spaces, ends)]
        return [ids[a:b] for a, b in zip(np.append(0, stops[:-1]), stops)]

    def _encode_held(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = [not self.by_piece or unusual(t) for t in texts]
        usual = iter(self._encode_usual([t for t, w in zip(texts, whole) if not w]) if self.by_piece else ())
        for t, w in zip(texts, whole):
            yield self._whole(t) if w else next(usual)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are taken about ``HELD_CHARS`` characters
        at a time, so that their pieces are encoded in one call."""
        held, size = [], 0
        for t in texts:
            held.append(t or "")
            size += len(held[-1])
            if size >= HELD_CHARS:
                yield from self._encode_held(held)
                held, size = [], 0
        yield from self._encode_held(held)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
