"""Byte-level BPE through the tokenizers library, with a cache of pieces.

The pre-tokeniser of a byte-level BPE never lets a token cross certain places: from a character
that is not white space to one that is, past a lone line end between two that aren't, or from a
letter or digit to a comma or full stop. So a text cut at those places may be encoded piece by
piece, and pieces (mostly a space and a word) repeat. A piece that the cache lacks and that holds
only ASCII signs and Latin letters is cut further into the pre-tokens it surely has, and each goes to
the library's BPE model; any other piece goes through the library's whole tokenizer, and so does a
text whose tokenizer isn't of this kind or that holds one of its added tokens.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from quire.llm.common import worker_state

PIECE = re.compile(r"\n(?=[^ \n])|[ \n]*[^\W_]+(?=[,.])|[ \n]*[^ \n]+|[ \n]+")
#: With one of these the quick way to cut a text doesn't hold, nor with a comma or full stop that doesn't
#: follow a letter or digit (it may share a token with what is before it).
CROWDED = ("\0", "  ", "\n\n", " \n", "\n ")
LOOSE_POINT = re.compile(r"[.,](?<![^\W_][.,])")
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A piece whose pre-tokens are known: no white space but one space first, no apostrophe.
KNOWN = re.compile(f" ?[!-&(-~{LATIN}]+")
PRE_TOKEN = re.compile(f" ?[{LATIN}]+| ?[0-9]+| ?[^ 0-9{LATIN}]+")
#: Other white space, or what one library counts as such and another doesn't.
OTHER_SPACE = re.compile(r"[^\S \n]")
#: A full cache keeps what it has, which are the frequent pieces, until it has missed this many
#: times its size: then the texts have changed, and it starts anew.
CACHE_ENTRIES = 400_000
OTHER_ENTRIES = 20_000
STALE = 8
LONGEST_CACHED = 48


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others, in order,
    for the code points from 256 on."""
    shown = {b for a, z in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(a, z + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


ALPHABET = byte_alphabet()


class Cache(dict):
    """Ids of pieces; a piece it lacks is encoded. Full, it keeps what it has, the frequent pieces."""

    def __init__(self, ids, entries: int):
        super().__init__()
        self.ids, self.entries, self.missed = ids, entries, 0

    def __missing__(self, piece: str) -> bytes:
        found = self.ids(piece)
        if len(piece) <= LONGEST_CACHED:
            self[piece] = found
        return found

    def shrink(self, before: int) -> None:
        """Forget what came last, down to the bound; or everything, if the texts have changed."""
        if len(self) > self.entries:
            self.missed += len(self) - before
            if self.missed > STALE * self.entries:
                self.missed = 0
                self.clear()
            for _ in range(len(self) - max(before, self.entries)):
                self.popitem()


class Encoder:
    """``encode(text)`` gives the ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before, model = told.get("pre_tokenizer") or {}, told["model"]
        self.added = [t["content"] for t in told.get("added_tokens", ())]
        self.quick = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not told.get("normalizer")
            and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and (told.get("post_processor") or {}).get("type") in (None, "ByteLevel") and not told.get("truncation")
        )
        self.plain = Cache(self._ids, CACHE_ENTRIES)  # pieces of the quick cut
        self.others = Cache(self._ids, OTHER_ENTRIES)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of many texts."""
        sizes = len(self.plain), len(self.others)
        out = [self._text(t) if t else b"" for t in texts]
        self.plain.shrink(sizes[0])
        self.others.shrink(sizes[1])
        return out

    def _text(self, text: str) -> bytes:
        if not self.quick or OTHER_SPACE.search(text) or any(a in text for a in self.added):
            return self._whole(text)
        if any(map(text.__contains__, CROWDED)) or LOOSE_POINT.search(text):
            return b"".join(map(self.others.__getitem__, PIECE.findall(text)))
        pieces = text.replace(" ", "\0 ").replace(",", "\0,").replace(".", "\0.").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.plain.__getitem__, pieces))

    def _ids(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):  # most pieces
            shown = "Ġ" + piece[1:] if piece[0] == " " else piece
            return array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        if KNOWN.fullmatch(piece):
            return b"".join(map(self._pre_token, PRE_TOKEN.findall(piece)))
        return self._whole(piece) if piece else b""

    def _pre_token(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(ALPHABET)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, one for a Python worker."""
    return worker_state(("bpe", path), lambda: Encoder(path))
