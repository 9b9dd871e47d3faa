"""Stand-ins for learned models, and the interfaces that real ones fill.

There are no weights or services here, so the defaults are deterministic and offline; they make no
claim to be equivalent to a model.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from typing import Protocol


class Extractor(Protocol):
    def answer(self, prompt: str, text: str) -> str: ...


class Embedder(Protocol):
    def embed(self, text: str) -> list[float]: ...


class Detector(Protocol):
    def detect(self, image: bytes) -> list[tuple[int, float, float, float, float, float]]: ...

    def size(self, image: bytes) -> tuple[float, float]: ...


class PageReader(Protocol):
    """For formats that are read file by file (Word, images; PDF, .msg by a caller's own): text, metadata
    and image of each page."""

    def pages(self, content: bytes, path: str) -> list[tuple[str, dict[str, str], bytes | None]]: ...


class ImageSteps(Protocol):
    """Clean-up of page images, in this order."""

    def deskew(self, image: bytes) -> bytes: ...

    def denoise(self, image: bytes) -> bytes: ...

    def contrast(self, image: bytes) -> bytes: ...

    def enlarge(self, image: bytes, factor: int) -> bytes: ...


class Cropper(Protocol):
    def crop(self, image: bytes, x0: float, y0: float, x1: float, y1: float) -> bytes: ...


class Retrying:
    """An extractor over calls that give (status, body), such as an HTTP service: what is worth another try
    gets one."""

    def __init__(self, call, sleep=None):
        self.call, self.sleep = call, sleep

    def answer(self, prompt: str, text: str) -> str:
        from quire.operators.extraction import with_retry

        return with_retry(lambda: self.call(prompt, text), **({"sleep": self.sleep} if self.sleep else {}))


class RuleExtractor:
    """Answers with the region's own text, the first 200 characters of its first sentence as overview (an
    overview is short by its nature; the text stays whole), and capitalised words as entities."""

    waits = False
    NAME = re.compile(r"\b[A-Z][a-z]{2,}(?: [A-Z][a-z]{2,})*\b")

    def answer(self, prompt: str, text: str) -> str:
        text = text or ""
        first = re.split(r"(?<=[.!?])\s", text.strip(), maxsplit=1)[0][:200]
        entities = [{"text": t, "type": "ORG" if " " in t else "PERSON", "value": t} for t in dict.fromkeys(self.NAME.findall(text))]
        return json.dumps({"text": text, "markdown": text if "|" in text else "", "latex": text, "overview": first or "Empty region.", "entities": entities})


@functools.lru_cache(1 << 16)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


class HashEmbedder:
    """A bag of hashed words, of length 1."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, text: str) -> list[float]:
        out = [0.0] * self.dim
        for word in re.findall(r"\w+", (text or "").lower()):
            h = _word_hash(word)
            out[h % self.dim] += 1.0 if h >> 63 else -1.0
        length = math.sqrt(sum(x * x for x in out))
        return [x / length for x in out] if length else out
