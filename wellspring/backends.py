"""Encoders and generators a job can be given.

An encoder factory is a picklable callable returning ``list[str] -> float32[n, dim]``; a
generator factory returns ``(system, user) -> str``. Factories are called once per Python
worker. The hashing encoder and the extractive generator need no model files: they keep the
contract of a learned model (width, truncation, mean pooling; context-only answers), not its
quality.
"""

import hashlib
import http.client
import json
import re
import urllib.parse
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from typing import ClassVar

import numpy as np
from pyspark import cloudpickle

from wellspring.functions.prompts import (
    ANSWER_CUE,
    CONTEXT_CLOSE,
    CONTEXT_OPEN,
    NO_ANSWER,
    QUESTION_CUE,
)

# The model contract the index is built for.
DIM = 384
MAX_TOKENS = 128

# Generation options sent to a chat endpoint, and seconds to wait for it.
CHAT_TIMEOUT = 180.0
CHAT_OPTIONS = {"num_predict": 128, "num_ctx": 4096, "temperature": 0.1, "repeat_penalty": 1.05}


_products: dict[bytes, object] = {}


def loaded(factory):
    """The factory's product, kept for the life of the worker. Factories are told apart by
    their pickled form, so one that is sent with every task loads once; the last two stay."""
    key = cloudpickle.dumps(factory)
    if key not in _products:
        while len(_products) > 1:
            _products.pop(next(iter(_products)))
        _products[key] = factory()
    return _products[key]


@lru_cache(maxsize=1 << 18)
def token_hash(token: str) -> int:
    """First 32 bits of the MD5 of the lower-cased token."""
    return int(hashlib.md5(token.lower().encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)


@dataclass(frozen=True)
class HashingEncoder:
    """Each token adds +1 or -1 to one bucket; a text is the mean over its tokens."""

    dim: int = DIM
    max_tokens: int | None = MAX_TOKENS

    def __call__(self):
        return self.encode

    def encode(self, texts: list[str]) -> np.ndarray:
        limit = -1 if self.max_tokens is None else self.max_tokens
        cut = None if self.max_tokens is None else self.max_tokens
        tokens = [text.split(None, limit)[:cut] for text in texts]
        counts = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        hashes = np.fromiter(map(token_hash, chain.from_iterable(tokens)), np.int64, counts.sum())
        sign, bucket = np.divmod(hashes, self.dim)
        cells = np.repeat(np.arange(len(texts)), counts) * self.dim + bucket
        sums = np.bincount(cells, weights=1.0 - 2.0 * (sign % 2), minlength=len(texts) * self.dim)
        means = sums.reshape(len(texts), self.dim) / np.maximum(counts, 1)[:, None]
        return means.astype(np.float32)


@dataclass(frozen=True)
class ExtractiveGenerator:
    """Answers with the first context sentence sharing most words with the question."""

    def __call__(self):
        return self.answer

    def answer(self, system: str, user: str) -> str:
        context, _, asked = user.removeprefix(CONTEXT_OPEN).rpartition(CONTEXT_CLOSE)
        question = asked.removeprefix(QUESTION_CUE).removesuffix(ANSWER_CUE)
        wanted = set(re.findall(r"\w+", question.lower()))
        best, most = NO_ANSWER, 0
        for sentence in re.split(r"(?<=[.!?])\s+", context):
            shared = len(wanted.intersection(re.findall(r"\w+", sentence.lower())))
            if shared > most:
                best, most = sentence.strip(), shared
        return best


@dataclass(frozen=True)
class QuotingGenerator:
    """Answers with the length of its prompt and the first letters of its context and question,
    and fails for questions that begin with a mark: a rule that can be checked word for word."""

    MARK: ClassVar[str] = "[refuse] "
    ERROR: ClassVar[str] = "refused"

    def __call__(self):
        return self.answer

    def answer(self, system: str, user: str) -> str:
        context, _, asked = user.removeprefix(CONTEXT_OPEN).rpartition(CONTEXT_CLOSE)
        question = asked.removeprefix(QUESTION_CUE)
        if question.startswith(self.MARK):
            raise RuntimeError(self.ERROR)
        return f"{len(user)}|{context[:20]}|{question[:20]}"


@dataclass(frozen=True)
class ChatEndpoint:
    """Posts system and user message to a chat HTTP endpoint, one request per question. A
    worker keeps its connection from one question to the next."""

    url: str
    model: str
    timeout: float = CHAT_TIMEOUT

    def __call__(self):
        return ChatSession(self).answer


class ChatSession:
    def __init__(self, endpoint: ChatEndpoint):
        self.endpoint = endpoint
        at = urllib.parse.urlsplit(endpoint.url)
        kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
        self.connection = kind(at.netloc, timeout=endpoint.timeout)
        self.path = at.path + (f"?{at.query}" if at.query else "")

    def answer(self, system: str, user: str) -> str:
        body = {
            "model": self.endpoint.model,
            "stream": False,
            "options": CHAT_OPTIONS,
            "messages": [
                {"role": "system", "content": system},
                {"role": "user", "content": user},
            ],
        }
        sent = json.dumps(body).encode("utf-8")
        try:
            self.connection.request("POST", self.path, sent, {"Content-Type": "application/json"})
            reply = self.connection.getresponse()
            content = reply.read()
        except Exception:
            self.connection.close()  # the next request opens a new one
            raise
        if reply.status >= 400:
            raise OSError(f"{reply.status} {reply.reason}")
        message = json.loads(content).get("message") or {}
        return (message.get("content") or "").strip()
