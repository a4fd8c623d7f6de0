"""Connectors to models: text generation, verification and embeddings, with deterministic offline stand-ins.

A provider is a small picklable object that is sent to the workers; calls of one partition come one after another.
The offline stand-ins exist for tests and dry runs: their scores say nothing about meaning.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections.abc import Callable
from functools import lru_cache
from typing import Protocol

from ..config import Config, logger, require_env


class Completion(Protocol):
    def complete(self, system: str, user: str) -> str: ...


class Embedder(Protocol):
    dimension: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class ChatEndpoint:
    """An endpoint that speaks the common chat-completions protocol over HTTP."""

    def __init__(self, base_url: str, model: str, key_variable: str, temperature: float = 0.2, max_tokens: int = 1500, timeout_s: float = 60.0):
        self.base_url, self.model, self.key_variable, self.temperature, self.max_tokens, self.timeout_s = base_url.rstrip("/"), model, key_variable, temperature, max_tokens, timeout_s

    def complete(self, system: str, user: str) -> str:
        from urllib.request import Request, urlopen

        body = {"model": self.model, "temperature": self.temperature, "max_tokens": self.max_tokens, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        request = Request(f"{self.base_url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {require_env(self.key_variable)}"})
        with urlopen(request, timeout=self.timeout_s) as reply:
            return json.load(reply)["choices"][0]["message"]["content"] or ""


class EmbeddingEndpoint:
    """Embeddings from an endpoint that speaks the common protocol over HTTP; vectors are scaled to unit length."""

    def __init__(self, base_url: str, model: str, key_variable: str, dimension: int = 384, timeout_s: float = 60.0, retries: int = 3, backoff_s: float = 2.0):
        self.base_url, self.model, self.key_variable, self.dimension, self.timeout_s = base_url.rstrip("/"), model, key_variable, dimension, timeout_s
        self.retries, self.backoff_s = retries, backoff_s

    def embed(self, texts: list[str]) -> list[list[float]]:
        """Vectors of the texts; a failed call is tried again with a growing wait, the last failure is raised."""
        for attempt in range(1, self.retries + 1):
            try:
                return self._embed(texts) if texts else []
            except OSError as error:
                if attempt == self.retries:
                    raise
                logger(__name__).warning("embedding failed (%d of %d): %s", attempt, self.retries, error)
                time.sleep(self.backoff_s * attempt)
        return []

    def _embed(self, texts: list[str]) -> list[list[float]]:
        from urllib.request import Request, urlopen

        request = Request(f"{self.base_url}/embeddings", json.dumps({"model": self.model, "input": texts}).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {require_env(self.key_variable)}"})
        with urlopen(request, timeout=self.timeout_s) as reply:
            found = [x["embedding"] for x in sorted(json.load(reply)["data"], key=lambda x: x["index"])]
        return [[x / norm for x in v] if (norm := math.sqrt(sum(x * x for x in v))) else v for v in found]


def complete_with_retry(provider: Completion, system: str, user: str, retries: int = 3, backoff_s: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The reply, or None after ``retries`` failures; the wait grows with each attempt."""
    for attempt in range(1, retries + 1):
        try:
            return provider.complete(system, user)
        except Exception as error:  # any failure of a remote model is worth another attempt
            logger(__name__).warning("call failed (%d of %d): %s", attempt, retries, error)
            sleep(backoff_s * attempt)
    return None


class OfflineGenerator:
    """Makes question-answer candidates out of the passage itself: its sentences with figures, quoted verbatim."""

    def complete(self, system: str, user: str) -> str:
        kind = re.search(r"question_type: (\w+)", user)
        n = int((re.search(r"count: (\d+)", user) or [0, 2])[1])
        passage = user.split("passage:\n", 1)[-1]
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+|\n", passage) if re.search(r"\d", s)]
        out = []
        for s in sentences[:n]:
            figure = re.search(r"\$?\d[\d,]*\.?\d*%?", s)
            out.append({"question": f"Which figure does the passage give in: {s[:60]}?", "answer": figure.group() if figure else s, "source_passage": s, "question_type": kind[1] if kind else ""})
        return json.dumps(out)


class OfflineVerifier:
    """Agrees if every figure of the answer, or else half of its words, stand in the passage."""

    def complete(self, system: str, user: str) -> str:
        passage = re.search(r"passage:\n(.*?)\nquestion:", user, re.DOTALL)
        answer = user.split("answer:\n", 1)[-1]
        text = (passage[1] if passage else "").lower()
        figures = re.findall(r"\d[\d,.]*", answer)
        words = re.findall(r"\w+", answer.lower())
        good = all(f in text for f in figures) if figures else sum(w in text for w in words) * 2 >= max(1, len(words))
        return json.dumps({"matches_claimed_answer": good, "confidence": "high" if figures else "medium", "reason": "figures and words compared"})


@lru_cache(maxsize=100_000)
def _word_digest(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


class HashingEmbedder:
    """Unit vectors of hashed words."""

    def __init__(self, dimension: int = 384):
        self.dimension = dimension

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            vector = [0.0] * self.dimension
            for word in re.findall(r"\w+", (text or "").lower()):
                digest = _word_digest(word)
                vector[digest % self.dimension] += 1.0 if digest >> 63 else -1.0
            norm = math.sqrt(sum(x * x for x in vector))
            out.append([x / norm for x in vector] if norm else vector)
        return out


# The prompts ask for JSON; braces that stay in the text are doubled.
PROMPTS = {
    name: f"""SYSTEM:
You write questions about passages of annual reports. Reply with JSON only: a list of objects with the keys question, answer, source_passage (quoted verbatim) and question_type.

USER:
question_type: {name}
count: {{n}}
task: {task}
section: {{heading_path}}
passage:
{{chunk_text}}"""
    for name, task in {
        "fact_extraction": "ask for a fact that the passage states in one place",
        "numeric_calculation": "ask for a value that follows from two figures of the passage by one step of arithmetic; answer with the value alone",
        "comparison": "ask for a comparison of two things, periods or figures of the passage",
        "multi_step_reasoning": "ask something that takes two statements of the passage together",
    }.items()
}
FAITHFULNESS_PROMPT = """SYSTEM:
You check answers against passages. Reply with JSON only: {{"matches_claimed_answer": true or false, "confidence": "high", "medium" or "low", "reason": "one sentence"}}.

USER:
passage:
{source_passage}
question:
{question}
answer:
{answer}"""


def load_prompts(folder: str) -> tuple[dict[str, str], str]:
    """Templates by question type, and the verifier's: ``TYPE.txt`` and ``faithfulness.txt`` of the folder, else the built-in ones.

    A template without the marker of its user part raises here rather than in a task.
    """
    from pathlib import Path

    def read(name: str, default: str) -> str:
        path = Path(folder) / f"{name}.txt" if folder else None
        text = path.read_text(encoding="utf-8") if path and path.exists() else default
        split_prompt(text)
        return text

    return {kind: read(kind, text) for kind, text in PROMPTS.items()}, read("faithfulness", FAITHFULNESS_PROMPT)


def providers_of(config: Config) -> tuple[Completion, Completion, Embedder]:
    """Generator, verifier and embedder of the settings: endpoints where an address is set, else the offline stand-ins.

    A missing key is found out here, before any stage runs.
    """
    generator: Completion = OfflineGenerator()
    verifier: Completion = OfflineVerifier()
    embedder: Embedder = HashingEmbedder(config.embed_dimension)
    if config.chat_url or config.embed_url:
        require_env(config.key_variable)
    if config.chat_url:
        generator = ChatEndpoint(config.chat_url, config.chat_model, config.key_variable, config.generation_temperature, config.generation_max_tokens, config.http_timeout_s)
        verifier = ChatEndpoint(config.chat_url, config.verify_model or config.chat_model, config.key_variable, config.verify_temperature, config.verify_max_tokens, config.http_timeout_s)
    if config.embed_url:
        embedder = EmbeddingEndpoint(config.embed_url, config.embed_model, config.key_variable, config.embed_dimension, config.http_timeout_s, config.http_retries, config.http_backoff_s)
    return generator, verifier, embedder


def split_prompt(template: str) -> tuple[str, str]:
    """System and user part; raises ValueError if the marker of the user part is missing."""
    if "USER:" not in template:
        raise ValueError("the prompt has no USER: part")
    system, user = template.split("USER:", 1)
    return system.replace("SYSTEM:", "", 1).replace("{{", "{").replace("}}", "}").strip(), user.strip()

