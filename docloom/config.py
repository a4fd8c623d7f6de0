"""Parameters of the dataset pipeline, as one immutable value passed to the column builders."""

from __future__ import annotations

import json
import logging
import os
from dataclasses import dataclass, replace

# Defaults that results depend on.
QUESTION_TYPES = ("fact_extraction", "numeric_calculation", "comparison", "multi_step_reasoning")
MULTI_CHUNK_TYPES = ("comparison", "multi_step_reasoning")


@dataclass(frozen=True)
class Config:
    heading_words_below: int = 12
    min_tokens: int = 30
    max_tokens: int = 600
    target_tokens: int = 500
    tokens_per_word: float = 1.3
    dedup_above: float = 0.90
    embed_batch: int = 32
    question_types: tuple[str, ...] = QUESTION_TYPES
    multi_chunk_types: tuple[str, ...] = MULTI_CHUNK_TYPES
    pair_probability: float = 0.4
    questions_per_call: int = 2
    max_passage_chars: int = 3000
    max_groups_per_type: int = 40
    verbatim_from: float = 0.90
    generation_temperature: float = 0.2
    generation_max_tokens: int = 1500
    verify_retries: int = 3
    verify_backoff_s: float = 3.0
    verify_temperature: float = 0.0
    verify_max_tokens: int = 400
    numeric_tolerance_pct: float = 1.0
    recall_from: float = 0.60
    http_timeout_s: float = 30.0
    http_retries: int = 3
    http_backoff_s: float = 2.0
    chat_url: str = ""
    chat_model: str = ""
    verify_model: str = ""
    embed_url: str = ""
    embed_model: str = ""
    embed_dimension: int = 384
    key_variable: str = "DOCLOOM_API_KEY"
    prompts_folder: str = ""
    log_level: str = "INFO"
    output_format: str = "csv"
    min_rows: int = 100
    seed: int = 42

    def with_(self, **changes) -> Config:
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, values: dict) -> Config:
        """From a flat mapping; unknown names raise, so misspelt settings don't pass silently."""
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a JSON file: one flat object, or objects by section, whose names don't matter."""
        with open(path, encoding="utf-8") as file:
            values = json.load(file)
        flat: dict = {}
        for name, value in values.items():
            flat |= value if isinstance(value, dict) else {name: value}
        return cls.from_mapping(flat)


DEFAULT = Config()


def require_env(name: str) -> str:
    """Value of an environment variable; raises if it is missing or empty."""
    value = os.environ.get(name, "")
    if not value:
        raise OSError(f"the environment variable {name} must be set")
    return value


def set_up_logging(config: Config = DEFAULT) -> None:
    """One handler for all messages of the engine, at the level of the settings."""
    logging.basicConfig(format="%(asctime)s %(name)s %(levelname)s %(message)s", level=config.log_level)


def logger(name: str) -> logging.Logger:
    out = logging.getLogger(name)
    if not logging.getLogger().handlers and not out.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(name)s %(levelname)s %(message)s"))
        out.addHandler(handler)
        out.setLevel(logging.INFO)
    return out
