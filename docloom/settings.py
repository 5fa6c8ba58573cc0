"""Settings of a project, its root folder and its prompts. Read on the driver; tasks get the values they need."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass
from functools import lru_cache
from pathlib import Path
from typing import Any, get_type_hints

from .operators.overlap import MAX_RATIO, MAX_RUN, MAX_SENTENCE
from .operators.sections import Sizes

CONFIG = ("config.yaml", "config.json")


@dataclass(frozen=True)
class Paths:
    inbox: str = "inbox"
    library: str = "library"
    quarantine: str = "quarantine"
    reports: str = "reports"
    exports: str = "exports"


@dataclass(frozen=True)
class Ocr:
    enabled: bool = True
    min_chars: int = 50
    min_image_share: float = 0.3
    low_quality: float = 0.6


@dataclass(frozen=True)
class Validation:
    max_shared_word_run: int = MAX_RUN
    max_ngram_overlap: float = MAX_RATIO
    max_sentence_similarity: float = MAX_SENTENCE
    max_regenerate_attempts: int = 1
    allow_interpretation: bool = False
    allow_statute_quotes: bool = True
    max_quote_words: int = 40


@dataclass(frozen=True)
class Models:
    extract: str = ""
    compose: str = ""
    classify_with_model: bool = False
    #: USD for a million tokens in and out, by model.
    prices: dict[str, list[float]] = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    root: str = "."
    paths: Paths = field(default_factory=Paths)
    ocr: Ocr = field(default_factory=Ocr)
    sectioning: Sizes = field(default_factory=Sizes)
    max_heading_levels: int = 3
    tables: bool = True
    validation: Validation = field(default_factory=Validation)
    models: Models = field(default_factory=Models)

    def path(self, name: str) -> str:
        """A folder's full path: below the root unless it is a URL or a full path itself."""
        own = getattr(self.paths, name)
        return own if "://" in own or own.startswith("/") else f"{self.root.rstrip('/')}/{own}"


def _made(kind: type, values: dict[str, Any]) -> Any:
    """A settings class from nested dictionaries; names that it doesn't have are an error."""
    hints = get_type_hints(kind)
    unknown = set(values) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**{k: _made(hints[k], v) if is_dataclass(hints[k]) and isinstance(v, dict) else v for k, v in values.items()})


def project_root(start: str | Path | None = None) -> Path:
    """The nearest folder, from `start` upwards, that holds a configuration."""
    here = Path(start or Path.cwd()).resolve()
    found = next((f for f in (here, *here.parents) if any((f / name).exists() for name in CONFIG)), None)
    if found is None:
        raise FileNotFoundError(f"no {' or '.join(CONFIG)} in {here} or above it")
    return found


def load_settings(path: str | Path | None = None) -> Settings:
    """Settings of a file, or of the project around the working folder. Lines NAME=value of a file .env beside it become environment
    variables that aren't set yet."""
    if path is None:
        root = project_root()
        path = next(root / name for name in CONFIG if (root / name).exists())
    path = Path(path).resolve()
    if path.suffix == ".json":
        values = json.loads(path.read_text(encoding="utf-8") or "{}")
    else:
        import yaml

        values = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    secrets = path.parent / ".env"
    if secrets.exists():
        for line in secrets.read_text(encoding="utf-8").splitlines():
            name, found, value = line.partition("=")
            if found and not name.lstrip().startswith("#"):
                os.environ.setdefault(name.strip(), value.strip().strip("\"'"))
    return _made(Settings, {"root": str(path.parent), **values})


#: Short stand-ins for prompts that a project doesn't bring along.
PROMPTS = {
    "extract": "List what the section holds: cases, concepts, rules, examples and comparisons, each with notes in your own few words, the pages they stand on, and identifiers exactly as written.",
    "compose": "Write short statements from the notes alone. Use other sentences than any source would; keep names, numbers and terms of law as they are, and name the notes each statement rests on.",
    "case": "For a case: facts, issues, decision, principles and factors.",
    "concept": "For a concept: its definition, key points and factors.",
    "rule": "For a rule: requirements, conditions and exceptions.",
    "example": "For an example: its scenario, facts and result, and the concepts it shows.",
    "comparison": "For a comparison: the things compared, by attribute, and the main differences.",
    "classify": "Say which content types the text has, or why it isn't worth reading on.",
}


@lru_cache(maxsize=256)
def load_prompt(name: str, root: str | None = None) -> str:
    """prompts/<name>.md of the project, else the stand-in."""
    own = Path(root or ".") / "prompts" / f"{name}.md"
    if own.exists():
        return own.read_text(encoding="utf-8")
    if name not in PROMPTS:
        raise FileNotFoundError(f"no prompt {name}")
    return PROMPTS[name]


def system_prompt(root: str | None = None) -> str:
    """The second request's prompt: the base and one for each record type, parted by empty lines."""
    return "\n\n".join(load_prompt(n, root).strip() for n in ("compose", "case", "concept", "rule", "example", "comparison"))
