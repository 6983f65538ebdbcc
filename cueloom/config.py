"""Pipeline configuration: frozen dataclasses with defaults, checked when loaded."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any

from .functions.script_regex import Pattern, PatternError, replacement


class ConfigError(ValueError):
    """A configuration value has the wrong kind or is out of range."""


@dataclass(frozen=True)
class Rule:
    type: str
    search: str
    replacement: str

    def __post_init__(self):
        if self.type not in ("regex", "literal"):
            raise ConfigError(f"rule type {self.type!r} is neither regex nor literal")
        if not self.search:
            raise ConfigError("a rule's search text must not be empty")
        if self.type == "regex":
            try:
                replacement(self.replacement, Pattern(self.search))
            except PatternError as e:
                raise ConfigError(str(e)) from e


@dataclass(frozen=True)
class Transcription:
    model: str = "large-v2"
    language: str = "en"
    min_speakers: int = 1
    max_speakers: int | None = None
    job_timeout_minutes: float = 60
    skip_if_output_exists: bool = False

    def __post_init__(self):
        if self.job_timeout_minutes > 720:
            raise ConfigError("job_timeout_minutes is 720 at most")


@dataclass(frozen=True)
class Validation:
    enabled: bool = True
    max_word_change_ratio: float = 0.4
    max_normalized_edit_distance: float = 0.5
    max_consecutive_changes: int = 3
    min_words_for_ratio_check: int = 5


@dataclass(frozen=True)
class Refinement:
    profile_id: str = ""
    additional_context: str | None = None
    model_config: dict[str, Any] = field(default_factory=lambda: {"max_tokens": 64000, "temperature": 0.2})
    suggestion_validation: Validation = Validation()


@dataclass(frozen=True)
class Normalization:
    normalize: bool = True
    max_chars_per_segment: int = 48
    max_words_per_segment: int = 10
    split_segment_at_speaker_change: bool = True
    punctuation_split_threshold: float = 0.7
    punctuation_chars: tuple[str, ...] = (".", ",", "?", "!", ";", ":")


@dataclass(frozen=True)
class Captions:
    generate_vtt: bool = True
    generate_srt: bool = True
    generate_simplified_json: bool = True
    highlight_words: bool = False
    highlight_with: str = "underline"
    include_speaker_names: str = "when-changes"

    def __post_init__(self):
        if self.highlight_with not in ("underline", "bold", "italic"):
            raise ConfigError(f"highlight_with: {self.highlight_with!r}")
        if self.include_speaker_names not in ("never", "always", "when-changes"):
            raise ConfigError(f"include_speaker_names: {self.include_speaker_names!r}")


@dataclass(frozen=True)
class Notification:
    enabled: bool = True
    event_bus: str = "default"
    source: str = "cueloom.pipeline"
    detail_type: str = "Pipeline Completed"


@dataclass(frozen=True)
class PipelineConfig:
    transcription: Transcription = Transcription()
    replacement_rules: tuple[Rule, ...] | None = None
    refinement: Refinement | None = None
    normalization: Normalization = Normalization()
    captions: Captions = Captions()
    notification: Notification = Notification()


_NESTED = {"transcription": Transcription, "refinement": Refinement, "normalization": Normalization, "captions": Captions, "notification": Notification, "suggestion_validation": Validation}
_KINDS = {"int": (int, float), "float": (int, float), "bool": (bool,), "str": (str,)}


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def _build(kind: type, given: dict[str, Any]) -> Any:
    known = {f.name: f for f in dataclasses.fields(kind)}
    values = {}
    for key, value in given.items():
        name = _snake(key)
        if name not in known:
            continue  # unknown keys are left out
        if name in _NESTED and isinstance(value, dict):
            value = _build(_NESTED[name], value)
        elif name == "model_config":
            if not isinstance(value, dict):
                raise ConfigError("model_config must be a mapping")
            value = {"max_tokens": 64000, "temperature": 0.2} | value
        elif name == "replacement_rules" and value is not None:
            value = tuple(Rule(**{k: v for k, v in r.items() if k in ("type", "search", "replacement")}) for r in value)
        elif name == "punctuation_chars":
            value = tuple(value)
        else:
            declared = str(known[name].type).split(" ")[0]
            allowed = _KINDS.get(declared)
            optional = "None" in str(known[name].type)
            if allowed and not (optional and value is None) and (not isinstance(value, allowed) or (bool not in allowed and isinstance(value, bool))):
                raise ConfigError(f"{key}: {value!r} is not {declared}")
        values[name] = value
    try:
        return kind(**values)
    except TypeError as e:
        raise ConfigError(str(e)) from e


def load_config(given: dict[str, Any] | None = None) -> PipelineConfig:
    """A checked configuration from a mapping with camelCase or snake_case keys; what is missing has its default."""
    given = dict(given or {})
    if "llmRefinement" in given:
        given["refinement"] = given.pop("llmRefinement")
    refinement = given.get("refinement")
    if isinstance(refinement, dict):
        refinement = dict(refinement)
        for name in [k for k in refinement if _snake(k).endswith("profile_id")]:
            refinement["profile_id"] = refinement.pop(name)
        if "profile_id" not in refinement:
            raise ConfigError("refinement needs a profile id")
        given["refinement"] = refinement
    return _build(PipelineConfig, given)


def overlay(base: Any, **changes: Any) -> Any:
    """base with the given fields changed."""
    return dataclasses.replace(base, **changes)
