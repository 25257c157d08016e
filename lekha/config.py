"""Thresholds and fixed lists of the curation stages."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Script:
    """The target script as an inclusive range of code points."""

    low: int = 0x0C00
    high: int = 0x0C7F

    @property
    def char_class(self) -> str:
        return f"\\x{{{self.low:04X}}}-\\x{{{self.high:04X}}}"


TELUGU = Script()

# Licences, hints and required fields of raw records, and the licence tiers.
APPROVED_LICENCES = ("CC0", "CC-BY-4.0", "CC-BY-SA-4.0", "Apache-2.0", "MIT", "internal", "CC-BY-NC-4.0")
SCRIPT_HINTS = ("roman", "telugu", "mixed")
REQUIRED_FIELDS = ("source_name", "source_doc_id", "source_url", "license_tag", "pull_timestamp_utc", "text_raw", "script_hint", "lang_hint", "row_hash")
MANIFEST_REQUIRED = ("run_id", "source_name", "pull_timestamp_utc", "record_count", "output_file", "license_tag")
MANIFEST_OPTIONAL = ("takedown_contact",)
LICENCE_TIERS = (  # tag, tier, allows_training, allows_redistribution, requires_attribution
    ("CC0", "A", True, True, False),
    ("CC-BY-4.0", "A", True, True, True),
    ("CC-BY-SA-4.0", "A", True, True, True),
    ("Apache-2.0", "A", True, True, False),
    ("MIT", "A", True, True, False),
    ("internal", "A", True, False, False),
    ("CC-BY-NC-4.0", "B", False, False, True),
    ("no-ai-training", "C", False, False, False),
    ("unknown", "C", False, False, False),
)


@dataclass(frozen=True)
class Junk:
    min_chars: int = 2
    max_chars: int = 512
    max_digit_share: float = 0.6
    max_repeat_share: float = 0.6
    repeat_from_chars: int = 4


@dataclass(frozen=True)
class PairRatio:
    low: float = 0.3
    high: float = 4.0


@dataclass(frozen=True)
class NearDup:
    permutations: int = 128
    shingle: int = 3
    threshold: float = 0.85
    bands: int = 8
    max_rows: int | None = None  # a limit above which near duplicates are kept (the reference: 200_000); None never skips


@dataclass(frozen=True)
class SplitCuts:
    """Upper bounds of the 16-bit key prefix for train and val; the rest is test."""

    train: int = 58981
    val: int = 62258


@dataclass(frozen=True)
class EvalSlice:
    name: str
    sources: tuple[str, ...] = ()
    pair_sources: tuple[str, ...] = ()
    min_roman: int = 0
    english_share: float | None = None
    english_words: tuple[str, ...] = ()


# Evaluation slices and acceptance targets.
SLICES = (
    EvalSlice("formal", ("dakshina",), ("direct",)),
    EvalSlice("colloquial", ("dakshina", "aksharantar"), ("augmented",)),
    EvalSlice("long_sentence", ("wikipedia_te",), ("synthetic",), min_roman=30),
)
TARGETS = (("colloquial", 0.10), ("formal", 0.05))


@dataclass(frozen=True)
class Drift:
    script_share_delta: float = 0.05
    mean_length_delta: float = 0.20


@dataclass(frozen=True)
class Thresholds:
    junk: Junk = field(default_factory=Junk)
    ratio: PairRatio = field(default_factory=PairRatio)
    near: NearDup = field(default_factory=NearDup)
    cuts: SplitCuts = field(default_factory=SplitCuts)
    drift: Drift = field(default_factory=Drift)
