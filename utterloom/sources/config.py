"""Settings of a run, checked where they are made."""

from __future__ import annotations

from dataclasses import dataclass

# Languages, methods and modes that a run may name.
LANGUAGES = "en es fr de it pt pl tr ru nl cs ar zh-cn hu ko ja".split()
METHODS = ("maximise-punctuation", "punctuation-only", "mixed")
SAMPLE_MODES = ("basic", "extended", "dynamic")
SCHEDULERS = ("cosine", "multistep", "none")


def proportion(value: str, label: str = "proportion") -> float:
    """7_3 is 0.7: two whole numbers that add up to ten.

    >>> proportion("7_3")
    0.7
    """
    left, sep, right = value.partition("_")
    if not sep or not left.isdigit() or not right.isdigit() or int(left) + int(right) != 10:
        raise ValueError(f"{label} must look like 6_4, with parts that add up to 10: {value}")
    return int(left) / 10


@dataclass(frozen=True)
class DatasetConfig:
    language: str = "en"
    sample_rate: int = 22050
    sample_method: str = "maximise-punctuation"
    method_proportion: float = 0.6
    max_audio_time: float = 11.0
    max_text_length: int = 200
    negative_offset_last_word: int = 50
    min_gap: int | None = None
    fade_in: int = 30
    fade_out: int = 40
    normalize: float | None = None
    training_proportion: float = 0.8

    def __post_init__(self):
        if self.language not in LANGUAGES:
            raise ValueError(f"unknown language: {self.language}")
        if self.sample_method not in METHODS:
            raise ValueError(f"unknown method: {self.sample_method}")
        if not 0 < self.training_proportion < 1:
            raise ValueError("the training proportion lies between 0 and 1")

    @property
    def loudness(self) -> float | None:
        """The target in decibels: the setting with its sign turned; 0 and None switch it off."""
        return -self.normalize if self.normalize else None


@dataclass(frozen=True)
class TrainingConfig:
    epochs: int = 6
    batch: int = 2
    accumulation: int = 1
    rate: float = 5e-6
    scheduler: str = "none"
    sample_mode: str = "basic"
