"""Defaults of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

#: Parts of labels that mark classes of the sound that is sought, and of breathing, and the weights of both.
TARGET_KEYWORDS = ("snor",)
BREATH_KEYWORDS = ("breath", "wheez", "snort")
TARGET_WEIGHT, BREATH_WEIGHT = 2.0, 1.0


@dataclass(frozen=True)
class Config:
    window_s: float = 2.0
    stride_s: float = 0.5
    hop_ms: int = 10
    batch_size: int = 8
    model_rate: int = 16_000
    median_ms: float = 100.0
    uniform_ms: float = 200.0
    threshold: float = 0.30
    merge_gap_s: float = 0.30
    padding_s: float = 0.10
    min_duration_s: float = 0.40
    min_rms: float = 1e-5
    denoise_method: str = "spectral"
    skip_features: bool = False
    compute_hnr: bool = True
