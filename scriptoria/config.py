"""Settings of runs and services, checked when they are made."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field


def need(holds: bool, message: str) -> None:
    if not holds:
        raise ValueError(message)


def positive(**values: float) -> None:
    for name, value in values.items():
        need(isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and value > 0, f"{name} must be positive")


@dataclass(frozen=True)
class RecognitionRun:
    epochs: int = 50
    batch_size: int = 32
    learning_rate: float = 3e-4
    validation_ratio: float = 0.02
    max_text_length: int = 80
    workers: int = 6

    def __post_init__(self) -> None:
        positive(epochs=self.epochs, batch_size=self.batch_size, learning_rate=self.learning_rate, max_text_length=self.max_text_length)
        need(0 < self.validation_ratio < 1, "validation_ratio must be between 0 and 1")
        need(self.workers >= 0, "workers must not be negative")


@dataclass(frozen=True)
class DetectionRun:
    epochs: int = 100
    batch_size: int = 4
    learning_rate: float = 1e-4
    validation_ratio: float = 0.1
    min_polygon_area: float = 1.0
    crop: int = 640

    def __post_init__(self) -> None:
        positive(epochs=self.epochs, batch_size=self.batch_size, learning_rate=self.learning_rate, min_polygon_area=self.min_polygon_area, crop=self.crop)
        need(0 < self.validation_ratio < 1, "validation_ratio must be between 0 and 1")
        need(self.crop % 32 == 0, "crop must be a multiple of 32")


@dataclass(frozen=True)
class MultitaskRun:
    max_seq_len: int = 2048
    min_pixels: int = 50_176
    max_pixels: int = 451_584
    epochs: float = 3.0
    accumulation: int = 32
    rank: int = 32
    task_token_limits: dict[str, int] = field(default_factory=dict)
    min_similarity: float = 0.5
    max_cer: float = 1.0

    def __post_init__(self) -> None:
        positive(max_seq_len=self.max_seq_len, min_pixels=self.min_pixels, max_pixels=self.max_pixels, epochs=self.epochs, accumulation=self.accumulation, rank=self.rank)
        need(self.min_pixels <= self.max_pixels, "min_pixels must not exceed max_pixels")
        need(0 <= self.min_similarity <= 1 and self.max_cer >= 0, "gate bounds are out of range")


@dataclass(frozen=True)
class Service:
    host: str = "127.0.0.1"
    port: int = 8000
    device: str = "cpu"
    threshold: float = 0.5

    def __post_init__(self) -> None:
        need(bool(self.host.strip()), "host must not be empty")
        need(1 <= self.port <= 65535, "port must be from 1 to 65535")
        need(bool(re.fullmatch(r"cpu|gpu(:\d+)?", self.device)), "device must be cpu, gpu or gpu:N")
        need(0 <= self.threshold <= 1, "threshold must be from 0 to 1")
