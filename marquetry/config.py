"""Settings of a run: strict, typed, read from YAML."""

from __future__ import annotations

import dataclasses
import os
import typing
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from marquetry.operators.adapters import clean_queries


def _check(name: str, value: Any, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}")


@dataclass(frozen=True)
class Dataset:
    root: str = "data"
    dataset_glob: str = "*"
    real_view: str = "camera_head"
    min_episode_frames: int = 81
    metadata_manifest: str | None = None
    split_manifest: str | None = None

    def __post_init__(self) -> None:
        _check("dataset.min_episode_frames", self.min_episode_frames, 1, float("inf"))
        if not self.dataset_glob.strip() or not self.real_view.strip():
            raise ValueError("dataset.dataset_glob and dataset.real_view must hold text")


@dataclass(frozen=True)
class Prompt:
    resize_long_edge: int = 512
    jpeg_quality: int = 85
    strict_schema: bool = False
    temperature: float = 0.1
    max_tokens: int = 256
    system_prompt: str = "Describe the task in one sentence."
    provider: str = "injected"
    model: str = "injected"

    def __post_init__(self) -> None:
        _check("prompt.resize_long_edge", self.resize_long_edge, 64, 4096)
        _check("prompt.jpeg_quality", self.jpeg_quality, 30, 100)
        _check("prompt.temperature", self.temperature, 0, 2)
        _check("prompt.max_tokens", self.max_tokens, 64, 4096)


@dataclass(frozen=True)
class Reference:
    batch_size: int = 16
    mask_close_kernel: int = 9
    mask_dilation_pixels: int = 12
    min_mask_area_fraction: float = 0.002
    max_mask_area_fraction: float = 0.75
    max_residual_area_fraction: float = 0.002
    min_inpaint_change_fraction: float = 0.01
    residual_check: bool = True
    device: str = "cpu"
    image_format: str = "raw"  # or jpeg
    jpeg_quality: int = 95
    robot_queries: tuple[str, ...] = ("robot", "robot arm", "robot gripper")

    def __post_init__(self) -> None:
        _check("reference.batch_size", self.batch_size, 1, 512)
        _check("reference.mask_close_kernel", self.mask_close_kernel, 1, 255)
        _check("reference.mask_dilation_pixels", self.mask_dilation_pixels, 0, 512)
        _check("reference.jpeg_quality", self.jpeg_quality, 30, 100)
        _check("reference.max_residual_area_fraction", self.max_residual_area_fraction, 0, 1)
        if self.image_format not in ("raw", "jpeg"):
            raise ValueError("reference.image_format must be raw or jpeg")
        if not self.device.strip():
            raise ValueError("reference.device must hold text")
        object.__setattr__(self, "robot_queries", clean_queries(self.robot_queries))
        if len(self.robot_queries) > 8:
            raise ValueError("reference.robot_queries must be eight at most")
        if self.mask_close_kernel % 2 == 0:
            raise ValueError("reference.mask_close_kernel must be odd")
        if not 0 < self.min_mask_area_fraction < self.max_mask_area_fraction < 1:
            raise ValueError("reference mask area fractions must rise inside 0 and 1")


@dataclass(frozen=True)
class Runtime:
    decode_workers: int = 8
    api_concurrency: int = 4
    api_retry_count: int = 4
    backoff_initial_seconds: float = 1.0
    backoff_max_seconds: float = 30.0
    resume: bool = True
    fail_fast: bool = False
    input_cost_per_million: float | None = None
    output_cost_per_million: float | None = None

    def __post_init__(self) -> None:
        _check("runtime.decode_workers", self.decode_workers, 1, 100_000)
        _check("runtime.api_concurrency", self.api_concurrency, 1, 100_000)
        _check("runtime.api_retry_count", self.api_retry_count, 0, 20)
        if not 0 <= self.backoff_initial_seconds <= self.backoff_max_seconds:
            raise ValueError("runtime.backoff_initial_seconds must not exceed backoff_max_seconds")


@dataclass(frozen=True)
class Output:
    root: str = "output"


@dataclass(frozen=True)
class Config:
    dataset: Dataset = field(default_factory=Dataset)
    prompt: Prompt = field(default_factory=Prompt)
    reference: Reference = field(default_factory=Reference)
    runtime: Runtime = field(default_factory=Runtime)
    output: Output = field(default_factory=Output)


def _built(kind: type, values: Any, at: str) -> Any:
    if not isinstance(values, dict):
        raise ValueError(f"{at or 'the configuration'} must be a mapping")
    hints = typing.get_type_hints(kind)
    if unknown := sorted(set(values) - set(hints)):
        raise ValueError(f"{at or 'the configuration'} has unknown keys: {', '.join(unknown)}")
    out = {}
    for name, value in values.items():
        if dataclasses.is_dataclass(hints[name]):
            value = _built(hints[name], value, f"{at}{name}")
        elif isinstance(value, list):
            value = tuple(value)
        out[name] = value
    return kind(**out)


def load_config(path: str | Path) -> Config:
    """Relative paths are meant from the YAML file; MARQUETRY_DATASET_ROOT and MARQUETRY_OUTPUT_ROOT win over it."""
    import yaml

    path = Path(path)
    config = _built(Config, yaml.safe_load(path.read_text(encoding="utf-8")) or {}, "")
    place = lambda p: p if p is None or "://" in p else str((path.parent / Path(p).expanduser()).resolve())
    dataset = dataclasses.replace(
        config.dataset,
        root=os.environ.get("MARQUETRY_DATASET_ROOT") or place(config.dataset.root),
        metadata_manifest=place(config.dataset.metadata_manifest),
        split_manifest=place(config.dataset.split_manifest),
    )
    output = dataclasses.replace(config.output, root=os.environ.get("MARQUETRY_OUTPUT_ROOT") or place(config.output.root))
    return dataclasses.replace(config, dataset=dataset, output=output)


def overridden(config: Config, **changes: Any) -> Config:
    """The seven settings that a caller may set beside the file: dataset_root, dataset_glob, output_root, reference_device, reference_batch_size, api_concurrency, decode_workers."""
    places = {
        "dataset_root": ("dataset", "root"), "dataset_glob": ("dataset", "dataset_glob"), "output_root": ("output", "root"), "reference_device": ("reference", "device"),
        "reference_batch_size": ("reference", "batch_size"), "api_concurrency": ("runtime", "api_concurrency"), "decode_workers": ("runtime", "decode_workers"),
    }
    if unknown := sorted(set(changes) - set(places)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    for name, value in changes.items():
        if value is not None:
            section, key = places[name]
            value = str(Path(value).expanduser().resolve()) if name.endswith("_root") else value
            config = dataclasses.replace(config, **{section: dataclasses.replace(getattr(config, section), **{key: value})})
    return config
