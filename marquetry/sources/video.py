"""Episode videos behind one small protocol: opened once, read by frame number.

The raw container is included: `frames height width [fps]` in its first line, then bytes of three channels.
Other codecs are injected as an opener that gives a Container.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np

from marquetry.functions import images as G

FPS_TOLERANCE = 0.01


class Container(Protocol):
    frame_count: int
    fps: float | None

    def read(self, index: int) -> np.ndarray: ...

    def close(self) -> None: ...


class RawVideo:
    """A raw blob; only the frames asked for are read."""

    def __init__(self, path: str):
        self._file = open(path, "rb")
        try:
            head = self._file.readline().split()
            self.frame_count, self._height, self._width = map(int, head[:3])
            self.fps = float(head[3]) if len(head) > 3 else None
        except ValueError as error:
            self._file.close()
            raise ValueError(f"{path} is no raw video: {error}") from error
        self._start = self._file.tell()

    def read(self, index: int) -> np.ndarray:
        size = self._height * self._width * 3
        self._file.seek(self._start + index * size)
        data = self._file.read(size)
        if len(data) != size:
            raise RuntimeError(f"frame {index} cannot be read")
        return np.frombuffer(data, np.uint8).reshape(self._height, self._width, 3)

    def close(self) -> None:
        self._file.close()


class ArrayVideo:
    """A decoder's frames, all in memory."""

    def __init__(self, frames: np.ndarray, fps: float | None = None):
        self._frames, self.frame_count, self.fps = frames, len(frames), fps

    def read(self, index: int) -> np.ndarray:
        return self._frames[index]

    def close(self) -> None:
        self._frames = None


Opener = Callable[[str], Container]


@dataclass
class Bundle:
    """Frame 0 in full, and the sampled frames as (index, seconds, jpeg)."""

    first: np.ndarray
    frames: list[tuple[int, float, bytes]]


def _frame(container: Container, index: int) -> np.ndarray:
    frame = container.read(index)
    if frame is None or not frame.size or frame.ndim != 3 or frame.shape[2] != 3 or frame.dtype != np.uint8:
        raise RuntimeError(f"frame {index} cannot be decoded")
    return frame


def _first(container: Container, job: dict[str, Any]) -> np.ndarray:
    frame = _frame(container, 0)
    if frame.shape[:2] != (job["real_frame_height"], job["real_frame_width"]):
        raise ValueError(f"frame 0 has {frame.shape[1]}x{frame.shape[0]} pixels, the metadata say {job['real_frame_width']}x{job['real_frame_height']}")
    return frame


def first_frame(open_: Opener, job: dict[str, Any]) -> np.ndarray:
    """Frame 0 alone, for a scene whose sentence is known already."""
    container = open_(job["real_video"])
    try:
        return _first(container, job).copy()
    finally:
        container.close()


def bundle(open_: Opener, job: dict[str, Any], long_edge: int, quality: int) -> Bundle:
    """All that both branches need, with one opening: job has real_video, episode_length, fps, geometry and frames.

    The container's frame count must be the metadata's, its rate (if it has one) too, up to 0.01.
    """
    container = open_(job["real_video"])
    try:
        if container.frame_count != job["episode_length"]:
            raise ValueError(f"the video has {container.frame_count} frames, the metadata say {job['episode_length']}")
        if container.fps is not None and not abs(container.fps - job["fps"]) <= FPS_TOLERANCE:
            raise ValueError(f"the video has {container.fps} frames a second, the metadata say {job['fps']}")
        first, frames = _first(container, job), []
        for index in job["frames"]:
            frame = first if index == 0 else _frame(container, index)
            frames.append((int(index), index / job["fps"], G.encode_jpeg(np.ascontiguousarray(G.shrink(frame, long_edge)), quality)))
        return Bundle(first.copy(), frames)
    finally:
        container.close()
