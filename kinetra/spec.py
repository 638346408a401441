"""What differs from one kind of recording to the next, as plain parameters."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Literal

# Standard gravity in m/s2, ticks a second of the ring's clock, and the devices and modes of manifests.
G = 9.80665
TICKS_PER_SECOND = 16384.0
DEVICES = ("phone", "watch", "ring", "other")
MODES = ("10s", "1000f")


@dataclass(frozen=True)
class ModeSpec:
    """A way to cut segments: name, frames, and for padded ones the fewest real frames."""

    name: str
    frames: int
    min_real: int | None = None


def ten_seconds(freq: float) -> ModeSpec:
    """The mode of ten seconds, as many frames as that takes."""
    return ModeSpec("10s", math.ceil(freq * 10))


@dataclass(frozen=True)
class SourceSpec:
    """Parameters of one source and device.

    hz_formula: "n" divides the sample count by the duration, "n-1" the number of intervals.
    grid_end: "open" leaves the end point out, "closed" keeps it, "tolerance" may overshoot it by 1e-6 ms and
    then rejects the session.  bin_origin: "floor" starts quality bins at a whole bin width, "zero" at 0.
    hold: keep the first and last value beyond the ends instead of having no frame there.
    startup_sec: each signal loses so much from its start, and must keep startup_rows, by default min_frames.
    label: the label of every segment, where it is neither told by a finger nor by padding.
    """

    src: str
    device: str
    freq: float
    min_bin: dict[str, float]
    min_hz: float | None
    hz_formula: Literal["n", "n-1"] = "n"
    grid_end: Literal["open", "closed", "tolerance"] = "open"
    bin_origin: Literal["floor", "zero"] = "floor"
    bin_ms: float = 1000.0
    min_frames: int = 1000
    modes: tuple[ModeSpec, ...] = ()
    hold: bool = False
    trim: bool = False
    strict_period_ms: float | None = None
    startup_sec: float = 0.0
    startup_rows: int | None = None
    label: dict[str, str] = field(default_factory=dict)
    label_map: dict[str, str] = field(default_factory=dict)
    excluded: tuple[str, ...] = ()

    @property
    def period_ms(self) -> float:
        return 1000.0 / self.freq

    @property
    def signals(self) -> tuple[str, ...]:
        return tuple(self.min_bin)


# The raw finger names of ring sessions and the labels they become.
FINGERS = {
    "右手拇指": "right_thumb",
    "右手食指": "right_index",
    "右手中指": "right_middle",
    "右手无名指": "right_ring",
    "右手小指": "right_little",
}

# Rates, gates and modes of the sources below.
_200 = (ten_seconds(200), ModeSpec("1000f", 1000))
_150 = (ten_seconds(150), ModeSpec("1024f", 1024))
_40 = (ten_seconds(40), ModeSpec("512f", 512), ModeSpec("1024f", 1024, 512))
_100 = (ten_seconds(100), ModeSpec("1000f", 1000))


def ring_200(src: str, **changes) -> SourceSpec:
    """Ring with both signals in one row, 200 Hz grid."""
    return SourceSpec(src, "ring", 200.0, **{"min_bin": {"acc": 150, "gyro": 150}, "min_hz": 150.0, "modes": _200, "label_map": FINGERS} | changes)


def phone_200(src: str, **changes) -> SourceSpec:
    """Phone with a file for each signal, 200 Hz grid over what both cover."""
    return SourceSpec(src, "phone", 200.0, **{"min_bin": {"acc": 150, "gyro": 150}, "min_hz": 150.0, "modes": _200, "label_map": FINGERS} | changes)


def daily_ring_200(src: str, **changes) -> SourceSpec:
    """Ring worn all day on one finger: no session metadata, every segment has the same label."""
    return ring_200(src, **{"label_map": {}, "label": {"finger": "right_index"}} | changes)


def daily_phone_200(src: str, **changes) -> SourceSpec:
    """Phone carried beside such a ring."""
    return phone_200(src, **{"label_map": {}, "label": {"finger": "right_index"}} | changes)


def watch_200(src: str, **changes) -> SourceSpec:
    """Watch with a file for each signal, 200 Hz grid whose end may be hit exactly; a start-up drop if asked for."""
    return SourceSpec(src, "watch", 200.0, **{"min_bin": {"acc": 150, "gyro": 150}, "min_hz": 150.0, "modes": _200, "grid_end": "tolerance"} | changes)


def wearable_150(src: str, device: str, **changes) -> SourceSpec:
    """Ring or watch with device time rebased to 0, 150 Hz grid with its end point."""
    return SourceSpec(src, device, 150.0, **{"min_bin": {"acc": 120, "gyro": 120}, "min_hz": 120.0, "hz_formula": "n-1", "grid_end": "closed", "bin_origin": "zero", "min_frames": 1024, "modes": _150} | changes)


def phone_40(src: str, **changes) -> SourceSpec:
    """Phone recordings of about 20 s, trimmed to the overlap of both signals; tails may be padded."""
    return SourceSpec(src, "phone", 40.0, **{"min_bin": {"acc": 30, "gyro": 35}, "min_hz": None, "grid_end": "closed", "bin_origin": "zero", "min_frames": 400, "modes": _40, "hold": True, "trim": True} | changes)


def watch_100(src: str, **changes) -> SourceSpec:
    """Labelled watch rows every 10 ms, used as they are."""
    return SourceSpec(src, "watch", 100.0, **{"min_bin": {"acc": 0}, "min_hz": None, "modes": _100, "strict_period_ms": 10.0} | changes)
