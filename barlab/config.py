"""Caller-supplied parameters. No threshold has a default in code."""
from __future__ import annotations

import json
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class IndicatorParams:
    ema_short: int
    ema_medium: int
    ema_long: int
    rsi_period: int
    roc_lookback: int
    relative_return_lookback: int
    rvol_window: int
    high_window: int
    atr_period: int
    minimum_history_bars: int
    volume_usable_bars: int
    volume_usable_window: int
    break_low_ratio: float
    break_high_ratio: float

    @classmethod
    def from_json(cls, text: str) -> "IndicatorParams":
        raw = json.loads(text)
        return cls(**{f.name: raw[f.name] for f in fields(cls)})


def positive(name: str, value: int) -> int:
    if value <= 0:
        raise ValueError(f"{name} must be a positive integer")
    return value
