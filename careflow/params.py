"""Measure parameters, one frozen object passed to every builder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MeasureParams:
    # Fixed values that define the measures (service-level target, plausibility
    # cap, control-chart width, minimum reportable cell, run length).
    wait_target_minutes: int = 30
    max_plausible_wait_minutes: int = 240
    spc_sigma: float = 3.0
    min_cell_size: int = 30
    run_length: int = 8
    # d2 constant for a moving range of two points, and the normal-theory factors of
    # the median confidence interval (z for 95%, SE(median)/SE(mean) = sqrt(pi/2)).
    mr_d2: float = 1.128
    ci_z: float = 1.96
    median_se_factor: float = 1.2533

    @property
    def run_signal_label(self) -> str:
        return f"run_of_{self.run_length}"


DEFAULT_PARAMS = MeasureParams()
