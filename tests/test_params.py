from careflow.params import DEFAULT_PARAMS, MeasureParams


def test_defaults_pinned():
    p = MeasureParams()
    assert (p.wait_target_minutes, p.max_plausible_wait_minutes, p.spc_sigma) == (30, 240, 3.0)
    assert (p.min_cell_size, p.run_length, p.mr_d2) == (30, 8, 1.128)
    assert p.run_signal_label == "run_of_8"
    assert DEFAULT_PARAMS == p
