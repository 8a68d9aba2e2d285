"""Composite jobs C1-C9. Each `*_plan` / pure function returns the DataFrame
the job writes; `run_*` functions add the snapshot writes."""
