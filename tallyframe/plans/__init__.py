"""Multi-step jobs: versioned tables, full recompute, publication, run journal, runner, benchmark, workloads."""
