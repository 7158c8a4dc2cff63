"""Plan-level helpers (sizes, global order, checkpoints) and composed ticket pipelines."""
