from tidemark.plans.medallion import (
    BatchResult,
    build_gold,
    build_silver,
    gold_frames,
    register_views,
    run_batch,
)

__all__ = [
    "BatchResult",
    "build_gold",
    "build_silver",
    "gold_frames",
    "register_views",
    "run_batch",
]
