"""The engine's options: one frozen object in place of module constants."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Options:
    """What a run may be told. The values are the usual ones; the simple variant spares seeds and drops what lies too deep."""

    max_depth: int = 3
    max_pages: int = 200_000
    concurrent_tasks: int = 30
    page_timeout_ms: int = 180_000
    checkpoint_pages: int = 1000
    recovered_links: int = 10_000
    recovered_links_of_first: int = 100
    site: str = "example.com"
    seed_exempt: bool = False
    depth_overflow: str = "clamp"
    seeds: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.depth_overflow not in ("clamp", "drop"):
            raise ValueError("depth_overflow is clamp or drop")
        for name in ("max_depth", "max_pages", "concurrent_tasks", "page_timeout_ms", "checkpoint_pages", "recovered_links", "recovered_links_of_first"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} can't be negative")

    @classmethod
    def simple(cls, **more) -> Options:
        """The simple variant: seeds only, unless a depth is given."""
        return cls(**({"max_depth": 0, "page_timeout_ms": 60_000, "seed_exempt": True, "depth_overflow": "drop"} | more))
