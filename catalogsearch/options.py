"""One place for every setting."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """Settings of indexing and retrieval.

    The second half bounds the size of single rows and broadcasts. Those settings
    change how work is split, never which rows come out.
    """

    schema: str = "public"
    table_prefix: str = "summary_"
    column_batch_size: int = 50
    fk_mode: str = "source_only"  # or "reference": a line on both ends of a relation
    table_top_k: int = 10
    chunk_limit: int = 100
    score_threshold: float | None = None
    token_budget: int = 128_000
    enable_column_pruning: bool = False
    embed_batch: int = 32
    dim: int = 1536

    mdl_part_size: int = 1_000  # resources per MDL row,
    mdl_part_bytes: int = 64 * 1024 * 1024  # and their size
    value_part_bytes: int = 32 * 1024 * 1024  # size of one list of a column's values
    number_bucket: int = 4_096  # rows of one key that are numbered in one window
    hub_rows: int = 10_000  # rows of one key that are joined in one piece,
    hubs: int = 10_000  # and the most keys that are split beyond that
    broadcast_queries: int = 4_096  # largest question batch shipped to every task,
    broadcast_bytes: int = 128 * 1024 * 1024  # and its largest size
    doc_block: int = 8_192  # documents per block beyond that
    query_block: int = 1_024  # questions per block beyond that

    def __post_init__(self) -> None:
        if self.fk_mode not in ("source_only", "reference"):
            raise ValueError(f"fk_mode must be 'source_only' or 'reference', not {self.fk_mode!r}")
        for field in ("column_batch_size", "table_top_k", "chunk_limit", "embed_batch", "mdl_part_size", "mdl_part_bytes", "value_part_bytes"):
            if getattr(self, field) < 1:
                raise ValueError(f"{field} must be at least 1")
