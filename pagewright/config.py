"""Engine configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    """Knobs of the document pipeline; sizes are in tokens, pages and MiB as named."""

    max_tokens: int = 1024
    target_tokens: int = 512
    max_pages_per_batch: int = 50
    batch_overlap_pages: int = 1
    max_request_mb: float = 25.0
    full_document_pages: int = 100
    #: most calls at a time; None leaves it to the cluster
    outline_concurrency: int | None = None
    chunk_concurrency: int | None = None
    max_output_tokens: int = 16000
    max_repair_attempts: int = 1
    max_transient_retries: int = 2
    outline_model: str = "offline-rules"
    chunk_model: str = "offline-rules"
    tokenizer_path: str | None = None
    embed_batch: int = 64
    embed_retries: int = 4
    embed_dim: int = 1024

    @property
    def max_request_bytes(self) -> int:
        return int(self.max_request_mb * 1024 * 1024)

    @property
    def pack_target(self) -> int:
        return min(self.target_tokens, self.max_tokens)
