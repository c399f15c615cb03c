"""Settings of an index, checked when made; fingerprints of what a result depends on."""

from __future__ import annotations

import hashlib
import re
from dataclasses import asdict, dataclass
from typing import Any

from .operators.sync import settings_fingerprint

DEVICES = ("cpu", "cuda", "mps")


def vault_id(root: str) -> str:
    """A stable name of a folder: its own name and a hash of its path."""
    path = root.rstrip("/")
    name = re.sub(r"[^A-Za-z0-9_-]+", "-", path.rpartition("/")[2]).strip("-") or "vault"
    return f"{name}-{hashlib.sha256(path.encode()).hexdigest()[:12]}".lower()


def collection_name(name: str) -> str:
    """3 to 63 characters of a store's alphabet."""
    clean = re.sub(r"[^A-Za-z0-9_-]+", "-", name).strip("-")
    return (clean if len(clean) >= 3 else f"vault-{clean or 'default'}")[:63]


@dataclass(frozen=True)
class Settings:
    embedding_model: str = ""
    embedding_revision: str | None = None
    embedding_dimension: int | None = None
    reranker_model: str = ""
    reranker_revision: str | None = None
    immutable_models: bool = False
    device: str = "cpu"
    use_reranker: bool = True
    chunk_size: int = 800
    chunk_overlap: float = 0.15
    top_k: int = 20
    rerank_top_k: int = 12
    rrf_k: int = 60
    dedup_threshold: float = 0.7
    max_same_parent: int = 1
    ignored_chunk_types: tuple[str, ...] = ("navigation", "backlink")

    def __post_init__(self) -> None:
        wrong = [
            (not 0 <= self.chunk_overlap < 1, "chunk_overlap is at least 0 and below 1"),
            (min(self.chunk_size, self.top_k, self.rerank_top_k) < 1, "sizes and limits are positive"),
            (self.device not in DEVICES, f"device is one of {', '.join(DEVICES)}"),
            (self.embedding_dimension is not None and self.embedding_dimension < 1, "embedding_dimension is positive"),
        ]
        if self.immutable_models:
            full = lambda r: bool(re.fullmatch(r"[0-9a-f]{40}", r or ""))
            wrong += [(not full(self.embedding_revision) or not full(self.reranker_revision), "revisions are full hashes of 40 digits"), (self.embedding_dimension is None, "embedding_dimension is given")]
        if found := [text for bad, text in wrong if bad]:
            raise ValueError("; ".join(found))

    def fingerprint(self) -> str:
        return settings_fingerprint(asdict(self))

    def models(self) -> dict[str, Any]:
        reranker = {"identity": self.reranker_model, "revision": self.reranker_revision} if self.use_reranker else None
        return {"embedding": {"identity": self.embedding_model, "revision": self.embedding_revision, "dimension": self.embedding_dimension}, "reranker": reranker}

    def model_fingerprint(self) -> str:
        return settings_fingerprint(self.models())
