"""Job options. All are plain arguments; nothing reads the environment."""

from __future__ import annotations

from dataclasses import dataclass, field

from corpusflow import fixed


STRATEGIES = ("token", "heading", "recursive")


@dataclass(frozen=True)
class ChunkOptions:
    max_tokens: int = fixed.DEFAULT_MAX_TOKENS
    overlap: int = 0
    strategy: str = "token"
    tokenizer: str = fixed.DEFAULT_TOKENIZER

    def __post_init__(self) -> None:
        if self.max_tokens <= 0:
            raise ValueError("ErrInvalidMaxTokens: max_tokens must be positive")
        if not 0 <= self.overlap < self.max_tokens:
            raise ValueError("ErrInvalidOverlap: overlap must be between 0 and max_tokens")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"ErrNoChunkerRegistered: {self.strategy}")


@dataclass(frozen=True)
class FileOptions:
    exclusions: list[str] = field(default_factory=lambda: list(fixed.EXCLUDED_SUBSTRINGS))
    extensions: list[str] = field(default_factory=lambda: list(fixed.IMPORTABLE_EXTENSIONS))
    #: Bytes; larger files become rejects. None takes every file.
    max_size: int | None = None
    match: str = "substring"


@dataclass(frozen=True)
class ListingOptions:
    per_page: int = fixed.POSTS_PER_PAGE
    #: None goes on to the end of the listing; a bound that cuts one off is a reject.
    max_pages: int | None = None
    concurrency: int = fixed.DEFAULT_CONCURRENCY
    #: Further tries of a request that fails or is refused for now, and seconds before the first; each pause is twice the one before.
    retries: int = 5
    pause: float = 1.0


@dataclass(frozen=True)
class IngestOptions:
    """Options of a whole run; the defaults are those of the command line."""

    chunks: ChunkOptions = field(default_factory=lambda: ChunkOptions(max_tokens=fixed.MODEL_MAX_TOKENS))
    parity: bool = False
    quote_strings: bool = False
    #: Refuse post responses that are not declared as JSON.
    json_type_only: bool = False
    #: Deal rows anew before chunking and embedding; None leaves them as they come.
    partitions: int | None = None
