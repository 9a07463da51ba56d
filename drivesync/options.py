"""User options and their checks.

Unlike the store's own client, a chunk size of 0 or above 4 MiB is refused
here instead of dividing by zero or being sent on.
"""

from dataclasses import dataclass

from drivesync.schemas import DEFAULT_CHUNK_SIZE, MAX_CHUNK_SIZE

# Bounds of the page size.
MIN_PAGE = 1
MAX_PAGE = 2000
# Payload bytes the entries of a log file name; less than twice that, or one larger file.
DEFAULT_BYTES_PER_FILE = 1 << 30


def check_chunk_size(chunk_size: int) -> int:
    if not 1 <= chunk_size <= MAX_CHUNK_SIZE:
        raise ValueError(f"chunk_size must be between 1 and {MAX_CHUNK_SIZE}, got {chunk_size}")
    return chunk_size


def check_page_size(page_size: int) -> int:
    if not MIN_PAGE <= page_size <= MAX_PAGE:
        raise ValueError(f"page size must be between {MIN_PAGE} and {MAX_PAGE}, got {page_size}")
    return page_size


def check_positive(name: str, value: int) -> int:
    if value < 1:
        raise ValueError(f"{name} must be at least 1, got {value}")
    return value


def scope_path(path: str | None) -> str:
    """Normalise a folder option: '' and '/' mean the root, no trailing slash."""
    trimmed = (path or "").rstrip("/")
    if trimmed and not trimmed.startswith("/"):
        raise ValueError(f"path must be absolute, got {path!r}")
    return trimmed


@dataclass(frozen=True)
class SourceOptions:
    """Options of a replicated folder; validated on construction."""

    path: str = ""
    chunk_size: int = DEFAULT_CHUNK_SIZE
    max_entries_per_batch: int = 1000
    recursive: bool = False
    trigger_interval: str = "30 seconds"
    files_per_batch: int = 1
    bytes_per_file: int = DEFAULT_BYTES_PER_FILE

    def __post_init__(self):
        scope_path(self.path)
        check_chunk_size(self.chunk_size)
        check_page_size(self.max_entries_per_batch)
        check_positive("files_per_batch", self.files_per_batch)
        check_positive("bytes_per_file", self.bytes_per_file)
