"""Words, hashes and batches that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# bytes.split() cuts at 0x20 and 0x09-0x0D and nowhere else, so words stay exact in UTF-8.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Everything but a-z, 0-9 and bytes of non-ASCII characters becomes a space.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; a null text has none."""
    return text.encode().translate(_LOWER).split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_PLAIN).split() if text else []


class WordHashes:
    """64-bit hash per word, kept for frequent use up to a bounded number of words."""

    def __init__(self, limit: int = 100_000) -> None:
        self._limit = limit
        self._known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self._limit:
                known.clear()
            for word in set(words).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; order matters. Fewer words make one run, none make none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i] + np.uint64(1))
    return out


def by_bytes(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes in ``column``; a longer value comes alone, whole.

    What a batch has left in Arrow's pool goes back, as workers live on and add up beside the executor's heap.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
        del batch, values
        pa.default_memory_pool().release_unused()


def per_slice(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on bounded slices, for mapInArrow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, column, limit):
            yield work(batch)

    return run
