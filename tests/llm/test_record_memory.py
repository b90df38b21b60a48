"""What framing token records takes of a worker's memory."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from farebox.llm import records


@pytest.mark.parametrize(("size", "n"), [(1200, 14_000), (10, 40_000), (16 << 20, 1)])
def test_framing_takes_a_small_multiple_of_a_shard(size, n):
    """Checksums took an index of 16 bytes for each byte, and 1 KB for each short record, of a whole shard at once."""
    payloads = [bytes([i % 251]) * size for i in range(n)]
    records.frame(payloads[:2])
    tracemalloc.start()
    try:
        data, index = records.frame(payloads)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(data) == (size + 16) * n and len(index) == n
    # the records, framed and joined, as objects of some 50 bytes for each part, and a group of blocks with its registers
    assert peak < 3 * size * n + 400 * n + (16 << 20)


def test_checksums_do_not_depend_on_their_groups(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = rng.choice([0, 1, 3, 4, 7, 1023, 1024, 1025, 9000], 300)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(0, 256, int(offsets[-1])).astype(np.uint8)
    whole = records._crc_group(data, offsets)
    for group in (1, 5000, 1 << 20):
        monkeypatch.setattr(records, "_GROUP", group)
        assert np.array_equal(records.crc32c(data, offsets), whole)
        assert np.array_equal(records.crc32c(data, offsets[40:]), whole[40:])
    assert len(records.crc32c(data, offsets[:1])) == 0
