"""Blocks of token files whose ranks take one to four bytes."""

import numpy as np

from skywarden.llm.tokenfile import read_blocks, write_block


def test_blocks_of_every_width():
    r = np.random.default_rng(4)
    for n, top in [(0, 1), (1, 1), (3, 200), (4, 256), (5, 70_000), (7, 1 << 25), (1001, (1 << 32) - 1)]:
        ranks = (r.random(n) ** 3 * top).astype(np.uint32)
        (ids, lengths, back), = read_blocks(write_block(np.array([9]), np.array([n]), ranks) + b"\n")
        assert (ids.tolist(), lengths.tolist(), back.tolist()) == ([9], [n], ranks.tolist())
