"""Words of a batch of texts, as numbers."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words:
    """The words of some texts: A-Z lower-cased, cut at ASCII white space."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.large_string())))
        at = np.asarray(split.offsets).astype(np.int64)
        coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        self.words = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        real = pc.binary_length(self.words).to_numpy(zero_copy_only=False) > 0
        kept = real[code] if len(code) else np.zeros(0, bool)
        self.at = np.concatenate([[0], np.cumsum(kept)])[at]
        self.code = code[kept]
        self.real = real

    def hashes(self) -> np.ndarray:
        """64 bits for each word of each text, of a hash without known collisions."""
        digests = [hashlib.blake2b(w.encode(), digest_size=8).digest() for w in self.words.to_pylist()]
        return np.frombuffer(b"".join(digests), "<u8")[self.code]
