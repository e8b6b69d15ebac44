"""Small helpers shared by the operators that run inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

DEFAULT_PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [t or b"" for t in col.to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Tokens between ASCII white space, A-Z lower-cased (bytes.split and bytes.lower do exactly that)."""
    return text.lower().split()


def slices(batch: pa.RecordBatch, max_bytes: int = 4 << 20, name: str = "text"):
    """Cut a batch into runs of rows of about max_bytes of text; a longer row is a run of its own."""
    sizes = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    start, total = 0, 0
    for i, value in enumerate(sizes):
        n = len(value.as_buffer()) if value.is_valid else 0
        if total and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def piece_vocabulary(path: str = DEFAULT_PIECES) -> list[str]:
    """Ordinary pieces of a public sentencepiece vocabulary, in id order (driver side; the list is bounded)."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def train_row(doc_id, mod: int, held: int):
    """Whether a row is held out: crc32(doc_id as text) mod ``mod`` is ``held`` (a null id counts as empty text)."""
    from pyspark.sql import functions as F
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return (crc % mod) == held


PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MUL = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """64-bit hash of each word, made once; with strip, ASCII punctuation around a word does not count (0: nothing left)."""

    def __init__(self, strip: bool = False, bound: int = 400_000):
        super().__init__()
        self.strip, self.bound = strip, bound

    def __missing__(self, word: bytes) -> int:
        kept = word.strip(PUNCTUATION) if self.strip else word
        h = self[word] = (xxh3_64_intdigest(kept) | 1) if kept else 0
        return h

    def of(self, text: bytes) -> np.ndarray:
        if len(self) > self.bound:
            self.clear()
        words = words_of(text)
        h = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return h[h != 0] if self.strip else h


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (the splitmix64 steps)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words; one run of all words if there are fewer, none if there are no words."""
    k = min(k, len(words))
    if k == 0:
        return words
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(_MUL) + words[i:len(words) - k + 1 + i]
    return mixed(h + np.uint64(k))


def whole_row(df, name: str = "_row"):
    """All columns of df as one struct, so that columns added beside it cannot clash with theirs."""
    from pyspark.sql import functions as F
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
