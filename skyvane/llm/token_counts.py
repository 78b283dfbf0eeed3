"""Token counts of whole documents by overlap resynchronisation.

Documents of up to ``CHUNK`` characters are encoded whole by the library. A longer
one is encoded in chunks that overlap their predecessor. Every token of a chunk has
its place in the document, and two chunks are joined at a token that both hold at
the same place.

Why such a join is proven right: the encoder merges, again and again, the adjacent pair of
symbols whose joined piece has the best score (ties: the leftmost). A sequence of
tokens is then the encoding of its text exactly if every two neighbours are the
encoding of their own joined text: merges inside tokens do not depend on anything outside
them, so the first merge that crossed a border would also be made in the text of
the two tokens beside it alone. In the joined sequence every pair of neighbours comes
from one chunk's own encoding, because the shared token stands on both sides of the join; so
all pairs are right, and so is the whole. No assumption about the text is needed.

If an overlap holds no shared token (a run of one character longer than the
overlap shifts the tokens of one chunk against the other's), it is widened four times
and the chunk grows with it; at the latest the chunk starts where the document
does. Work stays near linear because the chunk covers as much new text as it looks back.

The proof needs a merge model with plain pieces: BPE, identity normalisation, white space kept,
no user-defined pieces (:func:`chunkable`). Other models and ``.json`` files encode whole texts.

Defined cases: null counts as empty; an empty text has no tokens; null and
repeated ids are kept row by row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read

CHUNK = 16_384
OVERLAP = 256
#: Characters sent to the library in one call.
CALL = 1 << 18


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def chunkable(spec) -> bool:
    """Whether the proof above holds for a sentencepiece model (its parsed description)."""
    n = spec.normalizer_spec
    kinds = {p.type for p in spec.pieces}
    return (spec.trainer_spec.model_type == 2 and not n.precompiled_charsmap and not n.remove_extra_whitespaces
            and n.escape_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
            and kinds <= {1, 2, 3, 6} and (6 in kinds))


class Pieces:
    """A sentencepiece model whose tokens have places in the text."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.lib.serialized_model_proto())
        self.chunk, self.overlap = chunk, overlap
        self.chunkable = chunkable(spec)
        self.prefix = int(spec.normalizer_spec.add_dummy_prefix)
        # characters each token stands for; of a character given in bytes the first byte stands for all
        self.chars = np.zeros(len(spec.pieces), np.int64)
        self.inner = np.zeros(len(spec.pieces), bool)
        for i, p in enumerate(spec.pieces):
            if p.type == 6:
                self.inner[i] = 0x80 <= int(p.piece[3:5], 16) < 0xC0
                self.chars[i] = not self.inner[i]
            else:
                self.chars[i] = len(p.piece)
        self.widened = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return self.lib.encode(texts, num_threads=1)

    def placed(self, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and document places of the tokens of ``text[lo:hi]`` encoded by itself."""
        ids = np.array(self._ids([text[lo:hi]])[0], np.int64)
        n = self.chars[ids]
        at = np.cumsum(n) - n + (lo - self.prefix)
        at[self.inner[ids]] -= 1
        if len(ids) and int(n.sum()) != hi - lo + self.prefix:
            raise ValueError("the tokens of a chunk do not cover its text")
        return ids, at

    def long_text(self, text: str) -> np.ndarray:
        """Ids of a text longer than a chunk, joined from overlapping chunks."""
        size = len(text)
        parts = [self.placed(text, 0, self.chunk)]
        hi = self.chunk
        while hi < size:
            back = self.overlap
            while True:
                lo, to = max(0, hi - back), min(size, hi + max(self.chunk, back))
                ids, at = self.placed(text, lo, to)
                cut = 0 if lo == 0 else self._shared(parts, ids, at, lo)
                if cut is not None:
                    break
                back *= 4
                self.widened += 1
            while parts and (lo == 0 or parts[-1][1][0] >= cut):
                parts.pop()
            if parts:
                k = np.searchsorted(parts[-1][1], cut, "left")
                parts[-1] = (parts[-1][0][:k], parts[-1][1][:k])
            k = 0 if lo == 0 else np.searchsorted(at, cut, "left")
            parts.append((ids[k:], at[k:]))
            hi = to
        return np.concatenate([p[0] for p in parts])

    def _shared(self, parts: list, ids: np.ndarray, at: np.ndarray, lo: int) -> int | None:
        """Place of a token that the joined text so far and the new chunk both hold there."""
        whole = ~self.inner[ids]
        ids, at = ids[whole], at[whole]
        for old_ids, old_at in reversed(parts):
            whole = ~self.inner[old_ids] & (old_at >= lo - self.prefix)
            _, a, b = np.intersect1d(old_at[whole], at, assume_unique=True, return_indices=True)
            same = np.flatnonzero(old_ids[whole][a] == ids[b])
            if len(same):
                return int(at[b[same[len(same) // 2]]])
            if not len(old_at) or old_at[0] < lo:
                return None
        return None

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        long = size > self.chunk if self.chunkable else np.zeros(len(texts), bool)
        for i in np.flatnonzero(long):
            out[i] = len(self.long_text(texts[i]))
        rest = np.flatnonzero(~long)
        group = np.cumsum(size[rest]) // CALL
        for part in np.split(rest, np.flatnonzero(np.diff(group)) + 1) if len(rest) else []:
            out[part] = [len(x) for x in self._ids([texts[i] for i in part])]
        return out


class Whole:
    """A ``tokenizers`` file: texts are encoded whole."""

    def __init__(self, path: str) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()

    def counts(self, texts: list[str]) -> np.ndarray:
        return np.array([len(x.ids) for x in self.lib.encode_batch(texts, add_special_tokens=False)], np.int64)


def _counter(path: str):
    """The worker's model for a file; it outlives the task."""
    held = sys.__dict__.setdefault("_token_counters", {})
    if path not in held:
        held[path] = Whole(path) if path.endswith(".json") else Pieces(path)
    return held[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096,
                 text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. One pass, no shuffle."""
    begin(docs.sparkSession)
    path = path or default_path()
    base = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            col = b.column(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(col).cast(pa.int64()),
                 pa.array(_counter(path).counts(col.to_pylist()), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    schema = base.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long")
    out = base.mapInArrow(run, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
