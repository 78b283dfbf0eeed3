"""Token ids of whole documents with the ``tokenizers`` library.

For word-level BPE files (ids never cross white space) every distinct pre-token
is encoded once per worker and remembered: a batch is cut into pre-tokens and
hashed with numpy, the unknown ones are encoded by the library in long joined
texts (the end-of-word marks of the vocabulary give the cuts), and the ids are
gathered. Words whose cutting needs the library's own rules (an apostrophe, a
control byte, a character outside the two-byte Latin letters, a special-token
mark) are encoded whole. Other tokenizer files are encoded document by document.
The memo only saves time: it is emptied when it passes ``MEMO`` entries.
"""

from __future__ import annotations

import json
import os
import sys

import numpy as np

from skyvane.llm._text import BLOCK, LOWER, SPACE, U64, blocks, mix, span_hash

MEMO = 500_000
ODD_SALT = U64(0x5851F42D4C957F2D)

# Byte classes: 0 white space, 1 letter, 2 digit, 3 other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[SPACE] = 0
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_CLASS[48:58] = 2
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xCA] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[:32] = _CONTROL[127] = True
_CONTROL[[9, 10, 11, 12, 13, 32]] = False


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _odd_bytes(d: np.ndarray) -> np.ndarray:
    """Bytes that make their word one for the library's own rules."""
    nxt = np.append(d[1:], 0)
    prev = np.insert(d[:-1], 0, 0)
    odd = (d == 39) | _CONTROL[d] | ((d == 60) & (nxt == 124))
    high = d >= 128
    cont = high & (d < 0xC0)
    lead = _LEAD[d] & ~((d == 0xC3) & ((nxt == 0x97) | (nxt == 0xB7))) & ~((d == 0xC4) & (nxt == 0xB0))
    odd |= high & ~cont & ~lead
    odd |= cont & ~_LEAD[prev]
    return odd


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        spec = json.load(open(path))
        suffix = spec["model"].get("end_of_word_suffix")
        self.words = bool(suffix) and [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == [
            "NFC", "Replace", "Lowercase"] and (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get(
            "pattern", {}).get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.size = self.lib.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(self.size, bool)
        for token, i in self.lib.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self._forget()

    def _forget(self) -> None:
        self.main = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.recent = self.main
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    # -- memo: hash -> (place in flat, number of ids); a large sorted part and a small recent one

    @staticmethod
    def _find(table, keys):
        k, at, n = table
        if not len(k):
            return np.zeros(len(keys), bool), None, None
        i = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        return k[i] == keys, at[i], n[i]

    def _learn(self, keys: np.ndarray, texts: list[str], odd: np.ndarray) -> None:
        if len(self.main[0]) + len(self.recent[0]) > MEMO:
            self._forget()
        ids_of: list = [None] * len(texts)
        plain = np.flatnonzero(~odd)
        for lo in range(0, len(plain), 2000):
            part = plain[lo:lo + 2000]
            ids = np.array(self.lib.encode(" ".join([texts[i] for i in part]), add_special_tokens=False).ids, np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(part) and len(cut) and cut[-1] == len(ids):
                for i, x in zip(part, np.split(ids, cut[:-1])):
                    ids_of[i] = x
            else:
                odd = odd.copy()
                odd[part] = True
        rest = np.flatnonzero(odd)
        for i, x in zip(rest, self.lib.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            ids_of[i] = np.array(x.ids, np.uint32)
        n = np.array([len(x) for x in ids_of], np.int64)
        new = np.concatenate(ids_of) if ids_of else np.zeros(0, np.uint32)
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(new)] = new
        at = self.used + np.cumsum(n) - n
        self.used += len(new)
        k, a, m = (np.concatenate(x) for x in zip(self.recent, (keys, at, n)))
        if len(k) > 20_000 + len(self.main[0]) // 4:
            k, a, m = (np.concatenate(x) for x in zip(self.main, (k, a, m)))
            o = np.argsort(k, kind="stable")
            self.main = (k[o], a[o], m[o])
            self.recent = tuple(x[:0] for x in self.main)
        else:
            o = np.argsort(k, kind="stable")
            self.recent = (k[o], a[o], m[o])

    def _block(self, d: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of one block and, per pre-token, its byte start and number of ids; ``inner``: document starts."""
        cls = _CLASS[d]
        edge = np.empty(len(d), bool)
        edge[0] = True
        edge[1:] = cls[1:] != cls[:-1]
        edge[inner] = True
        word_edge = np.empty(len(d), bool)
        word_edge[0] = True
        word_edge[1:] = (cls[1:] == 0) != (cls[:-1] == 0)
        word_edge[inner] = True
        odd_byte = _odd_bytes(d)
        starts = np.flatnonzero(edge | (cls == 2))
        odd = None
        if odd_byte.any():
            ws = np.flatnonzero(word_edge)
            odd_word = np.add.reduceat(odd_byte.astype(np.int64), ws) > 0
            odd_word &= cls[ws] != 0
            if odd_word.any():
                in_odd = np.repeat(odd_word, np.diff(np.append(ws, len(d))))
                keep = np.zeros(len(d), bool)
                keep[starts] = True
                keep &= ~in_odd
                keep[ws] = True
                starts = np.flatnonzero(keep)
                odd = in_odd[starts]
        ends = np.append(starts[1:], len(d))
        real = cls[starts] != 0
        s, e = starts[real], ends[real]
        odd = np.zeros(len(s), bool) if odd is None else odd[real]
        if not len(s):
            return np.zeros(0, np.uint32), s, np.zeros(0, np.int64)
        h = span_hash(LOWER[d], s, e)
        if odd.any():
            h[odd] = mix(span_hash(d, s[odd], e[odd]) ^ ODD_SALT)
        keys, first, inv = np.unique(h, return_index=True, return_inverse=True)
        for _ in range(2):
            got, at, n = self._find(self.main, keys)
            got2, at2, n2 = self._find(self.recent, keys)
            if at is None:
                got, at, n = got2, at2, n2
            elif at2 is not None:
                at, n = np.where(got, at, at2), np.where(got, n, n2)
                got = got | got2
            if at is not None and got.all():
                break
            new = np.flatnonzero(~got)
            raw = d.tobytes()
            f = first[new]
            before = self.used
            self._learn(keys[new], [raw[a:b].decode() for a, b in zip(s[f].tolist(), e[f].tolist())], odd[f])
            if self.used < before:                      # the memo was emptied: learn the whole block
                new = np.flatnonzero(~(self._find(self.main, keys)[0] | self._find(self.recent, keys)[0]))
                f = first[new]
                self._learn(keys[new], [raw[a:b].decode() for a, b in zip(s[f].tolist(), e[f].tolist())], odd[f])
        at, n = at[inv], n[inv]
        total = int(n.sum())
        step = np.cumsum(n) - n
        return self.flat[np.repeat(at - step, n) + np.arange(total)], s, n

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents ``data[off[i]:off[i+1]]``, one after another, and where each begins."""
        if not self.words:
            raw = data.tobytes()
            ids = [x.ids for x in self.lib.encode_batch(
                [raw[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())], add_special_tokens=False)]
            n = np.array([len(x) for x in ids], np.int64)
            return (np.concatenate([np.array(x, np.uint32) for x in ids]) if ids else np.zeros(0, np.uint32)), \
                np.concatenate([[0], np.cumsum(n)])
        parts, first = [], np.zeros(len(off), np.int64)
        for lo, hi in blocks(data, off, SPACE):
            k0, k1 = np.searchsorted(off, lo, "right"), np.searchsorted(off, hi, "left")
            ids, s, n = self._block(data[lo:hi], off[k0:k1] - lo)
            parts.append(ids)
            doc = np.searchsorted(off, s + lo, "right")
            np.add.at(first, doc, n)
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), np.cumsum(first)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it outlives the task, so its memo is shared by a worker's tasks."""
    held = sys.__dict__.setdefault("_token_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def token_groups(batch_docs, path: str, size: int = BLOCK):
    """For (data, off) of a batch: yields (first document, ids, starts) of groups of about ``size`` bytes."""
    from skyvane.llm._text import doc_groups
    data, off = batch_docs
    enc = encoder(path)
    for lo, hi in doc_groups(off, size):
        ids, first = enc.encode(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        yield lo, ids, first
